"""A1-A10, batch forms: keyed running aggregates that emit after every row.

Each is the batch meaning of a per-key state program: the value emitted
after row r is a function of the key's rows up to r in ``(ts, event_id)``
order. Running values use :mod:`eventflow.operators.ordered`, so a key that
holds a third of all rows is still split over many tasks by time bucket.
The streaming forms (``eventflow.streaming.processors``) are checked
against these.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventflow import schemas as S
from eventflow.functions.expressions import share_percent
from eventflow.functions.time import interval_us
from eventflow.operators import ordered

ORDER = ("ts", "event_id")


def rolling_reduce(df: DataFrame, key: str | Sequence[str], value: str, name: str = "running",
                   order: Sequence[str] = ORDER, bucket: str | None = None) -> DataFrame:
    """A1: the key's running sum of ``value`` after every row."""
    keys = [key] if isinstance(key, str) else list(key)
    return ordered.running_sums(df, {name: F.col(value).cast("long")}, order, keys, bucket)


def final_reduce(df: DataFrame, key: str | Sequence[str], value: str, name: str = "total") -> DataFrame:
    """A2: the final value of the same reduce (partial + final aggregate)."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.sum(F.col(value).cast("long")).alias(name))


def running_count(df: DataFrame, key: str = "user_id", name: str = "n",
                  order: Sequence[str] = ORDER, bucket: str | None = None) -> DataFrame:
    """A4: events seen so far for the row's key (value-state meaning)."""
    return ordered.row_numbers(df, name, order, [key], bucket)


def running_type_counts(df: DataFrame, key: str = "user_id", type_col: str = "event_type",
                        types: Sequence[str] = (S.ADD, S.REMOVED), name: str = "counts",
                        order: Sequence[str] = ORDER, bucket: str | None = None,
                        as_map: bool = True) -> DataFrame:
    """A5: running count per (key, event type), emitted as the key's whole map.

    ``types`` is the closed set of event types (a sealed hierarchy); types
    not yet seen by the key are absent from the map.
    """
    sums = {f"__n{i}": F.when(F.col(type_col) == t, 1).otherwise(0).cast("long")
            for i, t in enumerate(types)}
    r = ordered.running_sums(df, sums, order, [key], bucket)
    entries = F.array(*[F.struct(F.lit(t).alias("key"), F.col(f"__n{i}").alias("value"))
                        for i, t in enumerate(types)])
    m = F.map_from_entries(F.filter(entries, lambda e: e["value"] > 0))
    r = r.withColumn(name, m)
    return r.drop(*sums)


def running_list_size(df: DataFrame, key: str = "user_id", max_items: int | None = None,
                      name: str = "n", order: Sequence[str] = ORDER, bucket: str | None = None) -> DataFrame:
    """Size of the key's event list after adding the row.

    Unbounded by default (the list keeps every event); with ``max_items`` the
    list keeps the newest ``max_items`` events. Only the size is emitted, so
    the batch form never materialises the list.
    """
    r = ordered.row_numbers(df, "__rn", order, [key], bucket)
    size = F.col("__rn") if max_items is None else F.least(F.col("__rn"), F.lit(max_items).cast("long"))
    return r.withColumn(name, size).drop("__rn")


def retained_count(df: DataFrame, key: str = "user_id", retention: str = "1 hour",
                   name: str = "n", ts: str = "ts", tie: str = "event_id",
                   bucket: str | int | None = None) -> DataFrame:
    """Events of the key still alive after the row, with time-to-live.

    An event added at t0 is alive at t while ``t - t0 < retention`` (an age
    equal to the retention is expired). Rows with the same ``ts`` count in
    arrival (``tie``) order.

    Linear: every row adds 1 at its time and its expiry mark takes 1 away at
    ``ts + retention``, ahead of the rows of that instant; the running sum is
    the count. Rows and marks go through the bucketed running sum, so a hot
    key is split by time (``bucket`` sets the width).
    """
    at = ordered.epoch_position(df, ts)
    mark = F.explode(F.array(F.struct(at.alias("at"), F.lit(1).alias("m")),
                             F.struct((at + F.lit(interval_us(retention))).alias("at"), F.lit(-1).alias("m"))))
    both = df.withColumn("__e", mark).select(*df.columns, F.col("__e.at").alias("__at"), F.col("__e.m").alias("__m"))
    width = bucket if bucket == ordered.ADAPTIVE else interval_us(ordered.auto_bucket([key], bucket))
    r = ordered.running_sums(both, {name: F.col("__m").cast("long")}, ("__at", "__m", tie), [key], width)
    return r.filter(F.col("__m") == 1).drop("__at", "__m")


def count_with_reset(df: DataFrame, key: str = "user_id", limit: int = 10, name: str = "n",
                     order: Sequence[str] = ORDER, bucket: str | None = None) -> DataFrame:
    """A list cleared when its size exceeds ``limit``; the clear comes
    before the emit, so the crossing row emits 0: 1..limit, 0, 1, ..."""
    r = ordered.row_numbers(df, "__rn", order, [key], bucket)
    return r.withColumn(name, F.pmod(F.col("__rn"), F.lit(limit + 1)).cast("long")).drop("__rn")


def high_quantity_counts(cart: DataFrame, threshold: int = 5, key: str = "user_id", name: str = "n",
                         order: Sequence[str] = ORDER, bucket: str | None = None) -> DataFrame:
    """Per user, the count of Add events with ``quantity > threshold``,
    emitted on qualifying rows only. Removed events are ignored."""
    q = cart.filter((F.col("event_type") == S.ADD) & (F.col("quantity") > threshold))
    return ordered.row_numbers(q, name, order, [key], bucket)


def tag_union(left: DataFrame, right: DataFrame, tag: str = "side",
              left_tag: str = "left", right_tag: str = "right") -> DataFrame:
    """Two differently typed streams as one: tagged ``unionByName`` (J4 shape)."""
    return (left.withColumn(tag, F.lit(left_tag))
                .unionByName(right.withColumn(tag, F.lit(right_tag)), allowMissingColumns=True))


def running_share(left: DataFrame, right: DataFrame, name: str = "share",
                  order: Sequence[str] = ORDER, bucket: str | None = None) -> DataFrame:
    """A10: after every row of either stream, ``left*100.0/(left+right)``
    over the rows seen so far (current row included).

    The global running counts use the bucketed prefix sum, so the operator
    is parallel although the reference pins it to one task.
    """
    return running_share_tagged(tag_union(left.select(*order), right.select(*order)), name, order, bucket)


def running_share_tagged(u: DataFrame, name: str = "share", order: Sequence[str] = ORDER, bucket: str | None = None) -> DataFrame:
    """A10 over rows that already say their ``side``: two kinds of one table, read once."""
    r = ordered.running_sums(u, {
        "n_left": F.when(F.col("side") == "left", 1).otherwise(0).cast("long"),
        "n_right": F.when(F.col("side") == "right", 1).otherwise(0).cast("long"),
    }, order, (), bucket)
    return r.withColumn(name, share_percent(F.col("n_left"), F.col("n_right")))
