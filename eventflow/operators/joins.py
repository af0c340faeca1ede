"""Unions, window / interval / as-of joins, connected streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventflow import schemas as S
from eventflow.functions.expressions import share_percent, warn_message
from eventflow.functions.time import epoch_us, from_epoch_us, interval_us
from eventflow.operators import ordered
from eventflow.operators.running import tag_union


def union_sources(frames: Sequence[DataFrame], source_ids: Sequence[str] | None = None,
                  name: str = "source_id") -> DataFrame:
    """Bag union of same-typed streams, each row marked with its source."""
    ids = list(source_ids) if source_ids else [f"source-{i}" for i in range(len(frames))]
    out = None
    for f, sid in zip(frames, ids):
        f = f.withColumn(name, F.lit(sid))
        out = f if out is None else out.unionByName(f)
    return out


def connect(left: DataFrame, right: DataFrame, tag: str = "side") -> DataFrame:
    """Two differently typed streams in one operator: a tagged union
    with the union of both schemas (absent columns are null)."""
    return tag_union(left, right, tag)


def connected_share(left: DataFrame, right: DataFrame, key: str, name: str = "share", order: Sequence[str] = ("ts", "event_id"),
                    bucket: str | None = None) -> DataFrame:
    """J4 with keyed state, batch form: a count per key and side, and after every row of either side the left side's
    share in per cent. Both counts are bucketed running sums, so a hot key is split by time."""
    return connected_share_tagged(tag_union(left.select(key, *order), right.select(key, *order)), key, name, order, bucket)


def connected_share_tagged(both: DataFrame, key: str, name: str = "share", order: Sequence[str] = ("ts", "event_id"),
                           bucket: str | None = None) -> DataFrame:
    """:func:`connected_share` over rows that already say their ``side``."""
    side = lambda t: F.when(F.col("side") == t, 1).otherwise(0).cast("long")
    r = ordered.running_sums(both, {"n_left": side("left"), "n_right": side("right")}, order, [key], bucket)
    return r.withColumn(name, share_percent(F.col("n_left"), F.col("n_right")))


def window_join(left: DataFrame, right: DataFrame, keys: Sequence[str | tuple[str, str]], size: str,
                left_ts: str = "ts", right_ts: str = "ts") -> DataFrame:
    """Inner join of rows with equal key in the same tumbling window.

    The window start is projected on both sides first (``window()`` cannot
    sit in a join condition), then it is an equi-join on (key, window): a
    hot key is split by window. Right-side columns that clash are expected
    to be renamed by the caller.
    """
    size_us = interval_us(size)

    def _ws(df, ts):
        us = epoch_us(ts, df)
        return from_epoch_us(us - F.pmod(us, F.lit(size_us)))

    l2 = left.withColumn("window_start", _ws(left, left_ts))
    r2 = right.withColumn("__rws", _ws(right, right_ts))
    pairs = [k if isinstance(k, tuple) else (k, k) for k in keys]
    cond = [l2["window_start"] == r2["__rws"]] + [l2[a] == r2[b] for a, b in pairs]
    j = l2.join(r2, on=cond, how="inner").drop("__rws")
    return j.withColumn("window_end", from_epoch_us(epoch_us("window_start") + F.lit(size_us)))


def interval_join(left: DataFrame, right: DataFrame, keys: Sequence[str | tuple[str, str]],
                  lower: str, upper: str, left_ts: str = "ts", right_ts: str = "ts",
                  lower_inclusive: bool = True, upper_inclusive: bool = True) -> DataFrame:
    """Inner join, equal key and ``left_ts + lower < right_ts < left_ts + upper``
    (each bound inclusive unless told otherwise). Bucketed equi-join, see
    :func:`eventflow.operators.ordered.range_join`."""
    return ordered.range_join(left, right, keys, left_ts, right_ts, lower, upper,
                              lower_inclusive, upper_inclusive)


def fixed_threshold(cart: DataFrame, threshold: int = 2, with_message: bool = True) -> DataFrame:
    """Add rows whose quantity is strictly above a fixed threshold."""
    out = (cart.filter((F.col("event_type") == S.ADD) & (F.col("quantity") > threshold))
               .withColumn("threshold", F.lit(threshold)))
    if with_message:
        out = out.withColumn("message", warn_message("user_id", "quantity", "sku", "threshold"))
    return out


def rule_as_of(events: DataFrame, rules: DataFrame, default: int = 0, ts: str = "ts",
               tie: str = "event_id", rule_ts: str = "effective_ts", rule_value: str = "value",
               rule_tie: str = "rule_id", name: str = "threshold", bucket: str | None = None) -> DataFrame:
    """J6 core: the newest rule value with ``effective_ts <= ts`` for every
    event (``default`` before the first rule). An as-of join.

    Rules and events are merged into one time-ordered stream and the last
    rule value so far is carried with the bucketed running-last: no rule
    table is broadcast (its size grows with the data), no pairs are formed.
    A rule at the same instant as an event applies to it.
    """
    ev_cols = events.columns
    e = events.select(*[F.col(c) for c in ev_cols],
                      F.col(ts).alias("__t"), F.lit(1).alias("__kind"),
                      F.col(tie).cast("long").alias("__tie"),
                      F.lit(None).cast(rules.schema[rule_value].dataType).alias("__rv"))
    r = rules.select(*[F.lit(None).cast(events.schema[c].dataType).alias(c) for c in ev_cols],
                     F.col(rule_ts).alias("__t"), F.lit(0).alias("__kind"),
                     F.col(rule_tie).cast("long").alias("__tie"),
                     F.col(rule_value).alias("__rv"))
    return rule_as_of_tagged(e.unionByName(r), ev_cols, default, name, bucket)


def rule_as_of_tagged(u: DataFrame, ev_cols: Sequence[str], default: int = 0, name: str = "threshold", bucket: str | None = None) -> DataFrame:
    """The as-of join over events and rules in one frame: ``__t`` and ``__tie`` order it, ``__kind`` is 0 for rules (with
    their value in ``__rv``) and 1 for events."""
    out = ordered.running_last(u, "__rv", "__cur", order=("__t", "__kind", "__tie"), bucket=bucket)
    return (out.filter(F.col("__kind") == 1)
               .withColumn(name, F.coalesce(F.col("__cur"), F.lit(default)))
               .select(*ev_cols, name))


def changing_threshold(cart: DataFrame, rules: DataFrame, default: int = 0,
                       with_message: bool = True, bucket: str | None = None) -> DataFrame:
    """Add rows whose quantity is above the threshold in force at their
    time (rule stream broadcast to all keys in the reference)."""
    adds = cart.filter(F.col("event_type") == S.ADD)
    j = rule_as_of(adds, rules, default=default, bucket=bucket)
    out = j.filter(F.col("quantity") > F.col("threshold"))
    if with_message:
        out = out.withColumn("message", warn_message("user_id", "quantity", "sku", "threshold"))
    return out
