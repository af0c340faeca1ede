"""Order-dependent computations that stay parallel at any scale.

A running value over a global (or hot-key) order would, written naively as
an unpartitioned window, pull every row into one task. Here the order is cut
into time buckets:

1. inside each ``(keys, bucket)`` partition the value is computed with an
   ordinary window (``Window.partitionBy(*keys, bucket)``);
2. a bucket table (one row per non-empty ``(keys, bucket)``, built with a
   partial aggregate) carries what earlier buckets contribute;
3. the carry is joined back on ``(keys, bucket)``.

The bucket table has one row per (key, bucket), not per event, so its window
is cheap; the join back lets AQE broadcast it when its measured size is under
the broadcast threshold and shuffle-join it otherwise. Results are exact and
deterministic (no dependence on ``spark_partition_id``). The bucket width is
a parameter: a finer width splits a hot period over more tasks; ``"adaptive"``
cuts each heavy key at the quantiles of its own times (:func:`with_cuts`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, TimestampNTZType, TimestampType

from eventflow.functions.time import epoch_us, interval_us

US = "__us"
BUCKET = "__b"

# Default bucket widths when the caller gives none. Keyless running values
# are split by time alone, so their buckets are fine (a month is ~43k
# one-minute buckets: the bucket table stays small while no single bucket
# holds a large share of a big, dense stream). Keyed ones are already split
# by key; an hour keeps their bucket table well below the row count.
KEYLESS_BUCKET = "1 minute"
KEYED_BUCKET = "1 hour"


#: rows that an adaptive bucket aims at, and cut points a heavy key has at most
ROWS_PER_BUCKET, CUTS = 100_000, 256
ADAPTIVE = "adaptive"


def auto_bucket(keys: Sequence[str], bucket: str | int | None) -> str | int:
    if bucket is not None:
        return bucket
    return KEYED_BUCKET if list(keys) else KEYLESS_BUCKET


def _position(df: DataFrame, col: str) -> Column:
    """Epoch micros for a timestamp order column; the value itself for a
    numeric one (then the bucket width is in the column's own units)."""
    dt = df.schema[col].dataType
    if isinstance(dt, (TimestampType, TimestampNTZType)):
        return epoch_us(col, df)
    if isinstance(dt, NumericType):
        return F.floor(F.col(col)).cast("long")
    raise TypeError(f"order column {col!r} must be a timestamp or a number, not {dt}")


def epoch_position(df: DataFrame, col: str) -> Column:
    """The order position of a timestamp (epoch micros) or number column."""
    return _position(df, col)


def with_bucket(df: DataFrame, ts: str, bucket: str | int) -> DataFrame:
    """Add ``__us`` (epoch micros of ``ts``, or a numeric position) and
    ``__b`` (floor(us / width))."""
    b_us = interval_us(bucket)
    if b_us <= 0:
        raise ValueError("bucket width must be positive")
    return (df.withColumn(US, _position(df, ts))
              .withColumn(BUCKET, F.expr(f"({US} - pmod({US}, {b_us})) div {b_us}")))


def with_cuts(df: DataFrame, ts: str, keys: Sequence[str], rows: int | None = None) -> DataFrame:
    """Like :func:`with_bucket`, with cuts where the rows are: ``__b`` is the number of the key's cut points at or before the row.

    A key (or the whole frame, without keys) of at most ``rows`` rows is one
    bucket, however long it lasts, so the bucket table has about a row a key; a
    heavier one is cut at the quantiles of its own times, so a dense hour is
    many buckets and sparse days are one. Rows are counted first; only heavy
    keys have cut points (at most CUTS each), found by a partial + final sketch.
    Rows of one instant stay together.
    """
    keys, rows = list(keys), rows or ROWS_PER_BUCKET
    d = df.withColumn(US, _position(df, ts))
    fractions = [k / CUTS for k in range(1, CUTS)]
    if not keys:  # one row of at most CUTS numbers
        whole = d.agg(F.count(F.lit(1)).alias("n"), F.percentile_approx(US, fractions, 10 * CUTS).alias("q")).first()
        every = max(1, CUTS * rows // max(whole["n"], 1))
        points = sorted(set((whole["q"] or [])[every - 1::every])) if whole["n"] > rows else []
        after = F.size(F.filter(F.array(*[F.lit(x).cast("long") for x in points]), lambda c: c <= F.col(US)))
        return d.withColumn(BUCKET, after.cast("long") if points else F.lit(0).cast("long"))
    names = [f"__hk_{i}" for i in range(len(keys))]
    sizes = d.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names)]).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > rows)
    same = [d[k].eqNullSafe(sizes[n]) for k, n in zip(keys, names)]
    heavy = d.join(sizes, on=same, how="inner").groupBy(*names).agg(
        F.percentile_approx(US, fractions, 10 * CUTS).alias("__q"), F.max("__n").alias("__n"))
    # of the CUTS - 1 quantiles as many as the rows ask for, evenly
    step = F.greatest(F.lit(1), F.floor(F.lit(CUTS) * F.lit(rows) / F.col("__n")).cast("int"))
    cuts = heavy.select(*names, F.array_distinct(F.filter("__q", lambda q, i: F.pmod(i + 1, step) == 0)).alias("__cuts"))
    back = [d[k].eqNullSafe(cuts[n]) for k, n in zip(keys, names)]
    number = F.coalesce(F.size(F.filter("__cuts", lambda c: c <= F.col(US))), F.lit(0)).cast("long")
    return (d.join(cuts, on=back, how="left").withColumn(BUCKET, F.when(F.col("__cuts").isNull(), F.lit(0)).otherwise(number))
            .drop(*names, "__cuts"))


def bucketed(df: DataFrame, ts: str, keys: Sequence[str], bucket: str | int | None) -> DataFrame:
    """Time buckets of a fixed width, the automatic one for None, or adaptive ones."""
    return with_cuts(df, ts, keys) if bucket == ADAPTIVE else with_bucket(df, ts, auto_bucket(keys, bucket))


def _order_cols(order: Sequence[str]) -> list[Column]:
    return [F.col(c) for c in order]


def _join_back(inner: DataFrame, carry: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join a bucket table back on (keys, bucket), null-safe on keys."""
    ren = {k: f"__ck_{i}" for i, k in enumerate(keys)}
    c = carry
    for k, r in ren.items():
        c = c.withColumnRenamed(k, r)
    c = c.withColumnRenamed(BUCKET, "__cb")
    # null-safe, rows without a time included; a plain equality would also put a
    # not-null filter below one side's exchange only, which could not be shared
    cond = [inner[BUCKET].eqNullSafe(c["__cb"])] + [inner[k].eqNullSafe(c[r]) for k, r in ren.items()]
    out = inner.join(c, on=cond, how="inner")
    return out.drop("__cb", *ren.values())


def running_sums(df: DataFrame, sums: dict[str, Column], order: Sequence[str] = ("ts", "event_id"),
                 keys: Sequence[str] = (), bucket: str | int | None = None,
                 keep_internal: bool = False, start: DataFrame | None = None) -> DataFrame:
    """Inclusive running sums per ``keys`` in ``order`` (first column = time).

    ``start`` (the keys and the names of ``sums``) holds sums that came before
    these rows; it joins the bucket table, not the rows.

    ``sums`` maps output name -> column to sum (use ``F.lit(1)`` for a row
    number, ``F.when(pred, 1).otherwise(0)`` for a running conditional count).
    """
    keys = list(keys)
    ts = order[0]
    d = bucketed(df, ts, keys, bucket)
    vcols = {}
    for name, expr in sums.items():
        vcols[name] = f"__v_{name}"
        d = d.withColumn(vcols[name], expr)
    w_in = (Window.partitionBy(*keys, BUCKET).orderBy(*_order_cols(order))
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    inner = d.select("*", *[F.sum(v).over(w_in).alias(f"__in_{n}") for n, v in vcols.items()])
    # a bucket's totals are its last row's running sums: they come off the
    # frame that is already dealt and sorted by (keys, bucket), so the same
    # scan, exchange and sort serve the rows and the bucket table
    last = F.max_by(F.struct(*[F.col(f"__in_{n}").alias(f"__t_{n}") for n in vcols]), F.struct(*_order_cols(order)))
    totals = inner.groupBy(*keys, BUCKET).agg(last.alias("__l")).select(*keys, BUCKET, "__l.*")
    w_b = Window.partitionBy(*keys).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(*keys, BUCKET, *[
        F.coalesce(F.sum(f"__t_{n}").over(w_b), F.lit(0)).alias(f"__o_{n}") for n in vcols])
    if start is not None:
        first = start.select(*[F.col(k).alias(f"__sk_{i}") for i, k in enumerate(keys)], *[F.col(n).alias(f"__s_{n}") for n in vcols])
        same = [carry[k].eqNullSafe(first[f"__sk_{i}"]) for i, k in enumerate(keys)]
        carry = carry.join(first, on=same, how="left").select(*keys, BUCKET, *[
            (F.col(f"__o_{n}") + F.coalesce(F.col(f"__s_{n}"), F.lit(0))).alias(f"__o_{n}") for n in vcols])
    out = _join_back(inner, carry, keys)
    out = out.select("*", *[(F.col(f"__in_{n}") + F.col(f"__o_{n}")).alias(n) for n in vcols])
    drop = [c for n in vcols for c in (f"__in_{n}", f"__o_{n}", vcols[n])]
    if not keep_internal:
        drop += [US, BUCKET]
    return out.drop(*drop)


def row_numbers(df: DataFrame, name: str = "rn", order: Sequence[str] = ("ts", "event_id"),
                keys: Sequence[str] = (), bucket: str | int | None = None) -> DataFrame:
    """Exact ``row_number() OVER (PARTITION BY keys ORDER BY order)``, bucketed."""
    return running_sums(df, {name: F.lit(1).cast("long")}, order, keys, bucket)


def running_last(df: DataFrame, value: str, name: str, order: Sequence[str] = ("ts", "event_id"),
                 keys: Sequence[str] = (), bucket: str | int | None = None) -> DataFrame:
    """Last non-null ``value`` so far (inclusive) per ``keys`` in ``order``."""
    keys = list(keys)
    d = bucketed(df, order[0], keys, bucket)
    w_in = (Window.partitionBy(*keys, BUCKET).orderBy(*_order_cols(order))
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    w_all = (Window.partitionBy(*keys, BUCKET).orderBy(*_order_cols(order))
             .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    inner = (d.withColumn("__in", F.last(F.col(value), ignorenulls=True).over(w_in))
              .withColumn("__bl", F.last(F.col(value), ignorenulls=True).over(w_all)))
    # the bucket's last non-null value, read off the window (same partitioning,
    # so no extra shuffle) and reduced with a fixed-width hash aggregate
    totals = inner.groupBy(*keys, BUCKET).agg(F.first("__bl").alias("__t"))
    w_b = Window.partitionBy(*keys).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(*keys, BUCKET, F.last("__t", ignorenulls=True).over(w_b).alias("__o"))
    out = _join_back(inner, carry, keys)
    return (out.withColumn(name, F.coalesce(F.col("__in"), F.col("__o")))
               .drop("__in", "__bl", "__o", US, BUCKET))


def sessionize(df: DataFrame, gap: str | int, order: Sequence[str] = ("ts", "event_id"),
               keys: Sequence[str] = (), bucket: str | int | None = None,
               name: str = "session_start_us") -> DataFrame:
    """Tag each row with the epoch-micros start of its session.

    A new session starts when the distance to the previous row of the same
    key is strictly greater than ``gap`` (a distance equal to the gap keeps
    the session). Keeps ``__us`` for callers that aggregate sessions.
    """
    keys = list(keys)
    gap_us = interval_us(gap)
    d = bucketed(df, order[0], keys, bucket)
    w_in = Window.partitionBy(*keys, BUCKET).orderBy(*_order_cols(order))
    d = d.withColumn("__prev", F.lag(US).over(w_in))
    d = d.withColumn("__gs", F.when(F.col("__prev").isNotNull() & (F.col(US) - F.col("__prev") > gap_us),
                                    F.col(US)))
    d = d.withColumn("__in", F.max("__gs").over(w_in.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    totals = d.groupBy(*keys, BUCKET).agg(F.min(US).alias("__first"), F.max(US).alias("__last"),
                                          F.max("__gs").alias("__last_inner"))
    w_b = Window.partitionBy(*keys).orderBy(BUCKET)
    totals = totals.withColumn("__prev_last", F.lag("__last").over(w_b))
    totals = totals.withColumn(
        "__first_starts", F.col("__prev_last").isNull() | (F.col("__first") - F.col("__prev_last") > gap_us))
    totals = totals.withColumn(
        "__bucket_last_start",
        F.coalesce(F.col("__last_inner"), F.when(F.col("__first_starts"), F.col("__first"))))
    totals = totals.withColumn(
        "__carry", F.max("__bucket_last_start").over(w_b.rowsBetween(Window.unboundedPreceding, -1)))
    carry = totals.select(*keys, BUCKET, F.when(F.col("__first_starts"), F.col("__first"))
                          .otherwise(F.col("__carry")).alias("__entry"))
    out = _join_back(d, carry, keys)
    return (out.withColumn(name, F.coalesce(F.col("__in"), F.col("__entry")))
               .drop("__prev", "__gs", "__in", "__entry", BUCKET))


def range_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str, right_ts: str,
               lower: str | int, upper: str | int, lower_inclusive: bool = True,
               upper_inclusive: bool = True) -> DataFrame:
    """Inner join on ``keys`` with ``left_ts + lower <(=) right_ts <(=) left_ts + upper``.

    Equi-join on ``(keys, bucket)`` with bucket width ``upper - lower``: each
    right row has one bucket, each left row lists the (at most 2) buckets its
    range touches, so every pair appears once and a hot key is split by time.
    Columns of both sides are kept; the caller renames clashes beforehand.
    """
    lo, hi = interval_us(lower), interval_us(upper)
    if lo > hi:
        raise ValueError("lower bound must not exceed upper bound")
    width = max(1, hi - lo)
    lus = epoch_us(left_ts, left)
    rus = epoch_us(right_ts, right)
    l2 = (left.withColumn("__lus", lus)
              .withColumn("__jb", F.explode(F.sequence(
                  F.expr(f"(__lus + {lo} - pmod(__lus + {lo}, {width})) div {width}"),
                  F.expr(f"(__lus + {hi} - pmod(__lus + {hi}, {width})) div {width}")))))
    r2 = (right.withColumn("__rus", rus)
               .withColumn("__rb", F.expr(f"(__rus - pmod(__rus, {width})) div {width}")))
    cond = [l2["__jb"] == r2["__rb"]] + [l2[lk] == r2[rk] for lk, rk in _key_pairs(keys)]
    d = F.col("__rus") - F.col("__lus")
    lo_ok = d >= lo if lower_inclusive else d > lo
    hi_ok = d <= hi if upper_inclusive else d < hi
    return l2.join(r2, on=cond, how="inner").filter(lo_ok & hi_ok).drop("__lus", "__jb", "__rus", "__rb")


def _key_pairs(keys):
    out = []
    for k in keys:
        out.append(k if isinstance(k, tuple) else (k, k))
    return out
