"""Event time, windows, count triggers.

Windows are flattened to ``window_start`` / ``window_end`` (half-open,
epoch-aligned). Time-window aggregates are plain ``groupBy(window(...))``
plans, so Catalyst runs them as partial + final hash aggregates: a window
that holds a third of all rows is still combined map-side first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventflow.functions.time import (
    flatten_window, from_epoch_us, interval_us, to_instant,
)
from eventflow.operators import ordered
from eventflow.operators.aggregate import Accumulator, aggregate


def _count(predicate: Column | None, name: str) -> Column:
    if predicate is None:
        return F.count(F.lit(1)).alias(name)
    return F.count_if(F.coalesce(predicate, F.lit(False))).alias(name)


# --- W1 / W2 ----------------------------------------------------------------

def with_event_time(df: DataFrame, ts: str = "ts", delay: str = "500 milliseconds",
                    name: str = "event_time") -> DataFrame:
    """An instant-typed event-time column plus a bounded-delay watermark.

    A window ``[s, e)`` is final once ``max(event_time) - delay >= e``; late
    rows for a final window are dropped (the reference's rule, with its
    1 ms offset, evicts on the same condition). Spark tests lateness against
    the watermark of the previous micro-batch, so a late row that arrives in
    the batch right after the one that closed its window can still count.
    """
    src = F.col(ts)
    if str(df.schema[ts].dataType) == "TimestampNTZType()":
        src = to_instant(ts)
    return df.withColumn(name, src).withWatermark(name, delay)


def watermark_trigger(interval: str = "1 second") -> dict:
    """Spark advances the watermark once per micro-batch, so the period of
    watermark emission is the trigger period. Pass to ``writeStream.trigger``."""
    return {"processingTime": interval}


# --- W3 / W4 / W5 / W6 --------------------------------------------------------

def tumbling_count(df: DataFrame, size: str, predicate: Column | None = None,
                   keys: Sequence[str] = (), ts: str = "ts", name: str = "n") -> DataFrame:
    """Rows (or rows matching ``predicate``) per tumbling window.

    A window that holds only non-matching rows is emitted with 0, so the
    predicate is a conditional count, never a filter before the window.
    """
    g = df.groupBy(*keys, F.window(ts, size).alias("window")).agg(_count(predicate, name))
    return flatten_window(g).select(*keys, "window_start", "window_end", name)


def sliding_count(df: DataFrame, size: str, slide: str, predicate: Column | None = None,
                  keys: Sequence[str] = (), ts: str = "ts", name: str = "n") -> DataFrame:
    """Rows per sliding window (windows that start before the first row
    and contain it are included)."""
    g = df.groupBy(*keys, F.window(ts, size, slide).alias("window")).agg(_count(predicate, name))
    return flatten_window(g).select(*keys, "window_start", "window_end", name)


# --- W7 -------------------------------------------------------------------------

def session_count(df: DataFrame, gap: str, keys: Sequence[str] = (), predicate: Column | None = None,
                  order: Sequence[str] = ("ts", "event_id"), bucket: str | None = None,
                  name: str = "n") -> DataFrame:
    """Session windows (rows no more than ``gap`` apart share a session).

    Sessions are found with the bucketed sessionizer, so neither a hot key
    nor a keyless stream collapses into one task; the per-session aggregate
    is then an ordinary partial + final aggregate.
    ``window_end`` = last row + gap, as in ``session_window``.
    """
    gap_us = interval_us(gap)
    s = ordered.sessionize(df, gap, order=order, keys=keys, bucket=bucket, name="__sid")
    agg = s.groupBy(*keys, "__sid").agg(F.max(ordered.US).alias("__last"), _count(predicate, name))
    return agg.select(*keys,
                      from_epoch_us(F.col("__sid")).alias("window_start"),
                      from_epoch_us(F.col("__last") + F.lit(gap_us)).alias("window_end"),
                      name)


def session_count_native(df: DataFrame, gap: str, keys: Sequence[str] = (),
                         predicate: Column | None = None, ts: str = "ts", name: str = "n") -> DataFrame:
    """W7 with Spark's ``session_window`` (used by the streaming form).

    Streaming session aggregates need a real key column; a keyless stream
    gets a constant one.
    """
    ks = list(keys)
    if not ks:
        df = df.withColumn("__all", F.lit(0))
        ks = ["__all"]
    g = df.groupBy(*ks, F.session_window(ts, gap).alias("window")).agg(_count(predicate, name))
    out = flatten_window(g).select(*ks, "window_start", "window_end", name)
    return out.drop("__all")


# --- W8 -------------------------------------------------------------------------

def count_windows(df: DataFrame, every: int, predicate: Column | None = None,
                  purge: bool = False, keys: Sequence[str] = (),
                  order: Sequence[str] = ("ts", "event_id"), bucket: str | None = None,
                  name: str = "n") -> DataFrame:
    """A global window that fires every ``every`` rows.

    Accumulating (``purge=False``): the k-th firing reports the count over
    the first ``k * every`` rows. Purging: over rows ``(k-1)*every+1 .. k*every``.
    A trailing remainder (< every rows) never fires.
    """
    hit = F.lit(1) if predicate is None else F.when(F.coalesce(predicate, F.lit(False)), 1).otherwise(0)
    r = ordered.running_sums(df, {"__rn": F.lit(1).cast("long"), "__c": hit.cast("long")},
                             order=order, keys=keys, bucket=bucket)
    if not purge:
        return (r.filter(F.col("__rn") % every == 0)
                 .select(*keys, (F.col("__rn") / every).cast("long").alias("firing_no"),
                         F.col("__c").alias(name)))
    grp = ((F.col("__rn") - 1) / every).cast("long") + 1
    g = (r.withColumn("firing_no", grp)
          .groupBy(*keys, "firing_no")
          .agg(F.count(F.lit(1)).alias("__size"), F.sum(hit.cast("long")).alias(name)))
    return g.filter(F.col("__size") == every).select(*keys, "firing_no", name)


# --- W9 -------------------------------------------------------------------------

def arrival_time_count(df: DataFrame, size: str, keys: Sequence[str] = (), name: str = "n") -> DataFrame:
    """Tumbling window on processing (arrival) time. Non-deterministic by
    nature: a micro-batch shares one arrival time. On a stream old windows are
    dropped by a watermark of a minute."""
    d = df.withColumn("arrival_ts", F.current_timestamp())
    if df.isStreaming:
        d = d.withWatermark("arrival_ts", "1 minute")
    return tumbling_count(d, size, None, keys, ts="arrival_ts", name=name)


# --- W10 / W11 ----------------------------------------------------------------------

def early_count(df: DataFrame, size: str, every: int, purge: bool = False,
                keys: Sequence[str] = (), order: Sequence[str] = ("ts", "event_id"),
                bucket: str | None = None, name: str = "n") -> DataFrame:
    """A count trigger inside a tumbling window.

    Fires after every ``every``-th row of a window. Accumulating emits the
    running count (5, 10, ...); purging emits ``every`` each time. Rows left
    over after the last firing never emit (the trigger replaces the
    end-of-window firing). The row number inside a window is bucketed on a
    finer time grid, so a hot window is split over many tasks.
    """
    size_us = interval_us(size)
    b = bucket or max(1, size_us // 16)
    w = df.withColumn("__w", F.window(order[0], size))
    w = w.select("*", F.col("__w.start").alias("window_start"), F.col("__w.end").alias("window_end")).drop("__w")
    r = ordered.row_numbers(w, "__rn", order=order, keys=[*keys, "window_start"], bucket=b)
    r = r.filter(F.col("__rn") % every == 0)
    val = F.lit(every).cast("long") if purge else F.col("__rn")
    return r.select(*keys, "window_start", "window_end",
                    (F.col("__rn") / every).cast("long").alias("firing_no"), val.alias(name))


# --- W12 ------------------------------------------------------------------------

def drain_windows(batch_counts: DataFrame, emitted: DataFrame,
                  keys: Sequence[str] = ()) -> DataFrame:
    """W12 at end of input: the windows a bounded stream left open (not yet
    emitted in append mode) are taken from the batch form and added."""
    on = [*keys, "window_start", "window_end"]
    missing = batch_counts.join(emitted.select(*on), on=on, how="left_anti")
    return emitted.unionByName(missing)


# --- W13 ------------------------------------------------------------------------

def busiest_window(df: DataFrame, size: str, slide: str, predicate: Column | None = None,
                   ts: str = "ts", name: str = "n") -> DataFrame:
    """The sliding window with most rows (filter first), earliest start
    on ties. A top-1 (``TakeOrderedAndProject``), computed in the cluster."""
    d = df if predicate is None else df.filter(predicate)
    c = sliding_count(d, size, slide, None, ts=ts, name=name)
    return c.orderBy(F.col(name).desc(), F.col("window_start").asc()).limit(1)


# --- W14 ------------------------------------------------------------------------

def apply_per_window(df: DataFrame, size: str, acc: Accumulator, keys: Sequence[str] = (),
                     ts: str = "ts", slide: str | None = None) -> DataFrame:
    """A user function that sees every element of each window.

    It is given as an :class:`Accumulator` (zero / add / merge / result), so
    each task folds its own rows and only small partial states are shuffled:
    no window's rows are ever gathered into one task.
    """
    win = F.window(ts, size) if slide is None else F.window(ts, size, slide)
    d = df.withColumn("__w", win)
    d = d.select("*", F.col("__w.start").alias("window_start"), F.col("__w.end").alias("window_end")).drop("__w")
    return aggregate(d, [*keys, "window_start", "window_end"], acc)
