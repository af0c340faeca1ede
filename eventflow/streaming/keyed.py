"""Streaming forms whose state is a carried table (see :mod:`eventflow.streaming.carry`).

* Keyed running values (A1, A4-A6, A8, A9): a micro-batch's bucketed running
  sums, begun at each key's carried sums. The per-key table lies in hash buckets
  and a batch rewrites the buckets it touches, so neither state nor a hot key's
  rows are ever one task's frame.
* Retention in event time (A7), user aggregates and whole-window functions
  (A3 / W14), keyless sessions (W7), the busiest window (W13), and a lateness
  gate with its own watermark rule (W2).

Event-time forms follow the largest event time of all micro-batches so far,
less ``delay``: results before it are final and are emitted, rows behind the
previous micro-batch's mark are late and dropped. Rows without a time count as
late there.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from eventflow import schemas as S
from eventflow.functions.time import epoch_us, from_epoch_us, interval_us
from eventflow.operators import aggregate as agg
from eventflow.operators import ordered, running
from eventflow.streaming.carry import CarryLog, carried

ORDER = ("ts", "event_id")


def keyed_running_fn(view: Callable[[DataFrame], DataFrame], sums: dict[str, Column], out: Callable[[DataFrame], DataFrame],
                     key: str = "user_id", bucket: str | int | None = None):
    """Running sums per key over all micro-batches; ``out`` turns the rows with their sums into the result.

    Micro-batches must be in time order for the result to equal the batch form.
    """
    @carried
    def fn(batch: DataFrame, batch_id: int, path: str, log: CarryLog) -> None:
        rows = view(batch).persist()
        try:
            totals = rows.groupBy(key).agg(*[F.coalesce(F.sum(e), F.lit(0)).cast("long").alias(n) for n, e in sums.items()])
            schema = StructType([rows.schema[key], *[StructField(n, LongType()) for n in sums]])
            old, touched, holders = log.read_keys("running", batch_id, totals, [key], schema)
            r = ordered.running_sums(rows, sums, ORDER, [key], bucket, start=old)
            out(r).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
            now = old.unionByName(totals).groupBy(key).agg(*[F.sum(n).alias(n) for n in sums])
            log.write_keys("running", batch_id, now, [key], touched, holders)
            log.finish(batch_id)
        finally:
            rows.unpersist()

    return fn


def rolling_sum_fn(view, value: str, key: str = "user_id", name: str = "running", bucket=None):
    """A1: the key's running sum after every row."""
    return keyed_running_fn(view, {name: F.coalesce(F.col(value), F.lit(0)).cast("long")}, lambda r: r.select("event_id", key, name), key, bucket)


def running_count_fn(view, key: str = "user_id", name: str = "n", limit: int | None = None, max_items: int | None = None, bucket=None):
    """A4: rows of the key so far; A8 with ``limit`` (a list cleared when it grows past it); A6 with ``max_items`` (a list's size)."""
    n = F.col("__rn")
    if limit is not None:
        n = F.pmod(n, F.lit(limit + 1))
    if max_items is not None:
        n = F.least(n, F.lit(max_items))
    return keyed_running_fn(view, {"__rn": F.lit(1).cast("long")}, lambda r: r.select("event_id", key, n.cast("long").alias(name)), key, bucket)


def type_counts_fn(view, key: str = "user_id", types=(S.ADD, S.REMOVED), columns=("n_add", "n_removed"), bucket=None):
    """A5: the key's count of each event type so far, null until the first."""
    sums = {c: F.when(F.col("event_type") == t, 1).otherwise(0).cast("long") for t, c in zip(types, columns)}
    return keyed_running_fn(view, sums, lambda r: r.select("event_id", key, *[F.nullif(F.col(c), F.lit(0).cast("long")).alias(c) for c in columns]),
                            key, bucket)


def high_quantity_fn(view, threshold: int = 5, key: str = "user_id", bucket=None):
    """Add events above the threshold so far, on those events."""
    return running_count_fn(lambda b: view(b).filter((F.col("event_type") == S.ADD) & (F.col("quantity") > threshold)), key, bucket=bucket)


# ------------------------------------------------------------------ event time

def _top(rows: DataFrame, mark: int | None, at: str = "at") -> int | None:
    got = rows.agg(F.max(at).alias("t")).first()["t"]
    return max([x for x in (got, mark) if x is not None], default=None)


def retained_count_fn(view, key: str = "user_id", retention: str = "1 hour", delay: str = "1 hour", name: str = "n", bucket=None):
    """A7 in event time: rows of the key younger than ``retention`` after each row, in the order of their times.

    A row is emitted once the watermark passes it, when no row in front of it
    can come any more: late rows count for all they are alive for. Carried are
    the rows that are still alive at the watermark or not emitted yet.
    """
    keep_us, delay_us = interval_us(retention), interval_us(delay)

    @carried
    def fn(batch: DataFrame, batch_id: int, path: str, log: CarryLog) -> None:
        rows = view(batch)
        kind = rows.schema[key].dataType.simpleString()
        schema = f"event_id long, `{key}` {kind}, at long"
        new = rows.select("event_id", key, epoch_us("ts", rows).alias("at")).where("at IS NOT NULL")
        before, mark = log.read("alive", batch_id, schema), log.read_value("top", batch_id)
        passed = None if mark is None else mark - delay_us
        if passed is not None:
            new = new.where(F.col("at") > F.lit(passed))
        every = before.unionByName(new).persist()
        try:
            top = _top(every, mark)
            now = -2 ** 62 if top is None else top - delay_us
            counted = running.retained_count(every, key, keep_us, name, "at", "event_id", bucket)
            due = (F.col("at") <= F.lit(now)) & (F.col("at") > F.lit(-2 ** 62 if passed is None else passed))
            counted.where(due).select("event_id", key, name).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
            log.write("alive", batch_id, every.where(F.col("at") > F.lit(now - keep_us)))
        finally:
            every.unpersist()
        log.write_value("top", batch_id, top)
        log.finish(batch_id)

    return fn


def window_aggregate_fn(view, size: str, acc: agg.Accumulator, delay: str = "500 milliseconds"):
    """A user accumulator per tumbling window, merged across micro-batches, its result emitted when the watermark
    reaches the window's end. Open windows' accumulators are carried."""
    size_us, delay_us = interval_us(size), interval_us(delay)
    keys = ["ws"]

    @carried
    def fn(batch: DataFrame, batch_id: int, path: str, log: CarryLog) -> None:
        rows = view(batch)
        us = epoch_us("ts", rows)
        rows = rows.withColumn("at", us).where("at IS NOT NULL").withColumn("ws", F.col("at") - F.pmod("at", F.lit(size_us))).persist()
        state = StructType([StructField("ws", LongType()), *acc.acc_fields])
        before, mark = log.read("open", batch_id, state), log.read_value("top", batch_id)
        try:
            top = _top(rows, mark)
            live = rows if mark is None else rows.where(F.col("ws") + F.lit(size_us) > F.lit(mark - delay_us))
            parts = agg.partials(live, keys, acc)
            now = agg.merged(before.unionByName(parts), keys, acc).persist()
            ended = F.col("ws") + F.lit(size_us) <= F.lit(-2 ** 62 if top is None else top - delay_us)
            done = agg.results(now.where(ended), keys, acc)
            names = [f.name for f in acc.result_fields]
            (done.select(from_epoch_us(F.col("ws")).alias("window_start"), from_epoch_us(F.col("ws") + F.lit(size_us)).alias("window_end"), *names)
             .write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}"))
            log.write("open", batch_id, now.where(~ended))
            now.unpersist()
        finally:
            rows.unpersist()
        log.write_value("top", batch_id, top)
        log.finish(batch_id)

    return fn


def session_count_fn(view, gap: str, predicate: Column | None = None, delay: str = "500 milliseconds", name: str = "n", bucket=None):
    """W7 without a key: sessions of each micro-batch by the bucketed sessionizer, emitted when the watermark reaches their end.

    Of an open session only its start, its last time and its count are carried.
    It meets the next micro-batch as a chain of marks no more than ``gap`` apart
    over the times that rows can still have, at most delay / gap + 3 of them.
    """
    gap_us, delay_us = interval_us(gap), interval_us(delay)

    @carried
    def fn(batch: DataFrame, batch_id: int, path: str, log: CarryLog) -> None:
        rows = view(batch)
        before, mark = log.read("open", batch_id, "start long, last long, n long"), log.read_value("top", batch_id)
        hit = F.lit(1) if predicate is None else F.when(F.coalesce(predicate, F.lit(False)), 1).otherwise(0)
        new = rows.select(epoch_us("ts", rows).alias("at"), hit.cast("long").alias("n")).where("at IS NOT NULL")
        if mark is not None:
            new = new.where(F.col("at") + F.lit(gap_us) > F.lit(mark - delay_us))
        new = new.persist()
        try:
            top = _top(new, mark)
            low = F.greatest("start", F.least("last", F.lit((mark or 0) - delay_us - 2 * gap_us)))
            marks = before.select(F.explode(F.array_union(F.sequence(low, F.col("last"), F.lit(gap_us)), F.array("last"))).alias("at"), "start", "last", "n")
            marks = marks.select("at", F.when(F.col("at") == F.col("last"), F.col("n")).otherwise(F.lit(0)).cast("long").alias("n"), "start")
            every = new.withColumn("start", F.col("at")).unionByName(marks)
            s = ordered.sessionize(every, gap_us, order=("at",), bucket=bucket or ordered.KEYLESS_BUCKET, name="sid")
            found = s.groupBy("sid").agg(F.min("start").alias("start"), F.max("at").alias("last"), F.sum("n").alias("n")).persist()
            ended = F.col("last") + F.lit(gap_us) <= F.lit(-2 ** 62 if top is None else top - delay_us)
            (found.where(ended).select(from_epoch_us(F.col("start")).alias("window_start"), from_epoch_us(F.col("last") + F.lit(gap_us)).alias("window_end"),
                                       F.col("n").alias(name)).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}"))
            log.write("open", batch_id, found.where(~ended).select("start", "last", "n"))
            found.unpersist()
        finally:
            new.unpersist()
        log.write_value("top", batch_id, top)
        log.finish(batch_id)

    return fn


def busiest_window_fn(view, size: str, slide: str, predicate: Column | None = None, delay: str = "1 hour", name: str = "n"):
    """After each micro-batch the sliding window with most rows so far (earliest start on ties).

    Carried are the counts of windows that can still grow and the best window so far, one row.
    """
    size_us, slide_us, delay_us = interval_us(size), interval_us(slide), interval_us(delay)
    best_first = [F.col("n").desc(), F.col("ws").asc()]

    @carried
    def fn(batch: DataFrame, batch_id: int, path: str, log: CarryLog) -> None:
        rows = view(batch)
        us = epoch_us("ts", rows)
        rows = rows.select(us.alias("at"), (F.lit(True) if predicate is None else F.coalesce(predicate, F.lit(False))).alias("hit")).where("at IS NOT NULL")
        mark = log.read_value("top", batch_id)
        top = _top(rows, mark)
        last = F.col("at") - F.pmod("at", F.lit(slide_us))
        steps = F.sequence(F.lit(0), F.floor((F.lit(size_us - 1) - F.pmod("at", F.lit(slide_us))) / F.lit(slide_us)).cast("int"))
        counts = (rows.where("hit").select(F.explode(F.transform(steps, lambda k: last - k * F.lit(slide_us).cast("long"))).alias("ws"))
                  .groupBy("ws").agg(F.count(F.lit(1)).alias("n")))
        if mark is not None:
            counts = counts.where(F.col("ws") + F.lit(size_us) > F.lit(mark - delay_us))
        now = (log.read("open", batch_id, "ws long, n long").unionByName(counts).groupBy("ws").agg(F.sum("n").alias("n"))).persist()
        try:
            best = log.read("best", batch_id, "ws long, n long").unionByName(now).orderBy(*best_first).limit(1)
            log.write("best", batch_id, best)
            kept = log.spark.read.schema("ws long, n long").parquet(f"{log.root}/tables/best/batch_id={batch_id}")
            (kept.select(from_epoch_us(F.col("ws")).alias("window_start"), from_epoch_us(F.col("ws") + F.lit(size_us)).alias("window_end"), F.col("n").alias(name))
             .write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}"))
            log.write("open", batch_id, now.where(F.col("ws") + F.lit(size_us) > F.lit(-2 ** 62 if top is None else top - delay_us)))
        finally:
            now.unpersist()
        log.write_value("top", batch_id, top)
        log.finish(batch_id)

    return fn


def lateness_gate_fn(view, delay: str, tick: str = "1 millisecond"):
    """A watermark generator of its own. Every row moves the largest time; once a period (a micro-batch) the watermark
    ``largest - delay - tick`` is emitted. Each row is written with the watermark it met and whether it is ``late`` (its time is
    not behind that watermark), so that windows downstream drop what the generator has passed."""
    delay_us, tick_us = interval_us(delay), interval_us(tick)

    @carried
    def fn(batch: DataFrame, batch_id: int, path: str, log: CarryLog) -> None:
        rows = view(batch)
        mark = log.read_value("top", batch_id)
        met = F.lit(None if mark is None else mark - delay_us - tick_us).cast("long")
        us = epoch_us("ts", rows)
        (rows.withColumn("watermark_us", met).withColumn("late", F.coalesce(us <= met, F.lit(False)))
         .write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}"))
        log.write_value("top", batch_id, _top(rows.select(us.alias("at")), mark))
        log.finish(batch_id)

    return fn


def on_time(gated: DataFrame) -> DataFrame:
    """The rows a lateness gate let through."""
    return gated.where(~F.col("late")).drop("late", "watermark_us")
