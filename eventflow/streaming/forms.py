"""Streaming (T) forms of the operators.

Keyed state programs run as ``transformWithStateInPandas`` on the key; a call
holds one key's rows of one micro-batch. Running values (A1, A4-A6, A8-A10, W8)
do NOT funnel a key, or a stream without one, into one task: each micro-batch is
computed in parallel with the batch operator, and only the small carry (sums
so far) passes from one micro-batch to the next, kept per batch id in the
query's checkpoint (:mod:`eventflow.streaming.carry`). More carried forms are in
:mod:`eventflow.streaming.keyed`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from eventflow import schemas as S
from eventflow.functions.expressions import share_percent
from eventflow.functions.time import epoch_us, from_epoch_us, interval_us, time_literal, to_ntz
from eventflow.operators import ordered
from eventflow.operators.joins import changing_threshold
from eventflow.operators.routing import route
from eventflow.operators.windows import with_event_time
from eventflow.streaming.carry import CarryLog, carried
from eventflow.streaming.processors import ListSize, RunningCount, TypeCounts


def _out_schema(df: DataFrame, key: str, *names: str) -> StructType:
    return StructType([StructField("event_id", LongType()), df.schema[key]]
                      + [StructField(n, LongType()) for n in names])


def stream_running_count(stream: DataFrame, key: str = "user_id", name: str = "n",
                         limit: int | None = None) -> DataFrame:
    """A4 (A8 with ``limit``) as a value-state program."""
    d = stream.select("event_id", "ts", key)
    return d.groupBy(key).transformWithStateInPandas(
        RunningCount(key, name, limit), _out_schema(d, key, name), "Append", "None")


def stream_list_size(stream: DataFrame, key: str = "user_id", name: str = "n",
                     ttl: str | None = None, max_items: int | None = None) -> DataFrame:
    """A6 (A7 with ``ttl``, processing time) as a list-state program. With
    ``max_items`` the list keeps the newest ``max_items`` events."""
    d = stream.select("event_id", "ts", key)
    ttl_ms = interval_us(ttl) // 1000 if ttl else None
    mode = "ProcessingTime" if ttl else "None"
    return d.groupBy(key).transformWithStateInPandas(
        ListSize(key, name, ttl_ms, max_items), _out_schema(d, key, name), "Append", mode)


def stream_type_counts(stream: DataFrame, key: str = "user_id",
                       types=(S.ADD, S.REMOVED), columns=("n_add", "n_removed")) -> DataFrame:
    """A5 as a map-state program, one output column per type."""
    d = stream.select("event_id", "ts", key, "event_type")
    return d.groupBy(key).transformWithStateInPandas(
        TypeCounts(list(types), list(columns), key), _out_schema(d, key, *columns), "Append", "None")


def stream_high_quantity(cart_stream: DataFrame, threshold: int = 5, key: str = "user_id") -> DataFrame:
    """Filter (JVM side) then a value-state count per user."""
    q = cart_stream.filter((F.col("event_type") == S.ADD) & (F.col("quantity") > threshold))
    return stream_running_count(q, key)


def early_count_fn(size: str, every: int, purge: bool = False, delay: str = "1 minute", view=None):
    """A count trigger per tumbling window, as a carried batch.

    A firing depends on a window's row count alone, so each micro-batch is a
    partial aggregate per window joined with the counts of the windows still
    open; no window is one task's group. A window closes once the watermark
    (largest event time of the batches before, less ``delay``) reaches its
    end; rows of closed windows are late and dropped, rows older than the
    watermark whose window is open count. The counts of open windows are
    written per batch id, and only the previous batch's are read.
    """
    from eventflow.sources.views import cart_events
    view = view or cart_events
    size_us, delay_us = interval_us(size), interval_us(delay)

    @carried
    def fn(batch: DataFrame, batch_id: int, path: str, log: CarryLog) -> None:
        spark = batch.sparkSession
        rows = view(batch)
        us = epoch_us("ts", rows)
        counts = (rows.select((us - F.pmod(us, F.lit(size_us))).alias("ws"), us.alias("us"))
                  .groupBy("ws").agg(F.count(F.lit(1)).alias("c"), F.max("us").alias("top")))
        before = log.read("open", batch_id, "ws long, n long")
        mark = log.read_value("top", batch_id)
        closed = None if mark is None else mark - delay_us
        if closed is not None:
            counts = counts.filter(F.col("ws") + F.lit(size_us) > F.lit(closed))
        old = before.select(F.col("ws").alias("ws0"), F.col("n").alias("n0"))
        joined = counts.join(old, F.col("ws") == F.col("ws0"), "full_outer").select(
            F.coalesce("ws", "ws0").alias("ws"), F.coalesce("n0", F.lit(0)).alias("n0"),
            (F.coalesce("n0", F.lit(0)) + F.coalesce("c", F.lit(0))).alias("n"), "top").persist()  # a row an open window
        try:
            fired = F.sequence(F.floor(F.col("n0") / every) + 1, F.floor(F.col("n") / every))
            out = (joined.filter(F.floor(F.col("n") / every) > F.floor(F.col("n0") / every))
                   .select(F.col("ws").alias("window_start_us"), (F.col("ws") + F.lit(size_us)).alias("window_end_us"),
                           F.explode(fired).alias("firing_no"))
                   .withColumn("n", F.lit(every).cast("long") if purge else F.col("firing_no") * F.lit(every)))
            out.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
            top = joined.agg(F.max("top").alias("top")).first()["top"]
            top = max([x for x in (top, mark) if x is not None], default=None)
            log.write("open", batch_id, joined.filter(
                F.col("ws") + F.lit(size_us) > F.lit(-2 ** 62 if top is None else top - delay_us)).select("ws", "n"))
        finally:
            joined.unpersist()
        log.write_value("top", batch_id, top)
        log.finish(batch_id)

    return fn


def early_count_output(df: DataFrame) -> DataFrame:
    return df.select(from_epoch_us(F.col("window_start_us")).alias("window_start"),
                     from_epoch_us(F.col("window_end_us")).alias("window_end"), "firing_no", "n")


def stream_tumbling_count(stream: DataFrame, size: str, predicate: Column | None = None,
                          delay: str = "500 milliseconds") -> DataFrame:
    """S8 + W1 + W12: event-time tumbling count, emitted once per window when
    the watermark passes its end (append mode)."""
    d = with_event_time(stream, "ts", delay)
    agg = (F.count(F.lit(1)) if predicate is None
           else F.count_if(F.coalesce(predicate, F.lit(False)))).alias("n")
    g = d.groupBy(F.window("event_time", size).alias("w")).agg(agg)
    return g.select(to_ntz(F.col("w.start")).alias("window_start"),
                    to_ntz(F.col("w.end")).alias("window_end"), "n")


def stream_interval_join(left: DataFrame, right: DataFrame, lower: str, upper: str,
                         delay: str = "1 hour", lower_inclusive: bool = True,
                         upper_inclusive: bool = True) -> DataFrame:
    """J3 as a stream-stream join: both sides watermarked, key equality plus
    the time range, so Spark can drop buffered rows once they can no longer
    match. ``left``: (left_id, user_id, ts); ``right``: (right_id, r_user_id, ts)."""
    lo, hi = interval_us(lower), interval_us(upper)
    l2 = with_event_time(left, "ts", delay, "l_time").withColumnRenamed("ts", "left_ts")
    r2 = with_event_time(right, "ts", delay, "r_time").withColumnRenamed("ts", "right_ts")
    lo_e = F.col("l_time") + F.expr(f"INTERVAL '{lo} microseconds'") if lo >= 0 else \
        F.col("l_time") - F.expr(f"INTERVAL '{-lo} microseconds'")
    hi_e = F.col("l_time") + F.expr(f"INTERVAL '{hi} microseconds'") if hi >= 0 else \
        F.col("l_time") - F.expr(f"INTERVAL '{-hi} microseconds'")
    c_lo = F.col("r_time") >= lo_e if lower_inclusive else F.col("r_time") > lo_e
    c_hi = F.col("r_time") <= hi_e if upper_inclusive else F.col("r_time") < hi_e
    j = l2.join(r2, (F.col("user_id") == F.col("r_user_id")) & c_lo & c_hi, "inner")
    return j.select("user_id", "left_id", "right_id", "left_ts", "right_ts")


# ---------------------------------------------------------------- carried state

def running_share_batch(events_batch: DataFrame, carry: dict, bucket: str | None = None) -> tuple[DataFrame, DataFrame]:
    """One micro-batch of A10 given the counts carried from earlier batches."""
    from eventflow.sources.views import cart_events, catalog_events
    order = ("ts", "event_id")
    u = (cart_events(events_batch).select(*order).withColumn("side", F.lit("left"))
         .unionByName(catalog_events(events_batch).select(*order).withColumn("side", F.lit("right"))))
    r = ordered.running_sums(u, {
        "n_left": F.when(F.col("side") == "left", 1).otherwise(0).cast("long"),
        "n_right": F.when(F.col("side") == "right", 1).otherwise(0).cast("long")}, order, (), bucket)
    nl = F.col("n_left") + F.lit(carry["n_left"])
    nr = F.col("n_right") + F.lit(carry["n_right"])
    out = r.select("event_id", share_percent(nl, nr).alias("share"))
    totals = u.agg(F.count_if(F.col("side") == "left").alias("n_left"),
                   F.count_if(F.col("side") == "right").alias("n_right"))
    return out, totals


def count_windows_batch(events_batch: DataFrame, carry: dict, every: int,
                        bucket: str | None = None) -> tuple[DataFrame, DataFrame]:
    """One micro-batch of W8 (accumulating) given (rows, hits) carried."""
    from eventflow.sources.views import server_events
    s = server_events(events_batch)
    hit = F.when(F.col("event_type") == S.REGISTERED, 1).otherwise(0).cast("long")
    r = ordered.running_sums(s, {"__rn": F.lit(1).cast("long"), "__c": hit}, ("ts", "event_id"), (), bucket)
    rn = F.col("__rn") + F.lit(carry["rows"])
    out = (r.filter(rn % every == 0)
            .select((rn / every).cast("long").alias("firing_no"),
                    (F.col("__c") + F.lit(carry["hits"])).alias("n")))
    totals = s.agg(F.count(F.lit(1)).alias("rows"), F.sum(hit).alias("hits"))
    return out, totals


def carried_batch_fn(step, names: list[str], **kw):
    """Wrap a (batch, carry) -> (out, totals) step as an idempotent foreachBatch."""
    @carried
    def fn(batch: DataFrame, batch_id: int, path: str, log: CarryLog) -> None:
        batch.persist()
        try:
            row = log.read("counters", batch_id, ", ".join(f"{n} long" for n in names)).first()
            carry = {n: 0 if row is None else int(row[n]) for n in names}
            out, totals = step(batch, carry, **kw)
            out.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
            t = totals.collect()[0]
            values = tuple(carry[n] + int(t[n] or 0) for n in names)
            log.write("counters", batch_id, batch.sparkSession.createDataFrame([values], ", ".join(f"{n} long" for n in names)).coalesce(1))
            log.finish(batch_id)
        finally:
            batch.unpersist()
    return fn


def changing_threshold_fn(rules_loader, default: int = 0, bucket: str | None = None, view=None, lookback: str = "1 day"):
    """J6 stream (a rule stream has no broadcast state in Spark).

    Each micro-batch reads the rules in force over its own time span: those
    from ``lookback`` before its oldest event up to its newest, with both
    bounds pushed into the scan of the rule table. The newest rule at or
    before the oldest event is the one to start from; only if the lookback
    holds none are older rules read. Nothing is carried between batches, so
    events and rules that arrive late or out of order get the threshold of
    their own time, as in the batch form.
    """
    from eventflow.sources.views import cart_events
    view = view or cart_events

    def fn(batch: DataFrame, batch_id: int, path: str) -> None:
        spark = batch.sparkSession
        batch.persist()
        try:
            cart = view(batch)
            us = epoch_us("ts", cart)
            span = cart.agg(F.min(us).alias("lo"), F.max(us).alias("hi")).first()
            if span["hi"] is None:
                return
            lo, hi = int(span["lo"]), int(span["hi"])
            rules = rules_loader(spark)
            at = F.col("effective_ts")

            def until(x):
                return at <= time_literal(x, rules, "effective_ts")

            def newest(r):
                return r.agg(F.max_by("value", F.struct(epoch_us("effective_ts", r), F.col("rule_id"))).alias("v")).first()["v"]

            near = rules.filter(until(hi) & ~until(lo - interval_us(lookback)))
            start = newest(near.filter(until(lo)))
            if start is None:
                start = newest(rules.filter(until(lo - interval_us(lookback))))
            out = changing_threshold(cart, near.filter(~until(lo)), default=default if start is None else int(start),
                                     with_message=False, bucket=bucket)
            (out.select("event_id", "user_id", "quantity", "threshold")
                .write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}"))
        finally:
            batch.unpersist()
    return fn


def stream_rolling_sum(stream: DataFrame, value: str, key: str = "user_id", name: str = "running") -> DataFrame:
    """A1: the key's running sum after every row, a value-state program."""
    d = stream.select("event_id", "ts", key, F.col(value).cast("long").alias("amount"))
    return d.groupBy(key).transformWithStateInPandas(
        RunningCount(key, name, None, "amount"), _out_schema(d, key, name), "Append", "None")


def stream_final_sum(stream: DataFrame, value: str, key: str = "user_id", name: str = "total") -> DataFrame:
    """A2: the reduce's value per key so far, a native aggregate (update mode
    emits the keys a micro-batch changed)."""
    return stream.groupBy(key).agg(F.sum(F.col(value).cast("long")).alias(name))


def side_output_fn(predicate: Column, view):
    """Each micro-batch written once, partitioned by route: two outputs from one pass."""
    def fn(batch: DataFrame, batch_id: int, path: str) -> None:
        (route(view(batch), predicate).withColumn("batch_id", F.lit(batch_id))
         .write.mode("overwrite").partitionBy("route").parquet(f"{path}/out_batch={batch_id}"))
    return fn


def stream_window_join(left: DataFrame, right: DataFrame, size: str, delay: str = "1 hour") -> DataFrame:
    """J2 as a stream-stream join on key and window; the watermarks let Spark
    drop buffered windows. ``left``: (left_id, user_id, ts); ``right``: (right_id, r_user_id, ts)."""
    l2 = with_event_time(left, "ts", delay, "l_time").select("left_id", "user_id", F.window("l_time", size).alias("w"))
    r2 = with_event_time(right, "ts", delay, "r_time").select("right_id", "r_user_id", F.window("r_time", size).alias("rw"))
    j = l2.join(r2, (F.col("user_id") == F.col("r_user_id")) & (F.col("w") == F.col("rw")), "inner")
    return j.select(to_ntz(F.col("w.start")).alias("window_start"), to_ntz(F.col("w.end")).alias("window_end"),
                    "user_id", "left_id", "right_id")


def purged_windows_batch(events_batch: DataFrame, carry: dict, every: int,
                         bucket: str | None = None) -> tuple[DataFrame, DataFrame]:
    """One micro-batch of W8 purging: hits of each block of ``every`` rows; the
    rows and hits of the block that is still open are carried."""
    from eventflow.sources.views import server_events
    s = server_events(events_batch)
    hit = F.when(F.col("event_type") == S.REGISTERED, 1).otherwise(0).cast("long")
    r = ordered.row_numbers(s, "__rn", ("ts", "event_id"), (), bucket)
    block = F.floor((F.col("__rn") + F.lit(carry["rows"]) - 1) / every) + 1
    blocks = r.groupBy(block.alias("firing_no")).agg(F.count(F.lit(1)).alias("c"), F.sum(hit).alias("n"))
    first = carry["rows"] // every + 1
    open_rows = carry["rows"] % every
    c = F.col("c") + F.when(F.col("firing_no") == first, F.lit(open_rows)).otherwise(0)
    n = F.col("n") + F.when(F.col("firing_no") == first, F.lit(carry["open_hits"])).otherwise(0)
    full = blocks.select("firing_no", c.alias("c"), n.alias("n"))
    out = full.filter(F.col("c") == every).select("firing_no", "n")
    rest = full.filter(F.col("c") < every).agg(F.sum("n").alias("h"))
    total = s.agg(F.count(F.lit(1)).alias("rows"))
    # counters are added to the carry, so the open block's hits are given as a difference
    left = F.when(F.col("rows") == 0, F.lit(0)).otherwise(F.coalesce("h", F.lit(0)) - F.lit(carry["open_hits"]))
    return out, total.join(rest, F.lit(True)).select("rows", left.alias("open_hits"))
