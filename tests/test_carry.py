"""Carried streaming forms: equal to the batch forms over slices, through stops and resumes, with late rows and hot keys."""

from __future__ import annotations

import os
import random
import shutil
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from eventflow import schemas as S
from eventflow.operators import aggregate, joins, running, windows
from eventflow.operators.aggregate import CountIf
from eventflow.sinks.rich import LineFileSink, run_rich_sink
from eventflow.sources.views import cart_events, catalog_events, server_events
from eventflow.streaming import connected, forms, keyed
from eventflow.streaming.carry import CarryLog, CarryLost
from eventflow.streaming.replay import replay_dir
from eventflow.streaming.runner import run_available_now, run_foreach_batch

BASE = datetime(2024, 1, 1)
SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
RNG = random.Random(5)


def raw_events(n=300, users=(1, 1, 1, 2, 3, None), minutes=3):
    kinds = ["purchase", "click", "view", "signup", "error"]
    return [(i, BASE + timedelta(seconds=RNG.randrange(60 * minutes * n)), RNG.choice(users), RNG.choice(kinds), 0.0,
             '{"k": %d}' % RNG.randrange(20)) for i in range(n)]


EVENTS = raw_events()


def slices(rows, k):
    rows = sorted(rows, key=lambda r: (r[1], r[0]))
    return [rows[i * len(rows) // k:(i + 1) * len(rows) // k] for i in range(k)]


def add(spark, src, rows, order):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(src)
    for f in os.listdir(src):
        if f.endswith(".parquet") and f not in order:
            order.append(f)
            os.utime(f"{src}/{f}", (time.time() - 1000 + len(order),) * 2)


def stream(spark, src):
    return replay_dir(spark, src, spark.createDataFrame([], SCHEMA).schema, max_files_per_trigger=1)


def rows_at(df, cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def batch_forms(ev):
    cart, server, reg = cart_events(ev), server_events(ev), F.col("event_type") == S.REGISTERED
    counts = running.running_type_counts(cart)
    return {
        "rolling_sum": (keyed.rolling_sum_fn(cart_events, "quantity"), running.rolling_reduce(cart, "user_id", "quantity"), ["event_id", "user_id", "running"]),
        "running_count": (keyed.running_count_fn(cart_events), running.running_count(cart), ["event_id", "user_id", "n"]),
        "reset": (keyed.running_count_fn(cart_events, limit=4), running.count_with_reset(cart, limit=4), ["event_id", "user_id", "n"]),
        "list": (keyed.running_count_fn(cart_events, max_items=5), running.running_list_size(cart, max_items=5), ["event_id", "user_id", "n"]),
        "types": (keyed.type_counts_fn(cart_events), counts.select("event_id", "user_id", F.col("counts")[S.ADD].alias("n_add"),
                                                                   F.col("counts")[S.REMOVED].alias("n_removed")), ["event_id", "user_id", "n_add", "n_removed"]),
        "high": (keyed.high_quantity_fn(cart_events, 5), running.high_quantity_counts(cart, 5), ["event_id", "user_id", "n"]),
        "share": (forms.carried_batch_fn(forms.running_share_batch, ["n_left", "n_right"]), running.running_share(cart, catalog_events(ev)), ["event_id", "share"]),
        "count_windows": (forms.carried_batch_fn(forms.count_windows_batch, ["rows", "hits"], every=7), windows.count_windows(server, 7, reg), ["firing_no", "n"]),
        "purged": (forms.carried_batch_fn(forms.purged_windows_batch, ["rows", "open_hits"], every=7), windows.count_windows(server, 7, reg, purge=True), ["firing_no", "n"]),
        "early": (forms.early_count_fn("1 hour", 3), windows.early_count(cart, "1 hour", 3).withColumn("firing_no", F.col("firing_no").cast("long")),
                  ["window_start", "window_end", "firing_no", "n"]),
        "early_purged": (forms.early_count_fn("1 hour", 3, purge=True), windows.early_count(cart, "1 hour", 3, purge=True), ["window_start", "window_end", "firing_no", "n"]),
    }


CARRIED = ["rolling_sum", "running_count", "reset", "list", "types", "high", "share", "count_windows", "purged", "early", "early_purged"]


@pytest.mark.parametrize("name", CARRIED)
def test_stopped_and_resumed_with_only_the_checkpoint(spark, tmp_dir, name):
    """Five slices; the query is stopped after two and goes on with a new output folder. All rows equal the batch form's."""
    src, ckpt, order = f"{tmp_dir}/src", f"{tmp_dir}/ckpt", []
    parts = slices(EVENTS, 5)
    fn, want, cols = batch_forms(spark.createDataFrame(EVENTS, SCHEMA))[name]
    got = []
    for k, group in enumerate((parts[:2], parts[2:])):
        for part in group:
            add(spark, src, part, order)
        path = run_foreach_batch(stream(spark, src), name, fn, path=f"{tmp_dir}/out{k}", checkpoint=ckpt)
        out = spark.read.parquet(path)
        got += rows_at(forms.early_count_output(out) if name.startswith("early") else out, cols)
    assert sorted(got, key=repr) == rows_at(want, cols) and got
    names = os.listdir(f"{ckpt}/carry/done")  # old batches are gone
    assert sorted(names) == ["3", "4"]


@pytest.mark.parametrize("name", ["running_count", "share", "early"])
def test_a_lost_carry_is_an_error(spark, tmp_dir, name):
    src, order = f"{tmp_dir}/src", []
    parts = slices(EVENTS, 2)
    fn = batch_forms(spark.createDataFrame(EVENTS, SCHEMA))[name][0]
    add(spark, src, parts[0], order)
    run_foreach_batch(stream(spark, src), name, fn, path=f"{tmp_dir}/out", checkpoint=f"{tmp_dir}/ckpt")
    shutil.copytree(f"{tmp_dir}/ckpt", f"{tmp_dir}/bare", ignore=shutil.ignore_patterns("carry"))
    add(spark, src, parts[1], order)
    with pytest.raises(CarryLost):  # before the query starts
        run_foreach_batch(stream(spark, src), name, fn, path=f"{tmp_dir}/out2", checkpoint=f"{tmp_dir}/bare")
    with pytest.raises(CarryLost):  # and in a batch that finds none
        fn(spark.createDataFrame(parts[1], SCHEMA), 1, f"{tmp_dir}/out3", CarryLog(spark, f"{tmp_dir}/bare"))


def test_a_replayed_batch_changes_nothing(spark, tmp_dir):
    log, fn = CarryLog(spark, f"{tmp_dir}/ckpt"), keyed.running_count_fn(cart_events)
    parts = slices(EVENTS, 3)
    for batch_id, k in enumerate((0, 1, 1, 2, 2)):  # batches 1 and 2 run twice
        fn(spark.createDataFrame(parts[k], SCHEMA), k, f"{tmp_dir}/out", log)
    want = running.running_count(cart_events(spark.createDataFrame(EVENTS, SCHEMA)))
    assert rows_at(spark.read.parquet(f"{tmp_dir}/out"), ["event_id", "n"]) == rows_at(want, ["event_id", "n"])


def test_a_batch_rewrites_touched_buckets_only(spark, tmp_dir):
    log, fn = CarryLog(spark, f"{tmp_dir}/ckpt"), keyed.running_count_fn(cart_events)
    rows = [(i, BASE + timedelta(seconds=i), i, "click", 0.0, '{"k": 1}') for i in range(200)]
    fn(spark.createDataFrame(rows, SCHEMA), 0, f"{tmp_dir}/out", log)
    fn(spark.createDataFrame([(900, BASE + timedelta(days=1), 7, "click", 0.0, '{"k": 1}')], SCHEMA), 1, f"{tmp_dir}/out", log)
    made = [d for d in os.listdir(f"{tmp_dir}/ckpt/carry/keyed/running/data/batch_id=1") if d.startswith("__bucket")]
    assert len(made) == 1
    fn(spark.createDataFrame([(901, BASE + timedelta(days=2), u, "click", 0.0, '{"k": 1}') for u in (7, 8)], SCHEMA), 2, f"{tmp_dir}/out", log)
    got = {(r["event_id"], r["user_id"]): r["n"] for r in spark.read.parquet(f"{tmp_dir}/out").where("event_id >= 900").collect()}
    assert got == {(900, 7): 2, (901, 7): 3, (901, 8): 2}


def test_one_key_is_many_tasks(spark, tmp_dir):
    """A micro-batch of one key: its rows are computed in more than one task."""
    rows = [(i, BASE + timedelta(minutes=i), 1, "click", 0.0, '{"k": 1}') for i in range(2000)]
    seen = []
    fn = keyed.keyed_running_fn(cart_events, {"c": F.lit(1).cast("long")}, lambda r: seen.append(r) or r.select("event_id", "c"))
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        log = CarryLog(spark, f"{tmp_dir}/ckpt")
        for b in (0, 1):
            fn(spark.createDataFrame(rows[b * 1000:(b + 1) * 1000], SCHEMA), b, f"{tmp_dir}/out", log)
        tasks = [f for f in os.listdir(f"{tmp_dir}/out/batch_id=1") if f.startswith("part-")]
        assert len(tasks) > 1 and sorted(r["c"] for r in spark.read.parquet(f"{tmp_dir}/out").collect()) == list(range(1, 2001))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def late_parts(rows, delay_s):
    """Slices in which rows come up to ``delay_s`` late."""
    moved = sorted(rows, key=lambda r: (r[1].timestamp() + RNG.random() * delay_s, r[0]))
    return [moved[i * len(moved) // 5:(i + 1) * len(moved) // 5] for i in range(5)]


def run_parts(spark, tmp_dir, parts, fn, stop=3):
    src, order, outs = f"{tmp_dir}/src", [], []
    for k, group in enumerate((parts[:stop], parts[stop:])):
        for part in group:
            add(spark, src, part, order)
        outs.append(run_foreach_batch(stream(spark, src), "t", fn, path=f"{tmp_dir}/out{k}", checkpoint=f"{tmp_dir}/ckpt"))
    return outs


def test_retention_equals_batch_with_late_rows(spark, tmp_dir):
    fn = keyed.retained_count_fn(cart_events, "user_id", "2 hours", "3 hours")
    outs = run_parts(spark, tmp_dir, late_parts(EVENTS, 3 * 3600 - 1), fn)
    got = [r for o in outs for r in rows_at(spark.read.parquet(o), ["event_id", "user_id", "n"])]
    cart = cart_events(spark.createDataFrame(EVENTS, SCHEMA))
    top = max(r["ts"] for r in cart.collect())
    want = running.retained_count(cart, retention="2 hours").where(F.col("ts") <= F.lit(top - timedelta(hours=3)).cast("timestamp_ntz"))
    assert sorted(got, key=repr) == rows_at(want, ["event_id", "user_id", "n"]) and len(got) > 50


def test_retention_drops_what_the_watermark_has_passed(spark, tmp_dir):
    log, fn = CarryLog(spark, f"{tmp_dir}/ckpt"), keyed.retained_count_fn(cart_events, "user_id", "1 hour", "10 minutes")
    at = lambda i, m: (i, BASE + timedelta(minutes=m), 1, "click", 0.0, '{"k": 1}')
    for b, rows in enumerate(([at(1, 0), at(2, 30)], [at(3, 25), at(4, 20), at(5, 19), at(6, 90)], [at(7, 200)])):
        fn(spark.createDataFrame(rows, SCHEMA), b, f"{tmp_dir}/out", log)
    # 20 and 19 minutes are not behind 30 - 10; 30 and 25 are pending until 90 comes
    assert rows_at(spark.read.parquet(f"{tmp_dir}/out"), ["event_id", "n"]) == [(1, 1), (2, 3), (3, 2), (6, 1)]


def test_window_aggregate_over_late_slices(spark, tmp_dir):
    fn = keyed.window_aggregate_fn(server_events, "1 hour", CountIf("event_type", S.REGISTERED, "n"), "3 hours")
    outs = run_parts(spark, tmp_dir, late_parts(EVENTS, 3 * 3600 - 1), fn)
    cols = ["window_start", "window_end", "n"]
    got = [r for o in outs for r in rows_at(spark.read.parquet(o), cols)]
    server = server_events(spark.createDataFrame(EVENTS, SCHEMA))
    top = max(r["ts"] for r in server.collect())
    want = windows.tumbling_count(server, "1 hour", F.col("event_type") == S.REGISTERED).where(
        F.col("window_end") <= F.lit(top - timedelta(hours=3)).cast("timestamp_ntz"))
    assert sorted(got, key=repr) == rows_at(want, cols) and len(got) > 5


class Longest(aggregate.Accumulator):
    """Not a sum: the longest name and how many rows."""

    from pyspark.sql.types import LongType, StringType, StructField
    acc_fields = [StructField("name", StringType()), StructField("rows", LongType())]
    result_fields = acc_fields
    columns = ["nickname"]

    def zero(self):
        return {"name": "", "rows": 0}

    def add(self, acc, batch):
        return {"name": max([acc["name"], *batch["nickname"]], key=lambda s: (len(s), s)), "rows": acc["rows"] + len(batch)}

    def merge(self, a, b):
        return {"name": max(a["name"], b["name"], key=lambda s: (len(s), s)), "rows": int(a["rows"]) + int(b["rows"])}

    def result(self, acc):
        return acc


def test_one_hot_group_is_merged_in_two_steps(spark):
    df = spark.range(0, 5000, 1, 37).select(F.lit(1).alias("g"), F.concat(F.lit("u"), F.col("id").cast("string")).alias("nickname"))
    got = aggregate.aggregate(df, ["g"], Longest(), fan=4)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in got.collect()] == [(1, "u4999", 5000)]
    assert plan.count("FlatMapGroupsInPandas") == 2 and plan.count("MapInPandas") == 2
    middle = aggregate.partials(df, ["g"], Longest())
    assert middle.count() == 37 and aggregate.merged(middle, ["g"], Longest(), 4).count() == 1


@pytest.mark.parametrize("late", [0, 3600])
def test_sessions_without_a_key(spark, tmp_dir, late):
    gap = "7 minutes"
    parts = late_parts(EVENTS, late) if late else slices(EVENTS, 5)
    fn = keyed.session_count_fn(server_events, gap, F.col("event_type") == S.REGISTERED, f"{late} seconds")
    outs = run_parts(spark, tmp_dir, parts, fn)
    cols = ["window_start", "window_end", "n"]
    got = [r for o in outs for r in rows_at(spark.read.parquet(o), cols)]
    server = server_events(spark.createDataFrame(EVENTS, SCHEMA))
    top = max(r["ts"] for r in server.collect())
    want = windows.session_count(server, gap, predicate=F.col("event_type") == S.REGISTERED).where(
        F.col("window_end") <= F.lit(top - timedelta(seconds=late)).cast("timestamp_ntz"))
    assert sorted(got, key=repr) == rows_at(want, cols) and len(got) > 5


def test_a_long_open_session_stays_one(spark, tmp_dir):
    """A session over all micro-batches carries its start; the marks it is carried by do not grow with it."""
    log, fn = CarryLog(spark, f"{tmp_dir}/ckpt"), keyed.session_count_fn(server_events, "10 minutes", None, "0 seconds")
    for b in range(4):
        rows = [(100 * b + i, BASE + timedelta(minutes=9 * (20 * b + i)), 1, "view", 0.0, "{}") for i in range(20)]
        fn(spark.createDataFrame(rows, SCHEMA), b, f"{tmp_dir}/out", log)
    fn(spark.createDataFrame([(999, BASE + timedelta(days=5), 1, "view", 0.0, "{}")], SCHEMA), 4, f"{tmp_dir}/out", log)
    assert rows_at(spark.read.parquet(f"{tmp_dir}/out"), ["window_start", "window_end", "n"]) == [(BASE, BASE + timedelta(minutes=9 * 79 + 10), 80)]


def test_busiest_window_after_every_slice(spark, tmp_dir):
    reg = F.col("event_type") == S.REGISTERED
    parts = late_parts(EVENTS, 1800)
    outs = run_parts(spark, tmp_dir, parts, keyed.busiest_window_fn(server_events, "2 hours", "30 minutes", reg))
    cols = ["window_start", "window_end", "n"]
    so_far = []
    for k in range(5):
        so_far += parts[k]
        want = windows.busiest_window(server_events(spark.createDataFrame(so_far, SCHEMA)), "2 hours", "30 minutes", reg)
        assert rows_at(spark.read.parquet(f"{outs[k >= 3]}/batch_id={k}"), cols) == rows_at(want, cols)


def test_lateness_gate_golden_rows(spark, tmp_dir):
    """The watermark is the largest time - delay - 1 ms, emitted once a period; a row not behind it is late."""
    log, fn = CarryLog(spark, f"{tmp_dir}/ckpt"), keyed.lateness_gate_fn(lambda b: b, "500 milliseconds")
    at = lambda i, ms: (i, BASE + timedelta(milliseconds=ms), 1, "click", 0.0, "{}")
    for b, rows in enumerate(([at(1, 1000), at(2, 100)], [at(3, 499), at(4, 500), at(5, 3000), at(6, 0)], [at(7, 2499), at(8, 2500), (9, None, 1, "click", 0.0, "{}")])):
        fn(spark.createDataFrame(rows, SCHEMA), b, f"{tmp_dir}/out", log)
    out = spark.read.parquet(f"{tmp_dir}/out")
    us0 = int((BASE - datetime(1970, 1, 1)).total_seconds()) * 1_000_000
    got = {r["event_id"]: (r["late"], None if r["watermark_us"] is None else r["watermark_us"] - us0) for r in out.collect()}
    assert got == {1: (False, None), 2: (False, None), 3: (True, 499_000), 4: (False, 499_000), 5: (False, 499_000), 6: (True, 499_000),
                   7: (True, 2_499_000), 8: (False, 2_499_000), 9: (False, 2_499_000)}
    assert sorted(r["event_id"] for r in keyed.on_time(out).collect()) == [1, 2, 4, 5, 8, 9]


def test_two_inputs_equal_the_batch_form_over_slices(spark, tmp_dir):
    src, order = f"{tmp_dir}/src", []
    for part in slices(EVENTS, 3):
        add(spark, src, part, order)
    ev = stream(spark, src)
    out = connected.stream_connect_keyed(cart_events(ev), catalog_events(ev), "user_id", connected.SideShare())
    got = run_available_now(out, "two", path=f"{tmp_dir}/out")
    df = spark.createDataFrame(EVENTS, SCHEMA)
    cols = ["event_id", "user_id", "side", "share"]
    assert rows_at(got, cols) == rows_at(joins.connected_share(cart_events(df), catalog_events(df), "user_id"), cols)


def test_rich_sink_publishes_each_partition_of_an_epoch_once(spark, tmp_dir):
    sink = LineFileSink(f"{tmp_dir}/out", lambda r: f"{r[0]}")
    for error in (RuntimeError("died"), None, None):  # an attempt that dies, the next, and a replay
        if sink.open(3, 8):
            for i in range(4):
                sink.process((i,))
        sink.close(error)
    assert [f for f in os.listdir(f"{tmp_dir}/out")] == ["epoch-000000008-partition-000003.txt"]
    assert open(f"{tmp_dir}/out/epoch-000000008-partition-000003.txt").read() == "0\n1\n2\n3\n"
    src, order = f"{tmp_dir}/src", []
    for part in slices(EVENTS, 3):
        add(spark, src, part, order)
    run_rich_sink(stream(spark, src).select("event_id"), LineFileSink(f"{tmp_dir}/lines", lambda r: str(r.event_id)), f"{tmp_dir}/ckpt")
    assert sorted(int(r["value"]) for r in spark.read.text(f"{tmp_dir}/lines").collect()) == list(range(len(EVENTS)))
