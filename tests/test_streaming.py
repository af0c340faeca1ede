"""Structured Streaming forms: golden append-mode windows, late data,
batch / stream parity over several, also unordered micro-batches, upserts,
progress callbacks."""

from __future__ import annotations

import os
import time

import pytest
from pyspark.sql import functions as F

from eventflow.operators import running, windows
from eventflow.streaming import forms
from eventflow.streaming.replay import replay, replay_dir
from eventflow.streaming.runner import run_available_now, run_foreach_batch, run_until_caught_up
from eventflow.streaming.runtime import attach_progress
from tests import fixtures as FX


def _write_slices(df, path, cuts):
    """Write df as successive time slices (one write each, increasing mtime)."""
    bounds = [None, *cuts, None]
    for i, (lo, hi) in enumerate(zip(bounds[:-1], bounds[1:])):
        part = df
        if lo is not None:
            part = part.filter(F.col("ts") >= F.lit(lo))
        if hi is not None:
            part = part.filter(F.col("ts") < F.lit(hi))
        part.coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.05)
    # make modification times strictly increasing in write order
    files = sorted((os.path.getmtime(os.path.join(path, f)), f) for f in os.listdir(path) if f.endswith(".parquet"))
    t0 = time.time() - 100
    for i, (_, f) in enumerate(files):
        os.utime(os.path.join(path, f), (t0 + i, t0 + i))


def _secs(base, rows):
    return sorted((int((r["window_start"] - base).total_seconds()),
                   int((r["window_end"] - base).total_seconds()), r["n"]) for r in rows)


def test_w12_append_mode_and_drain(spark, tmp_dir):
    ev = FX.game_events(spark)
    src = f"{tmp_dir}/src"
    ev.coalesce(1).write.parquet(src)
    s = forms.stream_tumbling_count(replay_dir(spark, src, ev.schema), "3 seconds", None, "500 milliseconds")
    out = run_available_now(s, "w12", path=f"{tmp_dir}/out")
    assert _secs(FX.GAME_BASE, out.collect()) == [(0, 3, 2), (3, 6, 4), (6, 9, 3)]
    drained = windows.drain_windows(windows.tumbling_count(ev, "3 seconds"), out)
    assert _secs(FX.GAME_BASE, drained.collect())[-1] == (9, 12, 3)


def test_late_row_is_dropped(spark, tmp_dir):
    ev = FX.game_events(spark)
    src = f"{tmp_dir}/src"
    ev.coalesce(1).write.parquet(src)
    # Spark tests lateness against the watermark of the PREVIOUS micro-batch,
    # so one more batch passes before the late row arrives.
    mid = spark.createDataFrame([(98, "PlayerOnline", FX.sec(FX.GAME_BASE, 11), "y", "mid")], FX.GAME_SCHEMA)
    late = spark.createDataFrame([(99, "PlayerRegistered", FX.sec(FX.GAME_BASE, 1), "x", "late")], FX.GAME_SCHEMA)
    for extra in (mid, late):
        time.sleep(1.1)
        extra.coalesce(1).write.mode("append").parquet(src)
    s = forms.stream_tumbling_count(replay_dir(spark, src, ev.schema, max_files_per_trigger=1),
                                    "3 seconds", None, "500 milliseconds")
    out = run_available_now(s, "late", path=f"{tmp_dir}/out")
    got = _secs(FX.GAME_BASE, out.collect())
    assert (0, 3, 2) in got and not any(w[0] == 0 and w[2] != 2 for w in got)


def test_type_counts_parity_over_micro_batches(spark, tmp_dir):
    cart = FX.cart_mixed(spark).unionByName(
        FX.cart_batches(spark).withColumn("event_id", F.col("event_id") + 100))
    src = f"{tmp_dir}/src"
    cuts = [FX.sec(FX.CART_BASE, s) for s in (2, 4, 11)]
    _write_slices(cart, src, cuts)
    s = forms.stream_type_counts(replay_dir(spark, src, cart.schema, max_files_per_trigger=1))
    got = sorted(map(tuple, run_available_now(s, "tc", path=f"{tmp_dir}/out")
                     .select("event_id", "user_id", "n_add", "n_removed").collect()))
    from eventflow import schemas as S
    b = running.running_type_counts(cart).select(
        "event_id", "user_id", F.col("counts")[S.ADD].alias("n_add"), F.col("counts")[S.REMOVED].alias("n_removed"))
    assert got == sorted(map(tuple, b.collect()))


def test_running_count_and_ttl_list_parity(spark, tmp_dir):
    cart = FX.cart_batches(spark)
    src = f"{tmp_dir}/src"
    _write_slices(cart, src, [FX.sec(FX.CART_BASE, 7), FX.sec(FX.CART_BASE, 16)])
    stream = replay_dir(spark, src, cart.schema, max_files_per_trigger=1)
    a = run_available_now(forms.stream_running_count(stream), "rc", path=f"{tmp_dir}/rc")
    b = run_until_caught_up(forms.stream_list_size(stream, ttl="1 hour"), "ttl", path=f"{tmp_dir}/ttl",
                            expected_rows=25, timeout_s=90)
    want = sorted(map(tuple, running.running_count(cart).select("event_id", "user_id", "n").collect()))
    assert sorted(map(tuple, a.collect())) == want
    assert sorted(map(tuple, b.collect())) == want


def test_early_count_stream_matches_batch(spark, tmp_dir):
    ev = FX.trigger_window(spark)
    src = f"{tmp_dir}/src"
    ev.coalesce(1).write.parquet(src)
    path = run_foreach_batch(replay_dir(spark, src, ev.schema), "ec", forms.early_count_fn("5 seconds", 5, view=lambda d: d),
                             path=f"{tmp_dir}/out")
    got = forms.early_count_output(spark.read.parquet(path))
    want = windows.early_count(ev, "5 seconds", 5)
    cols = ["window_start", "window_end", "firing_no", "n"]
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, want.select(*cols).collect()))


@pytest.mark.parametrize("purge", [False, True])
def test_early_count_over_unordered_batches(spark, tmp_dir, purge):
    """Rows older than the watermark count while their window is open; several micro-batches."""
    ev = FX.trigger_window(spark)
    src = f"{tmp_dir}/src"
    n = ev.count()
    for k in range(3):  # every third row a batch: each batch reaches back before the one before it
        ev.filter(F.col("event_id") % 3 == k).coalesce(1).write.mode("append").parquet(src)
        time.sleep(1.1)
    fn = forms.early_count_fn("5 seconds", 5, purge=purge, delay="1 hour", view=lambda d: d)
    path = run_foreach_batch(replay_dir(spark, src, ev.schema, max_files_per_trigger=1), "ecu", fn, path=f"{tmp_dir}/out")
    got = forms.early_count_output(spark.read.parquet(path))
    cols = ["window_start", "window_end", "firing_no", "n"]
    want = windows.early_count(ev, "5 seconds", 5, purge=purge)
    assert n > 5 and sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, want.select(*cols).collect()))


def test_changing_threshold_with_late_events_and_rules(spark, tmp_dir):
    from eventflow.operators import joins
    cart = FX.cart_mixed(spark)
    src = f"{tmp_dir}/src"
    for late in (False, True):  # the later half of the events first
        half = cart.filter(F.col("ts") >= F.lit(FX.sec(FX.CART_BASE, 2))) if not late else cart.filter(F.col("ts") < F.lit(FX.sec(FX.CART_BASE, 2)))
        half.coalesce(1).write.mode("append").parquet(src)
        time.sleep(1.1)
    rules = FX.rules(spark)
    fn = forms.changing_threshold_fn(lambda sp: rules, default=0, bucket="2 seconds", view=lambda d: d, lookback="1 second")
    path = run_foreach_batch(replay_dir(spark, src, cart.schema, max_files_per_trigger=1), "j6l", fn, path=f"{tmp_dir}/out")
    got = sorted((r["event_id"], r["threshold"]) for r in spark.read.parquet(path).collect())
    want = sorted((r["event_id"], r["threshold"]) for r in joins.changing_threshold(cart, rules, default=0, bucket="2 seconds").collect())
    assert got == want


def test_replay_reads_a_folder_of_part_files(spark, tmp_dir):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    ev.repartition(3).write.parquet(f"{tmp_dir}/events.parquet")
    s = replay(spark, tmp_dir, "events", max_files_per_trigger=1)
    assert run_available_now(s.select("event_id"), "rd", path=f"{tmp_dir}/out").count() == ev.count()


def test_run_until_caught_up_raises_at_the_deadline(spark, tmp_dir):
    cart = FX.cart_batches(spark)
    cart.coalesce(1).write.parquet(f"{tmp_dir}/src")
    with pytest.raises(TimeoutError):
        run_until_caught_up(replay_dir(spark, f"{tmp_dir}/src", cart.schema).select("event_id"), "late",
                            path=f"{tmp_dir}/out", expected_rows=10_000, timeout_s=4)


def test_list_size_keeps_max_items_over_batches(spark, tmp_dir):
    cart = FX.cart_batches(spark)
    src = f"{tmp_dir}/src"
    _write_slices(cart, src, [FX.sec(FX.CART_BASE, 7), FX.sec(FX.CART_BASE, 16)])
    s = forms.stream_list_size(replay_dir(spark, src, cart.schema, max_files_per_trigger=1), max_items=3)
    got = sorted(map(tuple, run_available_now(s, "mx", path=f"{tmp_dir}/out").collect()))
    want = running.running_list_size(cart, max_items=3).select("event_id", "user_id", "n")
    assert got == sorted(map(tuple, want.collect()))


def test_upsert_survives_a_died_write(spark, tmp_dir):
    from eventflow.sinks import upsert
    path, schema = f"{tmp_dir}/people", "name string, age int, at int"
    rows = lambda *r: spark.createDataFrame(list(r), schema)
    upsert.upsert_latest(spark, path, rows(*[(f"u{i}", i, 0) for i in range(40)]), ["name"], ["at"])
    os.makedirs(f"{path}/commits/1/_temporary")  # a publication that died
    os.makedirs(f"{path}/data/__version=1/_temporary")
    assert upsert.read_latest(spark, path).count() == 40
    upsert.upsert_latest(spark, path, rows(("u3", 99, 1), ("new", 1, 1), ("u4", 5, -1)), ["name"], ["at"])
    got = {r["name"]: r["age"] for r in upsert.read_latest(spark, path).collect()}
    assert len(got) == 41 and got["u3"] == 99 and got["u4"] == 4 and got["new"] == 1
    assert len([d for d in os.listdir(f"{path}/data/__version=1") if d.startswith("__bucket")]) <= 3  # touched buckets only
    upsert.vacuum(spark, path)
    assert {r["name"]: r["age"] for r in upsert.read_latest(spark, path).collect()} == got


def test_progress_rows_go_to_a_table(spark, tmp_dir):
    rec = attach_progress(spark, f"{tmp_dir}/progress")
    try:
        ev = FX.game_events(spark)
        ev.coalesce(1).write.parquet(f"{tmp_dir}/src")
        run_available_now(replay_dir(spark, f"{tmp_dir}/src", ev.schema).select("event_id"), "pt", path=f"{tmp_dir}/out")
        for _ in range(100):
            time.sleep(0.2)
            if os.path.isdir(f"{tmp_dir}/progress") and spark.read.parquet(f"{tmp_dir}/progress").filter("event = 'terminated'").count():
                break
        rows = spark.read.parquet(f"{tmp_dir}/progress").collect()
        assert rec.rows == [] and sum(r["rows"] or 0 for r in rows if r["event"] == "checkpoint_completed") == 12
    finally:
        spark.streams.removeListener(rec)


def test_progress_callbacks(spark, tmp_dir):
    rec = attach_progress(spark)
    try:
        ev = FX.game_events(spark)
        src = f"{tmp_dir}/src"
        ev.coalesce(1).write.parquet(src)
        run_available_now(replay_dir(spark, src, ev.schema).select("event_id"), "p", path=f"{tmp_dir}/out")
        for _ in range(50):
            if any(r["event"] == "terminated" for r in rec.rows):
                break
            time.sleep(0.1)
        kinds = [r["event"] for r in rec.rows]
        assert "started" in kinds and "checkpoint_completed" in kinds and "terminated" in kinds
        assert sum(r["rows"] or 0 for r in rec.rows if r["event"] == "checkpoint_completed") == 12
    finally:
        spark.streams.removeListener(rec)


def test_changing_threshold_stream_over_micro_batches(spark, tmp_dir):
    from eventflow.operators import joins
    from eventflow.streaming.runner import run_foreach_batch
    cart = FX.cart_mixed(spark)
    src = f"{tmp_dir}/src"
    _write_slices(cart, src, [FX.sec(FX.CART_BASE, 2), FX.sec(FX.CART_BASE, 4)])
    rules = FX.rules(spark)
    fn = forms.changing_threshold_fn(lambda sp: rules, default=0, bucket="2 seconds", view=lambda d: d)
    path = run_foreach_batch(replay_dir(spark, src, cart.schema, max_files_per_trigger=1), "j6", fn,
                             path=f"{tmp_dir}/out")
    got = sorted((r["event_id"], r["threshold"]) for r in spark.read.parquet(path).collect())
    want = sorted((r["event_id"], r["threshold"])
                  for r in joins.changing_threshold(cart, rules, default=0, bucket="2 seconds").collect())
    assert got == want == [(0, 0), (3, 4)]
