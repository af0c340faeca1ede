"""User-code surfaces and small sinks: P10 time offsets, W14 / A3
accumulators, console / text / fetch sinks, parallelism, checkpointed runs,
streaming session windows."""

from __future__ import annotations

import datetime as dt

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField

from eventflow import schemas as S
from eventflow.operators import routing, transforms, windows
from eventflow.operators.aggregate import Accumulator, CountIf, aggregate
from eventflow.sinks.files import fetch_small, to_console, write_text
from eventflow.streaming import forms
from eventflow.streaming.replay import replay_dir
from eventflow.streaming.runner import run_available_now
from eventflow.streaming.runtime import run_stream
from tests import fixtures as FX


def test_p10_entity_ids_and_offsets(spark):
    ev = FX.game_events(spark)
    ids = {r["event_id"]: r["entity_id"] for r in transforms.server_entity_ids(ev).collect()}
    assert ids[0] == "player|id-bob|bob"
    no_nick = transforms.server_entity_ids(ev.withColumn("nickname", F.lit(None).cast("string")))
    assert no_nick.filter(F.col("event_id") == 0).collect()[0]["entity_id"] == "player|id-bob"
    start = spark.createDataFrame([(dt.datetime(2022, 9, 6),)], "start timestamp_ntz")
    t = transforms.offset_time(start, "start", "2 seconds 500 milliseconds").collect()[0]["event_time"]
    assert t == dt.datetime(2022, 9, 6, 0, 0, 2, 500000)


class MeanQuantity(Accumulator):
    """A user aggregate with a two-field state (sum, count) -> mean."""
    columns = ["quantity"]
    acc_fields = [StructField("s", LongType()), StructField("c", LongType())]
    result_fields = [StructField("mean_q", DoubleType())]

    def zero(self):
        return {"s": 0, "c": 0}

    def add(self, acc, batch: pd.DataFrame):
        return {"s": acc["s"] + int(batch["quantity"].sum()), "c": acc["c"] + len(batch)}

    def merge(self, a, b):
        return {"s": int(a["s"]) + int(b["s"]), "c": int(a["c"]) + int(b["c"])}

    def result(self, acc):
        return {"mean_q": acc["s"] / acc["c"] if acc["c"] else None}


def test_w14_apply_per_window_accumulator(spark):
    cart = FX.cart_batches(spark).repartition(3)
    got = windows.apply_per_window(cart, "10 seconds", MeanQuantity()).collect()
    means = sorted((r["window_start"].second, r["mean_q"]) for r in got)
    # [0,10): i = 0..9 -> q 0..9 mean 4.5 ; [10,20): i = 10..19 -> 4.5 ; [20,30): i = 20..24 -> 2.0
    assert means == [(0, 4.5), (10, 4.5), (20, 2.0)]


def test_a3_count_if_accumulator_small_flushes(spark):
    ev = FX.game_events(spark).repartition(4)
    got = aggregate(ev.withColumn("k", F.lit(1)), ["k"], CountIf("event_type", S.REGISTERED), max_groups_per_flush=1)
    assert got.collect()[0]["n"] == 6


def test_k1_k2_k8_and_r6(spark, tmp_dir, capsys):
    lines = spark.createDataFrame([(x,) for x in FX.TEXT_LINES], "value string")
    to_console(lines)
    assert "Daniel says this is ok" in capsys.readouterr().out
    write_text(routing.with_parallelism(lines, 1), f"{tmp_dir}/one", single_file=True)
    assert sorted(r["value"] for r in spark.read.text(f"{tmp_dir}/one").collect()) == sorted(FX.TEXT_LINES)
    assert [r["value"] for r in fetch_small(lines)] == FX.TEXT_LINES and len(fetch_small(lines.limit(2))) == 2
    assert routing.with_parallelism(lines, 3, shuffle=True).rdd.getNumPartitions() == 3


def test_c1_run_stream_restart_continues(spark, tmp_dir):
    cart = FX.cart_batches(spark)
    src, out, ck = f"{tmp_dir}/src", f"{tmp_dir}/out", f"{tmp_dir}/ck"
    cart.filter(F.col("event_id") < 10).coalesce(1).write.parquet(src)
    stream = forms.stream_running_count(replay_dir(spark, src, cart.schema))
    q = run_stream(stream, "parquet", out, ck, available_now=True)
    q.awaitTermination()
    cart.filter(F.col("event_id") >= 10).coalesce(1).write.mode("append").parquet(src)
    q = run_stream(forms.stream_running_count(replay_dir(spark, src, cart.schema)), "parquet", out, ck,
                   available_now=True)
    q.awaitTermination()
    got = {r["event_id"]: r["n"] for r in spark.read.parquet(out).collect()}
    assert len(got) == 25 and got[24] == 5 and got[0] == 1


def test_w7_streaming_session_windows(spark, tmp_dir):
    ev = FX.game_events(spark)
    src = f"{tmp_dir}/src"
    ev.coalesce(1).write.parquet(src)
    from eventflow.operators.windows import with_event_time
    from eventflow.functions.time import to_ntz
    s = with_event_time(replay_dir(spark, src, ev.schema), "ts", "500 milliseconds")
    g = windows.session_count_native(s, "1 second", predicate=F.col("event_type") == S.REGISTERED, ts="event_time")
    g = g.select(to_ntz("window_start").alias("window_start"), to_ntz("window_end").alias("window_end"), "n")
    out = run_available_now(g, "sess", path=f"{tmp_dir}/out").collect()
    got = sorted(((r["window_start"] - FX.GAME_BASE).seconds, (r["window_end"] - FX.GAME_BASE).seconds, r["n"])
                 for r in out)
    # sessions closed by the watermark (max 10 s - 0.5 s); [10, 11) is still open
    assert got == [(2, 5, 4), (6, 7, 1), (8, 9, 1)]
