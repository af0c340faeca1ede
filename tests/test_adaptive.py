"""Adaptive cuts: few buckets where rows are sparse, many where they are dense, the same results."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as E
from eventflow.operators import ordered, running
from eventflow.sources.tables import read_table
from eventflow.sources.views import cart_events

SF = "/root/testdata/sf0.1"


def rows(spark):
    """Key 0: 20,000 rows in one hour, 200 more over a year; keys 1 to 40: 30 rows over the year; a null key and a row without a time."""
    at = F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(cast(days as int), 0, 0, secs)")
    dense = spark.range(20_000).selectExpr("id AS event_id", "0L AS k", "200 AS days", "id * 0.18 AS secs")
    sparse = spark.range(200).selectExpr("id + 30000 AS event_id", "0L AS k", "id * 1.8 AS days", "0 AS secs")
    others = spark.range(1230).selectExpr("id + 40000 AS event_id", "nullif(id % 41, 0) AS k", "(id * 7) % 365 AS days", "id AS secs")
    return dense.unionByName(sparse).unionByName(others).select("event_id", "k", F.when(F.col("event_id") != 40005, at).alias("ts"))


@pytest.mark.parametrize("per_bucket", [1000, 50])
def test_a_dense_hour_is_many_buckets_and_sparse_keys_are_one(spark, monkeypatch, per_bucket):
    monkeypatch.setattr(ordered, "ROWS_PER_BUCKET", per_bucket)
    df = rows(spark)
    sizes = ordered.with_cuts(df, "ts", ["k"]).groupBy("k", ordered.BUCKET).count().collect()
    hot = [r["count"] for r in sizes if r["k"] == 0]
    assert max(hot) <= 20_200 / min(256, 20_200 / per_bucket) * 1.6 and len(hot) >= 12
    assert len([r for r in sizes if r["k"] != 0]) == 41
    got = ordered.row_numbers(df, "n", keys=["k"], bucket=ordered.ADAPTIVE)
    want = df.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("ts", "event_id")))
    pick = lambda d: sorted((r["event_id"], r["n"]) for r in d.collect())
    assert pick(got) == pick(want)


def test_without_keys(spark, monkeypatch):
    monkeypatch.setattr(ordered, "ROWS_PER_BUCKET", 500)
    df = rows(spark)
    sizes = [r["count"] for r in ordered.with_cuts(df, "ts", []).groupBy(ordered.BUCKET).count().collect()]
    assert len(sizes) > 20 and max(sizes) < 1500
    got = ordered.row_numbers(df, "n", bucket=ordered.ADAPTIVE)
    want = df.withColumn("n", F.row_number().over(Window.orderBy("ts", "event_id")))
    pick = lambda d: sorted((r["event_id"], r["n"]) for r in d.collect())
    assert pick(got) == pick(want)


def test_sessions_retention_and_last_values(spark, monkeypatch):
    monkeypatch.setattr(ordered, "ROWS_PER_BUCKET", 300)
    df = rows(spark).where("ts IS NOT NULL")
    for f in (lambda d, b: ordered.sessionize(d, "1 day", keys=["k"], bucket=b).select("event_id", "session_start_us"),
              lambda d, b: running.retained_count(d, "k", "3 hours", bucket=b).select("event_id", "n"),
              lambda d, b: ordered.running_last(d.withColumn("v", F.when(F.col("event_id") % 7 == 0, F.col("event_id"))), "v", "last", keys=["k"], bucket=b)
              .select("event_id", "last")):
        assert sorted(map(tuple, f(df, ordered.ADAPTIVE).collect())) == sorted(map(tuple, f(df, "1 hour").collect()))


def test_bucket_table_is_small_on_the_events(spark):
    cart = cart_events(read_table(spark, SF, "events"))
    table = ordered.with_cuts(cart, "ts", ["user_id"]).groupBy("user_id", ordered.BUCKET).count()
    assert table.count() <= 0.1 * cart.count()


@pytest.mark.parametrize("name, scans", [("running_share", 1), ("connected_state", 2), ("changing_threshold", 2)])
def test_two_kinds_of_one_table_share_a_scan(spark, name, scans):
    """One scan for both kinds; the bucket table reads it again only where the rows carry columns that it does not need."""
    df = E.queries()[name](spark, "/root/testdata/sf0.001")
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Scan parquet") == scans


def test_replay_of_a_folder_with_pattern_letters(spark, tmp_dir):
    from eventflow.streaming.replay import replay
    from eventflow.streaming.runner import run_available_now
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    import os
    import shutil
    folder = f"{tmp_dir}/a[1]{{x}}*"
    ev.write.parquet(f"{tmp_dir}/plain/events.parquet")
    os.makedirs(folder)
    shutil.copytree(f"{tmp_dir}/plain/events.parquet", f"{folder}/events.parquet")
    assert run_available_now(replay(spark, folder).select("event_id"), "lit", path=f"{tmp_dir}/out").count() == ev.count()
