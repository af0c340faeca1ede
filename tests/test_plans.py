"""Plan-shape checks: filters and column pruning reach the Parquet scan,
and running values over the whole stream are partitioned by time bucket
(never one task for the data side)."""

from __future__ import annotations

import re

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_view_filter_and_pruning_reach_scan(spark):
    p = _plan(E.queries()["tumbling_registrations"](spark, SF))
    assert re.search(r"PushedFilters: \[[^\]]*In\(event_type", p)
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", p)
    assert scans and all("props" not in s and "value" not in s for s in scans)


def test_keyless_running_share_is_bucket_partitioned(spark):
    p = _plan(E.queries()["running_share"](spark, SF))
    assert "hashpartitioning(__b" in p


def test_keyed_running_count_partitioned_by_key_and_bucket(spark):
    p = _plan(E.queries()["running_count"](spark, SF))
    assert re.search(r"hashpartitioning\(user_id#\d+L?, __b", p)


def test_as_of_join_has_no_candidate_pairs(spark):
    o = _optimized(E.queries()["changing_threshold"](spark, SF))
    assert "Join Cross" not in o and "BroadcastNestedLoopJoin" not in _plan(E.queries()["changing_threshold"](spark, SF))


def test_interval_join_is_an_equi_join(spark):
    p = _plan(E.queries()["interval_join"](spark, SF))
    assert "NestedLoop" not in p and "CartesianProduct" not in p


def test_keyed_running_count_shares_scan_and_exchange(spark):
    df = E.queries()["running_count"](spark, SF)
    df.collect()
    p = _plan(df).split("== Initial Plan ==")[0]
    assert "ReusedExchange" in p and p.count("Scan parquet") == 1


def test_time_bounds_reach_the_scan(spark):
    from eventflow.functions.time import time_literal
    from eventflow.sources.tables import read_table
    from eventflow.sources.views import rules_from_events
    rules = rules_from_events(read_table(spark, SF, "events"))
    us = 1_704_067_200_000_000
    from pyspark.sql import functions as F
    near = rules.filter((F.col("effective_ts") > time_literal(us, rules, "effective_ts"))
                        & (F.col("effective_ts") <= time_literal(us + 1, rules, "effective_ts")))
    plan = near._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    pushed = re.search(r"PushedFilters: \[(.*)\]", plan).group(1)
    assert "GreaterThan(ts" in pushed and "LessThanOrEqual(ts" in pushed


def test_hot_key_is_split_over_buckets(spark):
    """A key that holds a third of the rows: no (key, bucket) holds a large share of them."""
    from pyspark.sql import functions as F
    from eventflow.operators import ordered
    rows = spark.range(30_000).select(F.col("id").alias("event_id"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("user_id"),
                                      F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id * 30)").alias("ts"))
    sizes = ordered.with_bucket(rows, "ts", ordered.auto_bucket(["user_id"], None)).groupBy("user_id", ordered.BUCKET).count()
    assert sizes.agg(F.max("count")).first()[0] <= 60
    got = ordered.row_numbers(rows, "n", keys=["user_id"]).filter("user_id = 0").agg(F.max("n"), F.countDistinct("n")).first()
    assert tuple(got) == (10_000, 10_000)
