"""Seeded property tests: the bucketed (scalable) forms equal the naive
single-partition definitions on random inputs, whatever the bucket width."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from eventflow.operators import joins, ordered, routing, running, windows

BASE = dt.datetime(2024, 1, 1)


def _events(spark, seed, n=300, users=4, span_s=5000, ties=True):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        s = rnd.randrange(span_s) if not ties else rnd.randrange(span_s // 3) * 3
        rows.append((i, f"u{rnd.randrange(users)}", BASE + dt.timedelta(seconds=s),
                     rnd.choice(["a", "b", "c"]), rnd.randrange(10)))
    return spark.createDataFrame(rows, "event_id long, user_id string, ts timestamp_ntz, kind string, q int")


def _rows(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()))


@pytest.mark.parametrize("seed,bucket", [(1, "7 seconds"), (2, "10 minutes"), (3, "1 day")])
def test_running_sums_equal_window(spark, seed, bucket):
    ev = _events(spark, seed)
    got = ordered.running_sums(ev, {"rn": F.lit(1).cast("long"), "sq": F.col("q").cast("long")},
                               keys=["user_id"], bucket=bucket)
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    want = ev.select("event_id", F.count(F.lit(1)).over(w).alias("rn"), F.sum("q").over(w).alias("sq"))
    assert _rows(got, "event_id", "rn", "sq") == _rows(want, "event_id", "rn", "sq")


@pytest.mark.parametrize("seed,bucket", [(4, "13 seconds"), (5, "1 hour")])
def test_keyless_share_equals_unpartitioned_window(spark, seed, bucket):
    ev = _events(spark, seed)
    left = ev.filter(F.col("kind") == "a").select("ts", "event_id")
    right = ev.filter(F.col("kind") != "a").select("ts", "event_id")
    got = running.running_share(left, right, bucket=bucket)
    w = Window.orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    want = ev.select("event_id", (F.count_if(F.col("kind") == "a").over(w) * 100.0
                                  / F.count(F.lit(1)).over(w)).alias("share"))
    g = {r[0]: r[1] for r in got.select("event_id", "share").collect()}
    wnt = {r[0]: r[1] for r in want.collect()}
    assert g.keys() == wnt.keys() and all(abs(g[k] - wnt[k]) < 1e-9 for k in g)


@pytest.mark.parametrize("seed,gap,bucket", [(6, "20 seconds", "1 minute"), (7, "5 minutes", "7 seconds"),
                                             (8, "3 seconds", "1 day")])
def test_sessions_equal_naive(spark, seed, gap, bucket):
    ev = _events(spark, seed, span_s=3000)
    got = windows.session_count(ev, gap, keys=["user_id"], bucket=bucket)
    want = windows.session_count_native(ev, gap, keys=["user_id"])
    assert _rows(got, "user_id", "window_start", "window_end", "n") == \
        _rows(want, "user_id", "window_start", "window_end", "n")


@pytest.mark.parametrize("seed,lo,hi,li,hi_i", [(9, "-20 seconds", "30 seconds", True, False),
                                                (10, "-60 seconds", "-10 seconds", False, True),
                                                (11, "0 seconds", "0 seconds", True, True)])
def test_interval_join_equals_theta_join(spark, seed, lo, hi, li, hi_i):
    ev = _events(spark, seed, n=200)
    left = ev.filter(F.col("kind") == "a").select(F.col("event_id").alias("lid"), "user_id", "ts")
    right = ev.filter(F.col("kind") != "a").select(F.col("event_id").alias("rid"),
                                                  F.col("user_id").alias("ru"), F.col("ts").alias("rts"))
    got = joins.interval_join(left, right, [("user_id", "ru")], lo, hi, "ts", "rts", li, hi_i)
    from eventflow.functions.time import interval_us
    d = (F.unix_micros(F.col("rts").cast("timestamp")) - F.unix_micros(F.col("ts").cast("timestamp")))
    c_lo = d >= interval_us(lo) if li else d > interval_us(lo)
    c_hi = d <= interval_us(hi) if hi_i else d < interval_us(hi)
    want = left.join(right, (F.col("user_id") == F.col("ru")) & c_lo & c_hi)
    assert _rows(got, "lid", "rid") == _rows(want, "lid", "rid")


@pytest.mark.parametrize("seed,bucket", [(12, "11 seconds"), (13, "1 day")])
def test_running_last_equals_window_last(spark, seed, bucket):
    ev = _events(spark, seed).withColumn("v", F.when(F.col("kind") == "a", F.col("q")))
    got = ordered.running_last(ev, "v", "last_v", bucket=bucket)
    w = Window.orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    want = ev.select("event_id", F.last("v", ignorenulls=True).over(w).alias("last_v"))
    assert _rows(got, "event_id", "last_v") == _rows(want, "event_id", "last_v")


@pytest.mark.parametrize("seed", [14, 15])
def test_split_is_a_partition_of_the_input(spark, seed):
    ev = _events(spark, seed).withColumn("p", F.when(F.col("q") > 6, True).when(F.col("q") > 2, False))
    main, side = routing.split(ev, F.col("p"))
    assert main.count() + side.count() == ev.count()
    assert main.join(side, "event_id").count() == 0


@pytest.mark.parametrize("seed,bucket", [(16, "1 minute"), (17, "7 minutes"), (18, "3 hours")])
def test_retained_count_equals_range_frame(spark, seed, bucket):
    ev = _events(spark, seed, ties=False)
    got = running.retained_count(ev, retention="10 minutes", bucket=bucket)
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    w = Window.partitionBy("user_id").orderBy(us).rangeBetween(-(600 * 10**6 - 1), 0)
    same = Window.partitionBy("user_id", "ts")
    later_ties = F.count(F.lit(1)).over(same) - F.row_number().over(same.orderBy("event_id"))
    want = ev.select("event_id", (F.count(F.lit(1)).over(w) - later_ties).alias("n"))
    assert _rows(got, "event_id", "n") == _rows(want, "event_id", "n")
