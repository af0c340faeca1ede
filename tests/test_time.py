"""Interval texts and zone-free microseconds."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from eventflow.functions.time import epoch_us, from_epoch_us, interval_us, time_literal, to_instant, to_ntz


@pytest.mark.parametrize("text, us", [
    ("500 ms", 500_000), ("2.5 seconds", 2_500_000), ("5 s", 5_000_000), ("0.5 hours", 1_800_000_000),
    ("1 hour 30 minutes", 5_400_000_000), ("-2 hours", -7_200_000_000), ("3 milliseconds", 3_000), ("2 m", 120_000_000),
    ("1 day", 86_400_000_000), ("1 week", 604_800_000_000), ("7 microseconds", 7), (42, 42)])
def test_interval_us(text, us):
    assert interval_us(text) == us


@pytest.mark.parametrize("text", ["", "abc", "5", "5 parsecs", "5 seconds and more", "seconds 5", "1..5 s", "0.0000001 s"])
def test_interval_us_rejects(text):
    with pytest.raises(ValueError):
        interval_us(text)


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles", "Australia/Lord_Howe"])
def test_microseconds_do_not_depend_on_the_zone(spark, zone):
    times = [dt.datetime(2024, 3, 10, 2, 30), dt.datetime(2024, 11, 3, 1, 30, 0, 5), dt.datetime(1969, 12, 31, 23, 59, 59, 999999),
             dt.datetime(2024, 1, 1), dt.datetime(1, 1, 1), None]
    us = [None if t is None else (t - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1) for t in times]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame(list(enumerate(times)), "i int, t timestamp_ntz")
        got = df.select("i", epoch_us("t", df).alias("us"), from_epoch_us(epoch_us("t", df)).alias("back"),
                        F.unix_micros(to_instant("t")).alias("instant"), to_ntz(to_instant("t")).alias("there")).orderBy("i").collect()
        assert [r["us"] for r in got] == us and [r["instant"] for r in got] == us
        assert [r["back"] for r in got] == times and [r["there"] for r in got] == times
        assert [r["i"] for r in df.where(F.col("t") >= time_literal(us[1], df, "t")).collect()] == [1]
        inst = df.select("i", to_instant("t").alias("t"))
        assert [r["i"] for r in inst.where(F.col("t") >= time_literal(us[1], inst, "t")).collect()] == [1]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
