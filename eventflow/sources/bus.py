"""Message-bus source and the typed-record decoder.

The transport is Spark's Kafka connector (``format("kafka")``); it is not on
this machine's class path, so only the decoding half is exercised in tests,
on a frame that has the connector's columns (``key``, ``value`` binary).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def kafka_strings(spark: SparkSession, servers: str, topic: str, group: str,
                  starting_offsets: str = "earliest") -> DataFrame:
    """S3: a stream of UTF-8 strings from a topic, earliest offset, consumer group."""
    raw = (spark.readStream.format("kafka")
           .option("kafka.bootstrap.servers", servers)
           .option("subscribe", topic)
           .option("kafka.group.id", group)
           .option("startingOffsets", starting_offsets)
           .load())
    return raw.select(F.col("value").cast("string").alias("value"))


def decode_person(df: DataFrame, mode: str = "failfast", value: str = "value") -> DataFrame:
    """``"name,age"`` records -> (name string, age int).

    Tokens after the second are ignored. ``mode="failfast"`` fails the job on
    a malformed age (as the reference does); ``"permissive"`` yields a null
    age and the raw text in ``_corrupt_record``. Blanks around the age are
    rejected in both modes.
    """
    text = F.col(value).cast("string")
    parts = F.split(text, ",", -1)
    name = F.try_element_at(parts, F.lit(1))
    age_txt = F.try_element_at(parts, F.lit(2))
    ok = age_txt.rlike("^[+-]?[0-9]+$")
    if mode == "failfast":
        age = F.when(ok, age_txt.cast("int")).otherwise(
            F.raise_error(F.concat(F.lit("malformed person record: "), F.coalesce(text, F.lit("null")))))
        return df.select(name.alias("name"), age.alias("age"))
    if mode == "permissive":
        age = F.when(ok, age_txt.try_cast("int"))
        bad = F.when(~F.coalesce(ok, F.lit(False)) | age.isNull(), text)
        return df.select(name.alias("name"), age.alias("age"), bad.alias("_corrupt_record"))
    raise ValueError(f"unknown mode {mode!r}")
