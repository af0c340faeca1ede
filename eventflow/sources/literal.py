"""Rows from a literal list and integer sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def from_rows(spark: SparkSession, rows: list, schema: StructType | str) -> DataFrame:
    """A DataFrame from literal rows, always with an explicit schema."""
    return spark.createDataFrame(rows, schema)


def number_sequence(spark: SparkSession, lo: int, hi: int, name: str = "n",
                    num_partitions: int | None = None) -> DataFrame:
    """Integers ``lo..hi`` with BOTH ends inclusive (generated in parallel)."""
    df = spark.range(lo, hi + 1, 1, num_partitions) if num_partitions else spark.range(lo, hi + 1)
    return df.withColumnRenamed("id", name)
