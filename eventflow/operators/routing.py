"""Partitioning, routing and parallelism."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def partition_by_hash(df: DataFrame, key: str | Sequence[str], n: int) -> DataFrame:
    """Custom hash partitioner: rows with one key land in one partition.
    ``pmod`` keeps the partition id non-negative for negative hashes."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.repartitionById(n, F.pmod(F.hash(*[F.col(k) for k in keys]), F.lit(n)))


def concentrate(df: DataFrame, n: int) -> DataFrame:
    """R2: send every row to the last of ``n`` partitions (caps downstream
    concurrency at one task; use only in front of a rate-limited sink)."""
    return df.repartitionById(n, F.lit(n - 1))


def rebalance(df: DataFrame, n: int) -> DataFrame:
    """Even round-robin redistribution, e.g. after a skewed stage."""
    return df.repartition(n)


def key_by(df: DataFrame, *keys: str | Column):
    """A keyed view (``GroupedData``); the exchange is planned by Catalyst."""
    return df.groupBy(*keys)


def split(df: DataFrame, predicate: Column) -> tuple[DataFrame, DataFrame]:
    """(main, side). Rows where the predicate is true go to the side
    output; false or null go to main. main + side = input, disjoint."""
    p = F.coalesce(predicate, F.lit(False))
    return df.filter(~p), df.filter(p)


def route(df: DataFrame, predicate: Column, name: str = "route",
          side: str = "side", main: str = "main") -> DataFrame:
    """R5 as one frame: a route column (one scan, for a single writer)."""
    return df.withColumn(name, F.when(F.coalesce(predicate, F.lit(False)), F.lit(side)).otherwise(F.lit(main)))


def with_parallelism(df: DataFrame, n: int, shuffle: bool = False) -> DataFrame:
    """Parallelism of the next (sink-side) operator; upstream stays parallel."""
    return df.repartition(n) if shuffle else df.coalesce(n)
