"""Projections, filters and expansions (all JVM-side expressions,
except the lifecycle map P9, which is the user-code surface)."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from eventflow import schemas as S
from eventflow.functions.expressions import entity_id, fizzbuzz
from eventflow.functions.time import interval_us


def map_rows(df: DataFrame, *cols: Column | str, **named: Column) -> DataFrame:
    """One row in, one row out (a projection)."""
    return df.select(*cols, *[c.alias(n) for n, c in named.items()])


def filter_rows(df: DataFrame, predicate: Column) -> DataFrame:
    """Keep rows where ``predicate`` holds (pushed to the scan when it can be)."""
    return df.filter(predicate)


# Columns each event subtype carries (the narrow view of a wide row).
SUBTYPE_COLUMNS = {
    S.ADD: ["event_id", "user_id", "sku", "quantity", "ts"],
    S.REMOVED: ["event_id", "user_id", "sku", "quantity", "ts"],
    S.VIEWED: ["event_id", "user_id", "product_id", "ts"],
    S.REGISTERED: ["event_id", "player_id", "nickname", "ts"],
    S.ONLINE: ["event_id", "player_id", "nickname", "ts"],
    S.OFFLINE: ["event_id", "player_id", "nickname", "ts"],
}


def only(df: DataFrame, subtype: str, type_col: str = "event_type") -> DataFrame:
    """Narrow a union-typed stream to one subtype and its columns."""
    cols = [c for c in SUBTYPE_COLUMNS.get(subtype, df.columns) if c in df.columns and c != type_col]
    return df.filter(F.col(type_col) == subtype).select(*cols)


def classify(df: DataFrame, n: str = "n", name: str = "output") -> DataFrame:
    """Fizzbuzz classification, guards in order."""
    return df.select(F.col(n).cast("long").alias("n"), fizzbuzz(n).alias(name))


def expand_pair(df: DataFrame, n: str = "n", name: str = "m") -> DataFrame:
    """P5: each value to the fixed list ``[n, n + 1]``."""
    return df.select("*", F.explode(F.array(F.col(n), F.col(n) + 1)).alias(name))


def expand_range(df: DataFrame, n: str = "n", name: str = "m") -> DataFrame:
    """Each value to ``1 until n`` (upper end exclusive; n <= 1 gives no row)."""
    seq = F.when(F.col(n) > 1, F.sequence(F.lit(1).cast(df.schema[n].dataType), F.col(n) - 1))
    return df.select("*", F.explode(seq).alias(name))


def explode_by_quantity(df: DataFrame, item: str = "sku", quantity: str = "quantity",
                        name: str = "item") -> DataFrame:
    """One row per purchased item; quantity 0 (or null) gives no row."""
    rep = F.array_repeat(F.col(item), F.coalesce(F.col(quantity), F.lit(0)).cast("int"))
    return df.select("*", F.explode(rep).alias(name))


def map_with_lifecycle(df: DataFrame, fn: Callable[[pd.DataFrame, object], pd.DataFrame],
                       schema: StructType | str, setup: Callable[[], object] | None = None,
                       teardown: Callable[[object], None] | None = None) -> DataFrame:
    """A 1 -> N function with setup before any data and teardown after.

    Runs per task (Arrow batches via ``mapInPandas``): ``setup()`` once per
    partition, ``fn(batch, resource)`` per batch, ``teardown(resource)`` in a
    ``finally`` even when the task fails.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        resource = setup() if setup else None
        try:
            for b in batches:
                out = fn(b, resource)
                if out is not None and len(out):
                    yield out
        finally:
            if teardown:
                teardown(resource)

    return df.mapInPandas(run, schema)


def server_entity_ids(server: DataFrame, name: str = "entity_id") -> DataFrame:
    """P10: ids derived from fields: ``player|id|nickname`` for player events
    with a nickname, ``player|id`` for those without, ``game|id`` for games."""
    cols = server.columns
    gid = F.when(F.col("game_id").isNotNull(), entity_id("game", "game_id")) if "game_id" in cols else None
    pid = F.when(F.col("nickname").isNotNull(), entity_id("player", "player_id", "nickname")) \
           .otherwise(entity_id("player", "player_id"))
    expr = pid if gid is None else F.coalesce(gid, pid)
    return server.withColumn(name, expr)


def offset_time(df: DataFrame, start: str, offset: str | int, name: str = "event_time") -> DataFrame:
    """P10: event time = start + a duration."""
    return df.withColumn(name, F.col(start) + F.make_dt_interval(
        secs=F.lit(interval_us(offset) / 1_000_000.0)))
