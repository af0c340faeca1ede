"""Typed event views over the raw ``events`` table.

Pure ``filter`` + ``select`` plans, so they work on ``spark.read`` and on
``spark.readStream`` frames alike, and Catalyst pushes the type filter into
the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventflow import schemas as S


def _map_type(mapping: dict[str, str]) -> Column:
    expr = None
    for raw, typed in mapping.items():
        expr = (F.when(F.col("event_type") == raw, F.lit(typed)) if expr is None
                else expr.when(F.col("event_type") == raw, F.lit(typed)))
    return expr


def _k(props: str = "props") -> Column:
    return F.get_json_object(F.col(props), "$.k").cast("int")


def cart_events(events: DataFrame) -> DataFrame:
    """Shopping-cart events: purchase -> Add, click -> Removed.

    ``sku = 'sku-' || event_id``; ``quantity = k % 10`` (0..9).
    """
    return (events
            .filter(F.col("event_type").isin(list(S.CART_TYPES)))
            .select("event_id",
                    _map_type(S.CART_TYPES).alias("event_type"),
                    "user_id",
                    F.concat(F.lit("sku-"), F.col("event_id").cast("string")).alias("sku"),
                    (_k() % 10).alias("quantity"),
                    "ts"))


def catalog_events(events: DataFrame) -> DataFrame:
    """Catalog events: view -> ProductDetailsViewed, ``product_id = 'p-' || event_id``."""
    return (events
            .filter(F.col("event_type").isin(list(S.CATALOG_TYPES)))
            .select("event_id", "user_id",
                    F.concat(F.lit("p-"), F.col("event_id").cast("string")).alias("product_id"),
                    "ts"))


def server_events(events: DataFrame) -> DataFrame:
    """Game-server events: signup -> PlayerRegistered, view -> PlayerOnline,
    error -> PlayerOffline; ``player_id = user_id``, ``nickname = 'u' || user_id``."""
    return (events
            .filter(F.col("event_type").isin(list(S.SERVER_TYPES)))
            .select("event_id",
                    _map_type(S.SERVER_TYPES).alias("event_type"),
                    "ts",
                    F.col("user_id").cast("string").alias("player_id"),
                    F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("nickname")))


def cart_and_catalog(events: DataFrame) -> DataFrame:
    """Cart (``left``) and catalog (``right``) events as one tagged frame, from one scan."""
    kinds = [*S.CART_TYPES, *S.CATALOG_TYPES]
    return events.filter(F.col("event_type").isin(kinds)).select(
        "event_id", "user_id", "ts", F.when(F.col("event_type").isin(list(S.CATALOG_TYPES)), "right").otherwise("left").alias("side"))


def adds_and_rules(events: DataFrame) -> DataFrame:
    """Add events and threshold rules in one time order, from one scan, as :func:`~eventflow.operators.joins.rule_as_of_tagged` reads them."""
    adds = [k for k, v in S.CART_TYPES.items() if v == S.ADD]
    is_add = F.col("event_type").isin(adds)
    value = _k() % 10
    return events.filter(F.col("event_type").isin([*adds, "error"])).select(
        "event_id", "user_id", F.concat(F.lit("sku-"), F.col("event_id").cast("string")).alias("sku"), value.alias("quantity"),
        F.col("ts").alias("__t"), is_add.cast("int").alias("__kind"), F.col("event_id").alias("__tie"), F.when(~is_add, value).alias("__rv"))


def rules_from_events(events: DataFrame, rule_name: str = "quantity-threshold") -> DataFrame:
    """A rule stream derived from the raw table: every ``error`` event sets a
    new quantity threshold ``k % 10`` effective at its time."""
    return (events
            .filter(F.col("event_type") == "error")
            .select(F.lit(rule_name).alias("rule_name"),
                    F.col("ts").alias("effective_ts"),
                    (_k() % 10).alias("value"),
                    F.col("event_id").alias("rule_id")))
