"""K4: message-bus sink with a record serializer (value ``"name,age"``, key null)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def encode_person(df: DataFrame, topic: str, name: str = "name", age: str = "age") -> DataFrame:
    """Rows -> the connector's write shape: null key, UTF-8 ``name,age`` value.
    Both fields are always written; a null one is empty."""
    return df.select(
        F.lit(None).cast("binary").alias("key"),
        F.concat_ws(",", F.coalesce(F.col(name), F.lit("")), F.coalesce(F.col(age).cast("string"), F.lit(""))).cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
    )


def to_bus(df: DataFrame, servers: str, checkpoint: str):
    """Start a streaming write of an ``encode_person``-shaped frame."""
    return (df.writeStream.format("kafka")
              .option("kafka.bootstrap.servers", servers)
              .option("checkpointLocation", checkpoint)
              .start())
