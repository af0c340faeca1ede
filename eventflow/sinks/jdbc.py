"""K5: database sink, one INSERT per row, per micro-batch.

Uses Spark's JDBC writer inside ``foreachBatch``. INSERT is not idempotent and
nothing is deleted: a micro-batch replayed after a failure is inserted again.
With ``batch_column`` set, every row carries the micro-batch id, so a reader
can tell replayed rows apart. Credentials come only from arguments.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def to_jdbc(df: DataFrame, url: str, table: str, properties: dict, batch_column: str | None = None):
    def write(batch: DataFrame, batch_id: int) -> None:
        out = batch.withColumn(batch_column, F.lit(batch_id)) if batch_column else batch
        out.write.jdbc(url, table, mode="append", properties=properties)

    if df.isStreaming:
        return df.writeStream.foreachBatch(write)
    write(df, 0)
    return None
