"""Helpers shared by the operators of this subpackage.

All operators read an id column and a text column and ignore every other
column unless it is named in ``carry``, so extra columns (whatever their
names) never clash. A null text counts as the empty text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventflow.session import scratch_path

#: bytes of text that one vectorised step holds at once (a single longer text is one step)
STEP_BYTES = 1 << 19


def col(df: DataFrame, name: str):
    """The column of that name, dots included."""
    return df[f"`{name}`"]


def only(df: DataFrame, names: list[str]) -> DataFrame:
    """The columns of exactly these names and no other, found by position: other columns whose names differ by case do not clash."""
    at = {c: i for i, c in reversed(list(enumerate(df.columns)))}
    numbered = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    return numbered.select(*[F.col(f"_{at.get(n, 'missing ' + n)}").alias(n) for n in dict.fromkeys(names)])


def texts(df: DataFrame, id_col: str, text_col: str, carry: list[str] | None = None) -> DataFrame:
    """(id, text, *carry) with a null text made empty."""
    df = only(df, [id_col, text_col, *(carry or [])])
    return df.select(col(df, id_col), F.coalesce(col(df, text_col).cast("string"), F.lit("")).alias(text_col),
                     *[col(df, c) for c in carry or []])


def with_fields(df: DataFrame, more: str, drop: tuple[str, ...] = ()) -> T.StructType:
    """The schema of df without ``drop``, then the DDL fields ``more``."""
    kept = [f for f in df.schema.fields if f.name not in drop]
    return T.StructType(kept + T._parse_datatype_string(more).fields)


def steps(batches: Iterable[pa.RecordBatch], text: int, limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds about ``limit`` bytes of the text column at most."""
    for batch in batches:
        if not batch.num_rows:
            continue
        off = text_offsets(batch.column(text))
        a = 0
        while a < batch.num_rows:
            b = max(a + 1, int(np.searchsorted(off, off[a] + limit, "right")) - 1)
            yield batch.slice(a, b - a)
            a = b


def text_offsets(column: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    raw = np.frombuffer(column.buffers()[1], kind)
    return raw[column.offset:column.offset + len(column) + 1].astype(np.int64)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts of the column as one byte array, and each text's start (with the end of the last)."""
    off = text_offsets(column)
    buf = column.buffers()[2]
    data = np.frombuffer(buf, np.uint8)[off[0]:off[-1]] if buf is not None else np.zeros(0, np.uint8)
    return data, off - off[0]


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


#: Spark's own switch: a finished execution's shuffle files go at once
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared scratch folder and read it back: cuts lineage, survives lost executors.

    Nothing reads the write's shuffle files again, so Spark is told to drop them with it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)
