"""Tables and text replayed as streams."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventflow.functions.time import time_literal


def _literal(path: str) -> str:
    """A path that means itself where patterns are allowed."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def replay(spark: SparkSession, sf_dir: str, table: str = "events",
           max_files_per_trigger: int | None = None) -> DataFrame:
    """A driver table read as a file stream, in arrival (file) order.

    The stream keeps the table's schema (``ts`` stays ``timestamp_ntz``; use
    :func:`eventflow.operators.windows.with_event_time` before a watermark).
    """
    path = f"{sf_dir.rstrip('/')}/{table}.parque"
    r = spark.readStream.schema(spark.read.parquet(_literal(path + "t")).schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(_literal(path) + "[t]")  # as a pattern it may name one file or a folder of part files


def replay_dir(spark: SparkSession, path: str, schema, max_files_per_trigger: int | None = None) -> DataFrame:
    """A directory of time-ordered Parquet slices as a stream."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


def write_time_slice(df: DataFrame, path: str, lo_us: int | None, hi_us: int | None,
                     ts: str = "ts", files: int | None = None) -> None:
    """Append the rows with ``lo_us <= ts < hi_us`` to ``path`` as Parquet.

    Used to build a multi-file replay (each call = later data, written after
    the previous slice, so file order = time order).
    """
    cond = F.lit(True)  # on the raw column, so that the bounds reach the scan
    if lo_us is not None:
        cond = cond & (F.col(ts) >= time_literal(lo_us, df, ts))
    if hi_us is not None:
        cond = cond & (F.col(ts) < time_literal(hi_us, df, ts))
    out = df.filter(cond)
    if files:
        out = out.repartitionByRange(files, ts)
    out.write.mode("append").parquet(path)


def line_text_stream(spark: SparkSession, path: str) -> DataFrame:
    """Each newline-terminated line of the files under ``path`` is a row
    (``value string``). The socket variant of the reference is not replayable
    or parallel; a directory of text files keeps the row semantics."""
    return spark.readStream.text(path)


def socket_text_stream(spark: SparkSession, host: str, port: int) -> DataFrame:
    """S6, socket form (development only: one connection, not replayable)."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()
