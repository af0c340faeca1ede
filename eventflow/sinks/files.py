"""K1, K2, K3, K8: console, text files, streaming text sink, small fetch."""

from __future__ import annotations

from pyspark.sql import DataFrame


def to_console(df: DataFrame, n: int | None = None, truncate: bool = False, checkpoint: str | None = None):
    """K1: print rows (stream: console sink; batch: every row, one partition
    at a time, or with ``n`` a table of the first ``n``)."""
    if df.isStreaming:
        w = df.writeStream.format("console").option("truncate", str(truncate).lower())
        if checkpoint:
            w = w.option("checkpointLocation", checkpoint)
        return w.start()
    if n is not None:
        df.show(n, truncate=truncate)
        return None
    print("\t".join(df.columns))
    for row in df.toLocalIterator():
        print("\t".join("NULL" if v is None else str(v) for v in row))
    return None


def write_text(df: DataFrame, path: str, single_file: bool = False, mode: str = "append") -> None:
    """K2: one-column frame to text files. Parallel part files by default;
    ``single_file`` funnels the write through one task (small outputs only)."""
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).text(path)


def to_text_stream(df: DataFrame, path: str, checkpoint: str, available_now: bool = False):
    """K3: streaming row-format file sink (UTF-8 lines, part files,
    exactly-once through the sink's commit log)."""
    w = (df.writeStream.format("text").option("path", path)
           .option("checkpointLocation", checkpoint).outputMode("append"))
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()


def fetch_small(df: DataFrame) -> list:
    """K8: bring a small, already reduced result to the caller, whole, one
    partition at a time. A caller that wants fewer rows limits the frame."""
    return list(df.toLocalIterator())
