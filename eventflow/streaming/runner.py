"""Running streaming queries to completion on bounded input.

Outputs and checkpoints go under the shared checkpoint folder
(``spark.checkpoint.dir``), so a restarted driver or a lost executor
resumes from the committed offsets and state.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from eventflow.session import ensure_state_store, scratch_path
from eventflow.streaming.carry import CarryLog


def run_available_now(df: DataFrame, name: str, output_mode: str = "append",
                      path: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Write a streaming frame to Parquet with ``trigger(availableNow=True)``,
    wait for it, and return the written rows as a batch frame."""
    spark = df.sparkSession
    ensure_state_store(spark)
    path = path or scratch_path(spark, name)
    checkpoint = checkpoint or f"{path}__checkpoint"
    q = (df.writeStream.format("parquet")
           .option("path", path)
           .option("checkpointLocation", checkpoint)
           .outputMode(output_mode)
           .trigger(availableNow=True)
           .start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.read.schema(df.schema).parquet(path) if _has_files(spark, path) else spark.createDataFrame([], df.schema)


def run_foreach_batch(df: DataFrame, name: str, fn: Callable[[DataFrame, int, str], None],
                      path: str | None = None, checkpoint: str | None = None,
                      output_mode: str = "append"):
    """Run ``fn(batch_df, batch_id, path)`` per micro-batch to completion.

    ``fn`` must write idempotently per ``batch_id`` (e.g. overwrite
    ``{path}/batch_id={id}``), so a replayed batch after a failure gives the
    same output. A function marked :func:`~eventflow.streaming.carry.carried`
    also gets the carry log kept in the checkpoint; resuming a checkpoint whose
    carry is gone raises before the query starts.
    """
    spark = df.sparkSession
    ensure_state_store(spark)
    path = path or scratch_path(spark, name)
    checkpoint = checkpoint or f"{path}__checkpoint"
    more: tuple = ()
    if getattr(fn, "carried", False):
        log = CarryLog(spark, checkpoint)
        log.check()
        more = (log,)
    q = (df.writeStream
           .foreachBatch(lambda b, i: fn(b, i, path, *more))
           .outputMode(output_mode)
           .option("checkpointLocation", checkpoint)
           .trigger(availableNow=True)
           .start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return path


def _has_files(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists in the session's Hadoop file system."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def run_until_caught_up(df: DataFrame, name: str, output_mode: str = "append",
                        path: str | None = None, checkpoint: str | None = None,
                        every: str = "1 second", expected_rows: int | None = None,
                        timeout_s: float = 120.0) -> DataFrame:
    """Like :func:`run_available_now` but with a processing-time trigger,
    stopped once the input is consumed. Needed for processing-time state
    programs (TTL, timers), whose no-data batches keep an ``availableNow``
    query (and ``processAllAvailable``) from finishing. With
    ``expected_rows`` the query stops once that many input rows were read.
    Raises ``TimeoutError`` if the input is not consumed in ``timeout_s``."""
    import time

    spark = df.sparkSession
    ensure_state_store(spark)
    path = path or scratch_path(spark, name)
    checkpoint = checkpoint or f"{path}__checkpoint"
    q = (df.writeStream.format("parquet")
           .option("path", path)
           .option("checkpointLocation", checkpoint)
           .outputMode(output_mode)
           .trigger(processingTime=every)
           .start())
    deadline = time.time() + timeout_s
    # every batch counts once: Spark itself keeps only the newest progress entries
    rows: dict[int, int] = {}
    try:
        while q.isActive:
            for p in q.recentProgress:
                rows[p["batchId"]] = max(rows.get(p["batchId"], 0), p.get("numInputRows", 0))
            seen = sum(rows.values())
            if time.time() > deadline:
                raise TimeoutError(f"{name}: {seen} input rows read in {timeout_s} s, the input is not consumed")
            idle = q.lastProgress is not None and q.lastProgress.get("numInputRows", 0) == 0
            if (expected_rows is not None and seen >= expected_rows and idle) or \
               (expected_rows is None and seen > 0 and idle):
                break
            time.sleep(0.2)
    finally:
        q.stop()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.read.schema(df.schema).parquet(path)
