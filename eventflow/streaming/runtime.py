"""Checkpointed runs, progress callbacks, state declared in init."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQueryListener


def run_stream(df: DataFrame, sink_format: str, path: str, checkpoint: str,
               every: str | None = "5 seconds", output_mode: str = "append",
               available_now: bool = False, **options):
    """Start a checkpointed streaming write. State and offsets are
    committed to ``checkpoint`` with every micro-batch; starting again with
    the same checkpoint resumes where the last committed batch ended."""
    w = (df.writeStream.format(sink_format).outputMode(output_mode)
           .option("checkpointLocation", checkpoint))
    if path:
        w = w.option("path", path)
    for k, v in options.items():
        w = w.option(k, v)
    if available_now:
        w = w.trigger(availableNow=True)
    elif every:
        w = w.trigger(processingTime=every)
    return w.start()


PROGRESS_SCHEMA = "event string, id string, batch_id long, rows long, error string"


class ProgressRecorder(StreamingQueryListener):
    """Callbacks when a micro-batch (and its checkpoint) completes or the
    query ends. With a ``path`` every callback is appended to a Parquet table
    there (``PROGRESS_SCHEMA``); without one the rows are kept in ``rows``."""

    def __init__(self, spark=None, path: str | None = None):
        self.rows: list[dict] = []
        self.spark, self.path = spark, path

    def _add(self, row: dict) -> None:
        if self.path is None:
            self.rows.append(row)
            return
        values = [tuple(row.get(f) for f in ("event", "id", "batch_id", "rows", "error"))]
        self.spark.createDataFrame(values, PROGRESS_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def onQueryStarted(self, event) -> None:
        self._add({"event": "started", "id": str(event.id), "batch_id": None, "rows": None})

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self._add({"event": "checkpoint_completed", "id": str(p.id), "batch_id": p.batchId,
                   "rows": p.numInputRows})

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._add({"event": "aborted" if event.exception else "terminated", "id": str(event.id),
                   "batch_id": None, "rows": None, "error": event.exception})


def attach_progress(spark, path: str | None = None) -> ProgressRecorder:
    rec = ProgressRecorder(spark, path)
    spark.streams.addListener(rec)
    return rec
