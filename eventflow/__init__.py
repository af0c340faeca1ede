"""eventflow: event-stream analytics operators as Spark DataFrame functions.

Every operator takes and returns a ``pyspark.sql.DataFrame``. Batch forms
are plain DataFrame plans (checked against SQL); streaming forms run as
Structured Streaming queries (checked against the batch forms).
"""

from eventflow.session import get_session, checkpoint_root, scratch_path

__all__ = ["get_session", "checkpoint_root", "scratch_path"]
