"""K7: a per-row sink with open / process / close, each partition and epoch once.

``DataStreamWriter.foreach`` calls one sink object per partition and epoch
(micro-batch). :class:`GuardedSink` adds the guard: what a partition of an
epoch wrote becomes visible at once when it closes without an error, under a
name that holds both numbers; when an epoch is replayed, partitions that were
published before are skipped in ``open``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Row


class GuardedSink:
    """Subclass and define ``begin``, ``write`` and ``finish``; ``published`` and ``publish`` decide on epochs."""

    def published(self, partition: int, epoch: int) -> bool:
        raise NotImplementedError

    def begin(self, partition: int, epoch: int) -> None:
        raise NotImplementedError

    def write(self, row: Row) -> None:
        raise NotImplementedError

    def finish(self, ok: bool) -> None:
        """Publish what was written (``ok``), or discard it."""
        raise NotImplementedError

    # the calls that Spark makes

    def open(self, partition: int, epoch: int) -> bool:
        self._open = not self.published(partition, epoch)
        if self._open:
            self.begin(partition, epoch)
        return self._open

    def process(self, row: Row) -> None:
        self.write(row)

    def close(self, error) -> None:
        if getattr(self, "_open", False):
            self._open = False
            self.finish(error is None)


class LineFileSink(GuardedSink):
    """Rows as lines, one file a partition and epoch, in a folder that all executors reach through ``pyarrow.fs``."""

    def __init__(self, folder: str, line: Callable[[Row], str]):
        self.folder, self.line = folder.rstrip("/"), line

    def _place(self, partition: int, epoch: int):
        from pyarrow import fs
        system, root = fs.FileSystem.from_uri(self.folder if "://" in self.folder or self.folder.startswith("file:") else f"file://{self.folder}")
        return system, f"{root}/epoch-{epoch:09d}-partition-{partition:06d}"

    def published(self, partition: int, epoch: int) -> bool:
        from pyarrow import fs
        system, place = self._place(partition, epoch)
        return system.get_file_info(f"{place}.txt").type != fs.FileType.NotFound

    def begin(self, partition: int, epoch: int) -> None:
        import uuid
        self.system, self.place = self._place(partition, epoch)
        self.system.create_dir(self.place.rsplit("/", 1)[0], recursive=True)
        self.temporary = f"{self.place.rsplit('/', 1)[0]}/_{uuid.uuid4().hex}"  # readers skip names with a leading underscore
        self.stream = self.system.open_output_stream(self.temporary)

    def write(self, row: Row) -> None:
        self.stream.write(self.line(row).encode() + b"\n")

    def finish(self, ok: bool) -> None:
        self.stream.close()
        if ok:
            self.system.move(self.temporary, f"{self.place}.txt")
        else:
            self.system.delete_file(self.temporary)


def run_rich_sink(df: DataFrame, sink: GuardedSink, checkpoint: str) -> None:
    """Write a streaming frame through ``sink`` until its input is consumed."""
    q = df.writeStream.foreach(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
