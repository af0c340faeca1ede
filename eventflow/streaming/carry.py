"""What one micro-batch hands to the next, bound to the query's checkpoint.

A carried operator computes each micro-batch with the parallel batch operators
and keeps only a small table between them. The table of batch n is written
under ``<checkpoint>/carry`` before batch n is committed, so it lives and
resumes with the offsets it belongs to: a replayed batch n reads the carry of
batch n - 1 again and writes its own anew. Only the newest two are kept.

A query resumed without its carry would silently count from zero. That is an
error: :meth:`CarryLog.check` compares Spark's commit log with the carry when
the query starts, and a batch other than the first raises if the carry before
it is missing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 64
_BUCKET = "__bucket"


class CarryLost(RuntimeError):
    """The checkpoint has batches whose carry is gone."""


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def _numbers(spark: SparkSession, path: str, prefix: str = "") -> list[int]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName().removeprefix(prefix) for s in fs.listStatus(p)]
    return sorted(int(n) for n in names if n.isdigit())


def carried(fn: Callable) -> Callable:
    """Mark ``fn(batch, batch_id, path, log)``: the runner hands it the query's :class:`CarryLog`."""
    fn.carried = True
    return fn


class CarryLog:
    def __init__(self, spark: SparkSession, checkpoint: str):
        self.spark, self.checkpoint = spark, checkpoint.rstrip("/")
        self.root = f"{self.checkpoint}/carry"

    def check(self) -> None:
        """Raise if the checkpoint's last committed batch has no carry."""
        done = _numbers(self.spark, f"{self.checkpoint}/commits")
        if done and not _exists(self.spark, f"{self.root}/done/{done[-1]}/_SUCCESS"):
            raise CarryLost(f"{self.checkpoint} has committed batch {done[-1]}, but its carry is not there; "
                            "start with a new checkpoint or bring the carry back")

    def _before(self, batch_id: int) -> bool:
        """Whether there is a batch before; it must have left its carry."""
        if batch_id == 0:
            return False
        if not _exists(self.spark, f"{self.root}/done/{batch_id - 1}/_SUCCESS"):
            raise CarryLost(f"batch {batch_id} starts, but the carry of batch {batch_id - 1} is not under {self.root}")
        return True

    def read(self, name: str, batch_id: int, schema) -> DataFrame:
        """The table that the previous batch wrote as ``name``; no rows before the first."""
        if not self._before(batch_id):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.root}/tables/{name}/batch_id={batch_id - 1}")

    def write(self, name: str, batch_id: int, df: DataFrame) -> None:
        df.write.mode("overwrite").parquet(f"{self.root}/tables/{name}/batch_id={batch_id}")

    def read_value(self, name: str, batch_id: int) -> int | None:
        """A number of the previous batch."""
        row = self.read(name, batch_id, "value long").first()
        return None if row is None else row["value"]

    def write_value(self, name: str, batch_id: int, value: int | None) -> None:
        self.write(name, batch_id, self.spark.createDataFrame([(value,)], "value long").coalesce(1))

    def read_keys(self, name: str, batch_id: int, keyed: DataFrame, keys: Sequence[str], schema) -> tuple[DataFrame, list[int], dict[int, int]]:
        """The rows of a keyed table in the buckets that the keys of ``keyed`` touch, those buckets, and who holds each bucket."""
        holders: dict[int, int] = {}
        if self._before(batch_id):
            rows = self.spark.read.schema("bucket int, version long").parquet(f"{self.root}/keyed/{name}/commits/{batch_id - 1}")
            holders = {r["bucket"]: r["version"] for r in rows.collect()}  # at most BUCKETS rows
        touched = sorted(r["b"] for r in keyed.select(bucket_of(keys).alias("b")).distinct().collect())  # at most BUCKETS
        data = f"{self.root}/keyed/{name}/data"
        paths = [f"{data}/batch_id={holders[b]}/{_BUCKET}={b}" for b in touched if b in holders]
        old = (self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema))
        return old, touched, holders

    def write_keys(self, name: str, batch_id: int, df: DataFrame, keys: Sequence[str], touched: list[int], holders: dict[int, int]) -> None:
        """Publish the touched buckets' new rows; the other buckets stay where they are."""
        (df.withColumn(_BUCKET, bucket_of(keys)).write.mode("overwrite").partitionBy(_BUCKET)
         .parquet(f"{self.root}/keyed/{name}/data/batch_id={batch_id}"))
        # a touched bucket that is left without rows has no folder
        fs, p = _fs(self.spark, f"{self.root}/keyed/{name}/data/batch_id={batch_id}")
        made = {int(s.getPath().getName().split("=")[1]) for s in fs.listStatus(p) if s.getPath().getName().startswith(_BUCKET)}
        now = {b: v for b, v in holders.items() if b not in touched} | {b: batch_id for b in made}
        (self.spark.createDataFrame(sorted(now.items()), "bucket int, version long").coalesce(1)
         .write.mode("overwrite").parquet(f"{self.root}/keyed/{name}/commits/{batch_id}"))

    def finish(self, batch_id: int) -> None:
        """Mark the batch's carry complete, and drop what neither it nor the batch before needs."""
        self.spark.range(1).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/done/{batch_id}")
        keep = {batch_id, batch_id - 1}
        fs, tables = _fs(self.spark, f"{self.root}/tables")
        if fs.exists(tables):
            for t in fs.listStatus(tables):
                self._drop(str(t.getPath()), keep, "batch_id=")
        self._drop(f"{self.root}/done", keep)
        _, keyed = _fs(self.spark, f"{self.root}/keyed")
        if not fs.exists(keyed):
            return
        for t in fs.listStatus(keyed):
            at = str(t.getPath())
            self._drop(f"{at}/commits", keep)
            held = set()
            for n in _numbers(self.spark, f"{at}/commits"):
                held |= {r["version"] for r in self.spark.read.schema("bucket int, version long").parquet(f"{at}/commits/{n}").collect()}
            self._drop(f"{at}/data", held | keep, "batch_id=")

    def _drop(self, path: str, keep: set[int], prefix: str = "") -> None:
        for n in _numbers(self.spark, path, prefix):
            if n not in keep:
                fs, p = _fs(self.spark, f"{path}/{prefix}{n}")
                fs.delete(p, True)


def bucket_of(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(BUCKETS)).cast("int")
