"""K6: a keyed table where writing an existing key overwrites it (upsert).

Rows are dealt into ``BUCKETS`` buckets by the hash of their key. An upsert
writes the latest row per key of (bucket as it was UNION batch) for the
buckets the batch touches, and only those, to ``data/__version=<n>``; then it
publishes ``commits/<n>``, which says for every bucket which version holds it.
Spark's ``_SUCCESS`` marker makes the commit: a write that dies before it
leaves the table as it was. Versions no bucket points to stay for readers of
older commits until :func:`vacuum`.

Folders are listed through the session's Hadoop file system, the one Spark
itself reads and writes paths with. The latest row per key is
``max_by(struct(*), order)``, a partial + final aggregate (a hot key is
combined map-side).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 64
_BUCKET = "__bucket"


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _commits(spark: SparkSession, path: str) -> list[int]:
    """Published versions, oldest first."""
    fs, p = _fs(spark, f"{path}/commits")
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    done = [int(n) for n in names if n.isdigit() and fs.exists(_fs(spark, f"{path}/commits/{n}/_SUCCESS")[1])]
    return sorted(done)


def _holders(spark: SparkSession, path: str) -> dict[int, int]:
    """Which version holds each bucket, by the newest commit (at most BUCKETS rows)."""
    done = _commits(spark, path)
    if not done:
        return {}
    return {r["bucket"]: r["version"] for r in spark.read.schema("bucket int, version long").parquet(f"{path}/commits/{done[-1]}").collect()}


def _read(spark: SparkSession, path: str, holders: dict[int, int], schema=None) -> DataFrame | None:
    if not holders:
        return None
    r = spark.read.option("basePath", f"{path}/data")
    if schema is not None:
        r = r.schema(schema.add(_BUCKET, "int") if _BUCKET not in schema.names else schema)
    df = r.parquet(*[f"{path}/data/__version={v}/{_BUCKET}={b}" for b, v in sorted(holders.items())])
    return df.drop("__version", _BUCKET)


def read_latest(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    """The table as the newest commit has it; None before the first."""
    return _read(spark, path, _holders(spark, path), schema)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    best = F.max_by(F.struct(*[F.col(c) for c in df.columns]), F.struct(*[F.col(c) for c in order]))
    return df.groupBy(*keys).agg(best.alias("__r")).select("__r.*")


def upsert_latest(spark: SparkSession, path: str, batch: DataFrame, keys: Sequence[str],
                  order: Sequence[str]) -> int:
    """Merge ``batch`` into the table at ``path``; returns the published version."""
    bucket = F.pmod(F.hash(*keys), F.lit(BUCKETS))
    holders, done = _holders(spark, path), _commits(spark, path)
    version = done[-1] + 1 if done else 0
    touched = [r["b"] for r in batch.select(bucket.alias("b")).distinct().collect()]  # at most BUCKETS
    current = _read(spark, path, {b: v for b, v in holders.items() if b in touched})
    merged = batch if current is None else current.select(*batch.columns).unionByName(batch)
    (latest_per_key(merged, keys, order).withColumn(_BUCKET, bucket)
     .write.mode("overwrite").partitionBy(_BUCKET).parquet(f"{path}/data/__version={version}"))
    holders.update({b: version for b in touched})
    (spark.createDataFrame(sorted(holders.items()), "bucket int, version long").coalesce(1)
     .write.mode("overwrite").parquet(f"{path}/commits/{version}"))
    return version


def vacuum(spark: SparkSession, path: str) -> None:
    """Remove the data of buckets that the newest commit no longer points to."""
    holders = _holders(spark, path)
    fs, data = _fs(spark, f"{path}/data")
    if not holders or not fs.exists(data):
        return
    for v in fs.listStatus(data):
        version = v.getPath().getName().removeprefix("__version=")
        if not version.isdigit():
            continue
        for b in fs.listStatus(v.getPath()):
            name = b.getPath().getName()
            if name.startswith(f"{_BUCKET}=") and holders.get(int(name.split("=")[1])) != int(version):
                fs.delete(b.getPath(), True)


def upsert_sink(path: str, keys: Sequence[str], order: Sequence[str]):
    """A ``foreachBatch`` function applying :func:`upsert_latest` per batch.
    A replayed batch merges the same rows again and changes nothing."""
    def fn(batch: DataFrame, batch_id: int) -> None:
        upsert_latest(batch.sparkSession, path, batch, keys, order)
    return fn
