"""Approximate nearest neighbours with a permutation index.

Pivots are a bounded sample of the vectors (PIVOTS, the only vectors the
driver sees). A vector is represented by its ``length`` nearest pivots,
nearest first. The index is dealt into shards of about SHARD_ROWS vectors; in
a shard each vector is posted, with the pivot's place in its order, under the
pivot's inverted file. Queries go to the shards in blocks of BLOCK, by a join
on the shard: a query reads the files of its own nearest pivots, ranks the
shard by the footrule distance of the two orders (a missing pivot stands
behind the last), and reranks the best ``share`` of it (at least ``least``) by
exact Euclidean distance. Shards of at most ``least`` vectors are answered
exactly, and with ``share=1`` all are: the ranking then leaves nothing out.

Every row is indexed. Equal vectors are one entry of the index, so a vector
that a third of all rows hold is one posting; the ids an answer can need (the
``k + 1`` smallest of each entry) are kept beside it.

Rows with a null id, a null, empty or zero vector, a null or non-finite
component, or a number of components other than the most frequent take no
part. A row that repeats an id and its vector counts once; a query's own id is
never an answer. Ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventflow.llm.common import col, only, staged

PIVOTS, LENGTH = 512, 64
SHARE, LEAST = 0.16, 500
SHARD_ROWS, BLOCK = 8192, 1024


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vec) of the rows that take part."""
    df = only(df, [id_col, vector_col])
    rows = df.select(col(df, id_col).cast("long").alias("id"), col(df, vector_col).cast("array<double>").alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    rows = rows.where(F.col("id").isNotNull() & (F.size("vec") > 0) & finite & F.exists("vec", lambda x: x != 0))
    sizes = rows.groupBy(F.size("vec").alias("width")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "width").first()
    return rows.where(F.size("vec") == (sizes["width"] if sizes else 0))


def orders(x: np.ndarray, pivots: np.ndarray, length: int) -> np.ndarray:
    """The nearest pivots of each row, nearest first."""
    far = (pivots * pivots).sum(1) - 2 * x @ pivots.T
    near = np.argpartition(far, length - 1, axis=1)[:, :length] if length < len(pivots) else np.tile(np.arange(len(pivots)), (len(x), 1))
    by = np.argsort(np.take_along_axis(far, near, 1), axis=1, kind="stable")
    return np.take_along_axis(near, by, 1).astype(np.int16)


def _packed(entries: DataFrame, groups: int, pivots, length: int, name: str) -> DataFrame:
    """(name, ids, vecs, near): entries (rep, vec, name) packed to one row a group, with their pivot orders."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, kept = pivots.value, {}
        for b in batches:
            if b.num_rows:
                at = b.column(2).to_numpy()
                x = _matrix(b.column(1), p.shape[1])
                for g in np.unique(at).tolist():
                    kept.setdefault(g, []).append((b.column(0).to_numpy()[at == g], x[at == g]))
        for g, parts in kept.items():
            ids, x = (np.concatenate(c) for c in zip(*parts))
            near = np.concatenate([orders(x[i:i + 1024], p, length) for i in range(0, len(x), 1024)])
            yield pa.RecordBatch.from_arrays([pa.array([g], pa.int32()), pa.array([ids.tobytes()], pa.binary()), pa.array([x.tobytes()], pa.binary()),
                                              pa.array([near.tobytes()], pa.binary())], names=[name, "ids", "vecs", "near"])

    dealt = entries.select("rep", "vec", F.pmod(F.xxhash64("rep"), F.lit(groups)).cast("int").alias(name))
    return dealt.repartitionById(groups, name).mapInArrow(run, f"{name} int, ids binary, vecs binary, near binary")


def files_of(near: np.ndarray, pivots: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Inverted files: for each pivot the rows it is near to, and its place in their orders."""
    flat = near.ravel()
    order = np.argsort(flat, kind="stable")
    cut = np.searchsorted(flat[order], np.arange(1, pivots))
    length = near.shape[1]
    return [(o // length, (o % length).astype(np.int32)) for o in np.split(order, cut)]


def shard_answers(ids: np.ndarray, x: np.ndarray, near: np.ndarray, q: np.ndarray, q_near: np.ndarray, pivots: int, k: int,
                  share: float, least: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each query the k nearest of the reranked rows of one shard: (ids, distances)."""
    files, length = files_of(near, pivots), near.shape[1]
    depth = min(len(ids), max(least, int(np.ceil(share * len(ids)))))
    for j in range(len(q)):
        picked = np.arange(len(ids))
        if depth < len(ids):
            shared = np.zeros(len(ids), np.int32)  # footrule distance = constant - this sum over shared pivots
            for place, pivot in enumerate(q_near[j].tolist()):
                rows, places = files[pivot]
                shared[rows] += 2 * length - place - places - np.abs(places - place)
            picked = np.argpartition(-shared, depth - 1)[:depth]
        d = x[picked] - q[j]
        d = np.sqrt((d * d).sum(1))
        if k < len(d):  # all that tie with the k-th stay in the running
            near_enough = d <= np.partition(d, k - 1)[k - 1]
            picked, d = picked[near_enough], d[near_enough]
        o = np.lexsort((ids[picked], d))[:k]
        yield ids[picked][o], d[o]


def search(df: DataFrame, is_query, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10,
           length: int = LENGTH, share: float = SHARE, least: int = LEAST) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every row for which ``is_query(id column)`` holds."""
    spark = df.sparkSession
    rows = staged(usable(df, id_col, vector_col).dropDuplicates(["id", "vec"]), "permutation-rows")
    # the smallest ids of each distinct vector; the limit is applied before the shuffle too
    members = rows.select("id", "vec", F.row_number().over(Window.partitionBy("vec").orderBy("id")).alias("place")).where(F.col("place") <= k + 1)
    members = staged(members.select("id", "vec", F.min("id").over(Window.partitionBy("vec")).alias("rep")), "permutation-members")
    entries = members.where("id = rep").select("rep", "vec")
    n = entries.count()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = entries.orderBy(F.xxhash64("rep", F.lit(17)), "rep").limit(PIVOTS).toArrow()
    p = _matrix(sample.column("vec").combine_chunks(), len(sample.column("vec")[0]))
    length, width, pivots = min(length, len(p)), p.shape[1], spark.sparkContext.broadcast(p)
    shards = -(-n // SHARD_ROWS)
    index = staged(_packed(entries, shards, pivots, length, "shard"), "permutation-index")
    asked = rows.where(is_query(F.col("id"))).select("id", "vec")
    asked = asked.join(entries.select(F.col("vec").alias("v"), "rep"), F.col("vec") == F.col("v")).select(F.col("id").alias("query_id"), F.col("rep").alias("of"))
    asked = staged(asked.distinct(), "permutation-queries")
    classes = entries.join(asked.select("of").distinct(), F.col("rep") == F.col("of")).select("rep", "vec")
    blocks = _packed(classes, -(-max(1, asked.count()) // BLOCK), pivots, length, "block")
    blocks = blocks.select("ids", "vecs", "near", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("to_shard"))
    blocks = blocks.select("to_shard", F.col("ids").alias("q_ids"), F.col("vecs").alias("q_vecs"), F.col("near").alias("q_near"))
    # Spark sizes the blocks without their copies for the shards and may broadcast them all; of a merge only the right side, one shard, is held
    meet = blocks.hint("merge").join(index, F.col("shard") == F.col("to_shard")).select("ids", "vecs", "near", "q_ids", "q_vecs", "q_near")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def numbers(b, i, r, kind, w=0):
            a = np.frombuffer(b.column(i)[r].as_buffer(), kind)
            return a.reshape(-1, w) if w else a

        for b in batches:
            for r in range(b.num_rows):
                ids, x, near = numbers(b, 0, r, np.int64), numbers(b, 1, r, np.float64, width), numbers(b, 2, r, np.int16, length)
                q_ids, q, q_near = numbers(b, 3, r, np.int64), numbers(b, 4, r, np.float64, width), numbers(b, 5, r, np.int16, length)
                got = list(shard_answers(ids, x, near, q, q_near, len(pivots.value), k + 1, share, least))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(q_ids, [len(i) for i, _ in got])), pa.array(np.concatenate([i for i, _ in got])),
                     pa.array(np.concatenate([d for _, d in got]))], names=["query", "rep", "score"])

    rated = meet.mapInArrow(run, "query long, rep long, score double")
    nearest = Window.partitionBy("query").orderBy("score", "id")
    answers = (rated.join(members.select(F.col("rep").alias("m"), "id"), F.col("rep") == F.col("m"))
               .withColumn("n", F.row_number().over(nearest)).where(F.col("n") <= k + 1).select("query", "id", "score"))
    mine = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (answers.join(asked, F.col("query") == F.col("of")).where(F.col("id") != F.col("query_id"))
            .select("query_id", F.col("id").alias("vec_id"), "score").distinct()
            .withColumn("rank", F.row_number().over(mine)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
