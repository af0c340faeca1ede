"""Nearest neighbours against brute force: exact on small tables, recall on larger ones."""

import math
import re

import numpy as np
import pytest

from eventflow.llm import permutation_index
from eventflow.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, rep long, vec string"
RNG = np.random.default_rng(2)


def brute(rows, ask, k=10):
    ok, sizes = {}, {}
    for i, v in rows:
        if i is None or not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        ok[(i, tuple(np.float32(v).astype(float)))] = None
        sizes[len(v)] = sizes.get(len(v), 0) + 1
    width = min(sizes, key=lambda s: (-sizes[s], s)) if sizes else 0
    ok = [(i, np.array(v)) for i, v in ok if len(v) == width]
    out = {}
    for i, v in ok:
        if ask(i):
            near = sorted((float(np.sqrt(((v - w) ** 2).sum())), j) for j, w in ok if j != i)[:k]
            out[i] = near
    return out


def answers(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["query_id"], {})[r["rank"]] = (r["score"], r["vec_id"])
    return {q: [a[n] for n in sorted(a)] for q, a in out.items() if sorted(a) == list(range(1, len(a) + 1))}


def table(spark, tmp_path, rows):
    spark.createDataFrame([(i, v, 0, 1, "x") for i, v in rows], SCHEMA).repartition(3).write.parquet(str(tmp_path / "embeddings.parquet"))
    return str(tmp_path)


def odd_rows(n, width=6):
    rows = [(i, RNG.normal(size=width).tolist()) for i in range(n)]
    copy = RNG.normal(size=width).tolist()
    rows += [(n + i, copy) for i in range(n // 2)]
    rows += [(None, copy), (n, copy), (7000, None), (7100, []), (7200, [0.0] * width), (7300, [1.0, None, 1.0, 1.0, 1.0, 1.0]),
             (7400, [float("nan")] * width), (7500, [float("inf")] + [1.0] * (width - 1)), (7600, [1.0, 2.0]), (7700, [-x for x in copy])]
    return rows


def test_op10_small_table_is_exact(spark, tmp_path):
    rows = odd_rows(260)
    got = answers(QUERIES["op10_permutation_index"](spark, table(spark, tmp_path, rows)))
    want = brute(rows, lambda i: i % 100 == 0)
    assert {q: [i for _, i in a] for q, a in got.items()} == {q: [i for _, i in a] for q, a in want.items()}
    assert all(abs(x[0] - y[0]) < 1e-9 for q in want for x, y in zip(got[q], want[q]))


def test_op10_recall_with_copies(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(permutation_index, "SHARD_ROWS", 900)
    monkeypatch.setattr(permutation_index, "BLOCK", 7)
    rows = odd_rows(3600, 16)
    df = spark.read.parquet(table(spark, tmp_path, rows) + "/embeddings.parquet")
    got = answers(permutation_index.search(df, lambda i: i % 50 == 0, least=100))
    want = brute(rows, lambda i: i % 50 == 0)
    assert set(got) == set(want)
    hit = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want)
    assert hit >= 0.9 * sum(map(len, want.values()))
    assert got[3600] == want[3600]  # the copies, ties by id


@pytest.mark.parametrize("rows", [[], [(0, [1.0, 2.0])], [(0, [1.0, 0.0]), (100, [1.0, 0.0]), (3, None)]])
def test_op10_tiny_tables(spark, tmp_path, rows):
    got = answers(QUERIES["op10_permutation_index"](spark, table(spark, tmp_path, rows)))
    assert got == {q: a for q, a in brute(rows, lambda i: i % 100 == 0).items() if a}


def test_whole_shards_reranked_are_exact(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(permutation_index, "SHARD_ROWS", 300)
    rows = odd_rows(1200, 12)
    df = spark.read.parquet(table(spark, tmp_path, rows) + "/embeddings.parquet")
    got = answers(permutation_index.search(df, lambda i: i % 60 == 0, share=1.0, least=1))
    want = brute(rows, lambda i: i % 60 == 0)
    assert {q: [i for _, i in a] for q, a in got.items()} == {q: [i for _, i in a] for q, a in want.items()}


def test_blocks_for_all_shards_are_not_broadcast(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(permutation_index, "SHARD_ROWS", 100)
    rows = odd_rows(1200, 12)
    df = spark.read.parquet(table(spark, tmp_path, rows) + "/embeddings.parquet")
    got = permutation_index.search(df, lambda i: i % 100 == 0, least=100)
    assert got.count() == 10 * len(brute(rows, lambda i: i % 100 == 0))
    got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # the blocks are copied for each shard, which Spark's size of them leaves out
    assert re.search(r"SortMergeJoin(\(skew=true\))? \[to_shard#\d+\], \[shard#\d+\]", plan)
