"""Merkle manifest against a plain recursion, its SQL, and tampering."""

import hashlib
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from eventflow.llm import merkle
from eventflow.llm.common import staged
from eventflow.llm.queries import ORACLE, QUERIES
from tests.llm.conftest import SCHEMA
from tests.llm.test_texts import ODD, by_row

RNG = random.Random(12)
COLS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(*values):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def plain_tree(level, fanout):
    """(root, per node the list of (left, right) siblings)."""
    paths, at = [[] for _ in level], list(range(len(level)))
    while len(level) > 1:
        for k, i in enumerate(at):
            run = i // fanout * fanout
            paths[k].append((level[run:i], level[i + 1:run + fanout]))
        level = [h(*level[a:a + fanout]) for a in range(0, len(level), fanout)]
        at = [i // fanout for i in at]
    return level[0], paths


def plain(rows, fanout=2):
    groups = {}
    for r in rows:
        doc, text, lang, source, n = r[:5]
        more = n if n is None or doc is None or zlib.crc32(str(doc).encode()) % 7 else n + 1
        leaf = plain_leaf(doc, source, lang, n, text)
        groups.setdefault(lang, []).append(((doc is not None, doc or 0, leaf), leaf, plain_leaf(doc, source, lang, more, text), doc))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: plain_tree([x[1] for x in sorted(groups[g])], fanout) for g in groups}
    root, above = plain_tree([trees[g][0] for g in order], fanout) if order else (None, [])
    out = []
    for g, up in zip(order, above):
        for (_, leaf, other, doc), path in zip(sorted(groups[g]), trees[g][1]):
            now = other
            for left, right in path + up:
                now = h(*left, now, *right)
            proof = h(*[s for left, right in path + up for s in left + right])
            out.append((doc, leaf, trees[g][0], root, proof, now, now == root))
    return sorted(out, key=repr)


def rows_of(n, langs):
    rows = [(i, RNG.choice(ODD), RNG.choice(langs), RNG.choice(["a:b", None, "é"]), RNG.choice([None, 0, -3, 2 ** 63 - 1, i]), "x", None, "y")
            for i in RNG.sample(range(-50, 20 * n), n)]
    rows += [(None, "no id", langs[0], None, 1, None, None, None), (None, "no id", langs[0], None, 2, None, None, None)]
    return rows + [rows[0]] * 3 + [(rows[1][0], "another text", *rows[1][2:])]


def test_op12_equals_plain_tree_and_sql(spark, tmp_path):
    rows = rows_of(300, ["en", "en", "en", "fr", "é", None, "", "lone"]) + [(-7, "only", "single", None, 0, None, None, None)]
    spark.createDataFrame(rows, SCHEMA).repartition(5).write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["op12_merkle"](spark, str(tmp_path))
    assert got.columns == COLS
    found = by_row(got, *COLS)
    assert found == plain(rows) and any(not r[-1] for r in found) and any(r[-1] for r in found)
    con = duckdb.connect()
    con.sql(f"create view documents as select * from read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert sorted(con.sql(ORACLE["op12_merkle"]).select(*COLS).fetchall(), key=repr) == found


@pytest.mark.parametrize("fanout, depth, n", [(2, 1, 37), (2, 3, 130), (3, 2, 100), (2, 2, 16), (4, 1, 1)])
def test_rounds_of_small_blocks(spark, fanout, depth, n):
    rows = rows_of(n, ["a", "a", "b", "c", "d", "e", None])
    more = (F.col("n_chars").cast("decimal(38,0)") + 1).cast("string")
    got = merkle.manifest(spark.createDataFrame(rows, SCHEMA).repartition(3), tampered={"n_chars": more},
                          when=F.crc32(F.col("doc_id").cast("string")) % 7 == 0, fanout=fanout, depth=depth)
    got = got.withColumn("proof_sha256", merkle.digest(merkle.proof(F.col("path"))))
    assert by_row(got, *COLS) == plain(rows, fanout)


def test_a_group_that_holds_all_rows_is_many_ranges(spark, monkeypatch):
    written = []
    monkeypatch.setattr(merkle, "staged", lambda df, name: written.append(staged(df, name)) or written[-1])
    rows = [(i % 7, "same", "en", None, 1, None, None, None) for i in range(4000)]
    got = merkle.numbered(spark.createDataFrame(rows, SCHEMA).select(F.col("lang").alias("grp"), F.col("doc_id").alias("id")), "grp", ["id"])
    assert sorted(r["idx"] for r in got.collect()) == list(range(4000)) and {r["n"] for r in got.collect()} == {4000}
    assert written[0].select(F.shiftright("_at", 33)).distinct().count() == 4


def test_one_changed_field_breaks_its_proof(spark):
    rows = rows_of(40, ["a", "b"])
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("source", "text"):
        got = merkle.manifest(df, tampered={name: F.concat(F.coalesce(name, F.lit("")), F.lit("x"))}, when=F.col("doc_id") % 2 == 0)
        assert all(r["verified"] == (r["doc_id"] is None or r["doc_id"] % 2 != 0) for r in got.collect())


def test_empty_table(spark, no_documents):
    assert QUERIES["op12_merkle"](spark, no_documents).count() == 0


def test_long_text(spark, documents):
    text = "é" * 3_000_000
    folder = documents([text, "b"])
    got = {r["doc_id"]: r["leaf"] for r in QUERIES["op12_merkle"](spark, folder).collect()}
    assert got[0] == plain_leaf(0, "src0", "en", len(text), text)
