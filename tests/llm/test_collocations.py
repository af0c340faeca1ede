"""Collocations against plain counting of every phrase, and the parts of the graph."""

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from eventflow.llm import collocations
from eventflow.llm.queries import ORACLE, QUERIES
from tests.llm.conftest import SCHEMA
from tests.llm.test_texts import ODD, by_row

RNG = random.Random(13)
COLS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def plain_counts(rows):
    f, n = Counter(), Counter()
    for r in rows:
        lang = "und" if r[2] is None else r[2]
        text = re.sub("[A-Z]", lambda m: m.group().lower(), r[1] or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                f.update((lang, *w[i:i + k]) for i in range(len(w) - k + 1))
    return f, n


def plain(rows, least=10, top=2000):
    f, n = plain_counts(rows)
    out = []
    found = [p for p, a in f.items() if len(p) > 2 and a >= least]
    inside = Counter()
    for p in found:
        if len(p) == 4:
            for q in ((p[0], *p[1:3]), (p[0], *p[2:4])):
                inside[q] = max(inside[q], f[p])
    for p in found:
        lang, w, a = p[0], p[1:], f[p]
        if len(w) == 2 and 100 * inside[p] >= 50 * a:
            continue
        cuts = [(1000000 * a * a // (f[(lang, *w[:k])] * f[(lang, *w[k:])]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        out.append((lang, -score, -a, " ".join(w).encode(), f[(lang, *w[:k])], f[(lang, *w[k:])]))
    out.sort()
    rank, got = Counter(), []
    for lang, score, a, phrase, l, r in out:
        rank[lang] += 1
        if rank[lang] <= top:
            got.append((lang, rank[lang], phrase.decode(), -a, l, r, n[lang], -score))
    return sorted(got, key=repr)


def rows_of(texts, langs):
    rows = [(i, t, RNG.choice(langs), None, 1, "x", None, "y") for i, t in enumerate(texts)]
    return [*rows, rows[0], rows[-1], (None, "A b. a B", None, None, None, None, None, None)]


def talk(words, n):
    return "".join(RNG.choice(words) + RNG.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "; x: "]) for _ in range(n))


def passages():
    """Long repeated stretches (paths), some that share their middle, and a ring."""
    a = " ".join(f"p{i}" for i in range(700))
    b = " ".join(f"q{i}" for i in range(30))
    ring = " ".join(["r1", "r2", "r3", "r4", "r5"] * 30)
    return [a] * 11 + [f"s{i % 2} {b} t{i % 2}" for i in range(24)] + [ring, "again " * 40, "x y z w v. " * 12]


def test_op13_equals_plain_counts_and_sql(spark, tmp_path):
    words = ["a", "B", "c", "é", "É", "d-e", "日本", "f'", "\x00", "G"]
    rows = rows_of(ODD + passages() + [talk(words, RNG.randint(1, 120)) for _ in range(150)], ["en", "en", "fr", None, "", "und"])
    spark.createDataFrame(rows, SCHEMA).repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["op13_collocations"](spark, str(tmp_path))
    assert got.columns == COLS and [t for _, t in got.dtypes] == ["string", "bigint", "string", *["bigint"] * 5]
    found = by_row(got, *COLS)
    assert found == plain(rows) and len({r[0] for r in found}) == 4
    con = duckdb.connect()
    con.sql(f"create view documents as select * from read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert sorted(con.sql(ORACLE["op13_collocations"]).select(*COLS).fetchall(), key=repr) == found


@pytest.mark.parametrize("least, top", [(2, 7), (3, 100000), (300, 5)])
def test_other_counts_small_chunks_and_ties(spark, monkeypatch, least, top):
    monkeypatch.setattr(collocations, "CHUNK_BYTES", 300)
    rows = rows_of(passages()[10:] + [talk(["a", "b", "c", "d"], 60) for _ in range(60)], ["x", "x", None])
    got = collocations.collocations(spark.createDataFrame(rows, SCHEMA).repartition(3), min_count=least, top=top)
    assert by_row(got, *COLS) == plain(rows, least, top)


def test_names_that_phrases_share_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(collocations, "mix", lambda h: np.full(len(h), 7, np.uint64))
    rows = rows_of([talk(["a", "b", "c"], 30) for _ in range(30)], ["x", "y"])
    got = collocations.collocations(spark.createDataFrame(rows, SCHEMA))
    assert by_row(got, *COLS) == plain(rows)


def test_paths_hold_every_edge_once_in_stretches(spark):
    rows = rows_of(passages(), ["x"])
    df = spark.createDataFrame(rows, SCHEMA)
    graph = collocations.Graph(collocations.phrase_counts(collocations.chunks(df, "lang", "text"), 10), 10)
    f, _ = plain_counts(rows)
    paths = graph.paths().collect()
    edges = [" ".join(p["words"][i:i + 3]) for p in paths for i in range(len(p["weights"]))]
    assert sorted(edges) == sorted(" ".join(g[1:]) for g, a in f.items() if len(g) == 4 and a >= 10)
    longest = max(paths, key=lambda p: (len(p["weights"]), p["start"]))
    assert len(longest["weights"]) == collocations.STRETCH and len([p for p in paths if p["start"] == longest["start"]]) == 3
    for p in paths:
        for i, (w, c) in enumerate(zip(p["weights"], p["corrections"])):
            assert w == f[("x", *p["words"][i:i + 3])] and w + c == f[("x", *p["words"][i:i + 2])]
        assert p["last_flow"] == f[("x", *p["words"][-2:])]


def test_long_texts_are_cut_between_pieces_only():
    data = np.frombuffer(("word " * 50 + ". " + "x" * 400 + " y. z").encode(), np.uint8)
    parts = collocations.between_pieces(data, 100)
    assert parts[0][0] == 0 and parts[-1][1] == len(data) and all(a[1] == b[0] for a, b in zip(parts, parts[1:]))
    assert all(bytes(data[b - 1:b]) == b"." for _, b in parts[:-1]) and len(parts) == 3


def test_empty_table_and_wordless_texts(spark, no_documents, documents):
    assert QUERIES["op13_collocations"](spark, no_documents).count() == 0
    assert QUERIES["op13_collocations"](spark, documents([None, "", " .,\n"])).count() == 0
