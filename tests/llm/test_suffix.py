"""Exact substring dedup against brute force over every window."""

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from eventflow.llm import suffix_dedup
from eventflow.llm.queries import QUERIES
from tests.llm.conftest import SCHEMA, rows_of
from tests.llm.test_texts import ODD, by_row

RNG = random.Random(3)


def plain(rows, length):
    raw = [(r[0], (r[1] or "").encode()) for r in rows]
    seen = Counter(t[k:k + length] for _, t in raw for k in range(len(t) - length + 1))
    out = []
    for i, t in raw:
        gone = bytearray(len(t))
        for k in range(len(t) - length + 1):
            if seen[t[k:k + length]] > 1:
                gone[k:k + length] = b"\1" * length
        kept = bytes(a for a, g in zip(t, gone) if not g)
        out.append((i, len(t), sum(gone), len([1 for x in bytes(gone).split(b"\0") if x]), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def noise(n, alphabet="abcdefgh é\n"):
    return "".join(RNG.choices(alphabet, k=n))


def planted(length):
    core = [noise(n) for n in (length - 1, length, length + 1, 2 * length, 5 * length)]
    texts = [noise(RNG.randint(0, 900)) + RNG.choice(core) + noise(RNG.randint(0, 900)) for _ in range(40)]
    texts += [core[4] + noise(5) + core[4], core[4], core[4][7:], core[3] * 3, "ab" * length, noise(length), "\x00" * (length + 3)]
    edited = list(noise(6 * length))
    for _ in range(6):
        edited[RNG.randrange(len(edited))] = "Q"
        texts.append("".join(edited))
    return ODD + texts


def test_op1_equals_brute_force(spark, documents):
    texts = planted(400)
    got = QUERIES["op1_suffix_dedup"](spark, documents(texts))
    assert by_row(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == plain(rows_of(texts), 400)


@pytest.mark.parametrize("length", [30, 160])
def test_other_lengths_and_chunks(spark, length, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CHUNK_BYTES", 3000)
    rows = rows_of(planted(length))
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = suffix_dedup.deduplicate(df, length=length).withColumn("sha", F.sha2("kept", 256))
    assert by_row(got, "doc_id", "n_bytes", "n_removed", "n_spans", "sha") == plain(rows, length)


def test_cover_has_every_difference():
    for r in range(4):
        v, cover = suffix_dedup.difference_cover(r)
        assert len(cover) == 6 * r + 4 and {(a - b) % v for a in cover for b in cover} == set(range(v))


def test_empty_table(spark, no_documents):
    assert QUERIES["op1_suffix_dedup"](spark, no_documents).count() == 0


def signed(exponents):
    """Coefficients of the product of x^e - 1."""
    p = [1]
    for e in exponents:
        q = [0] * (len(p) + e)
        for i, c in enumerate(p):
            q[i + e] += c
            q[i] -= c
        p = q
    return p


def test_texts_that_share_a_polynomial_modulo_a_power_of_two_keep_their_bytes(spark, documents):
    """Prefix sums modulo 2^64 cannot tell these two apart; each differs from the other and occurs once."""
    signs = signed([40, 8, 20, 32, 10, 24, 64, 128, 3])
    assert set(signs) <= {-1, 0, 1} and sum(map(abs, signs)) >= 200
    fill = noise(400, "abcdefgh")
    one = "".join("Y" if c > 0 else "-" if c < 0 else f for c, f in zip(signs + [0] * (400 - len(signs)), fill))
    two = "".join("-" if c > 0 else "Y" if c < 0 else f for c, f in zip(signs + [0] * (400 - len(signs)), fill))
    got = QUERIES["op1_suffix_dedup"](spark, documents(["other", one, two, one[:399], two[:399]]))
    assert {r["doc_id"]: r["n_removed"] for r in got.collect() if r["doc_id"]} == {1: 0, 2: 0, 3: 0, 4: 0}


def test_passages_on_both_sides_of_400_bytes(spark, documents):
    """Passages of 51 to 120 words stand in two documents each; n_passage sees all, n_removed those of 400 bytes."""
    words = [noise(RNG.randint(3, 9), "abcdefghijkl") for _ in range(3000)]
    prose = lambda n: " ".join(RNG.choices(words, k=n))
    passages = [prose(n) for n in (51, 55, 60, 64, 68, 72, 80, 120)]
    texts = [f"{prose(RNG.randint(20, 90))} {p} {prose(RNG.randint(20, 90))}" for p in passages for _ in range(2)]
    clean = [prose(RNG.randint(40, 200)) for _ in range(20)]
    rows = {r["doc_id"]: r for r in QUERIES["op1_suffix_dedup"](spark, documents(["x", *texts, *clean])).collect() if r["doc_id"]}
    for k, p in enumerate(passages):
        for i in (2 * k + 1, 2 * k + 2):
            assert len(p) <= rows[i]["n_passage"] <= len(p) + 40 and rows[i]["n_passages"] == 1
            assert (rows[i]["n_removed"] > 0) == (rows[i]["n_removed"] >= len(p) >= 398) or len(p) in range(380, 400)
    assert {len(p) < 400 for p in passages} == {True, False}
    assert all(rows[i]["n_passage"] == rows[i]["n_removed"] == 0 for i in range(len(texts) + 1, len(texts) + len(clean) + 1))


def test_passage_column_equals_brute_force(spark):
    rows = rows_of(planted(400))
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = suffix_dedup.deduplicate(df, length=400, passage=90)
    want = [(r[0], r[1], r[2], p[2], p[3]) for r, p in zip(plain(rows, 400), plain(rows, 90))]
    both = {(w[0], w[1], w[3], w[4]) for w in want}
    assert {(r["doc_id"], r["n_bytes"], r["n_passage"], r["n_passages"]) for r in got.collect()} == both


def test_a_sign_over_megabytes_is_one_entry_a_chunk(spark):
    import numpy as np
    data = np.full(3_000_000, 97, np.uint8)
    at = np.arange(len(data) - 399)
    entries = suffix_dedup.Entries(*suffix_dedup.names(5)(data, at, 400))
    assert len(entries.long) == 1 and entries.size.tolist() == [len(at)]
    batch = suffix_dedup._send(0, 0, entries, 8, 0, 8, np.uint64)
    assert batch.num_rows == 1 and batch.nbytes < 200


def test_long_text_is_sent_in_parts(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PART_PLACES", 1000)
    body = noise(30_000)
    rows = [(1, body + "X" + body[5000:9000], *[None] * 6), (2, noise(50) + body[100:900], *[None] * 6), (3, "z" * 20_000, *[None] * 6)]
    got = suffix_dedup.deduplicate(spark.createDataFrame(rows, SCHEMA)).withColumn("sha", F.sha2("kept", 256))
    assert by_row(got, "doc_id", "n_bytes", "n_removed", "n_spans", "sha") == plain(rows, 400)
