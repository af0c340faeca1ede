"""Toxicity: held-out accuracy, what may be learnt from, and odd rows."""

import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from eventflow.llm import toxicity
from eventflow.llm.queries import QUERIES
from tests.llm.conftest import SCHEMA, rows_of
from tests.llm.test_texts import ODD

RNG = random.Random(5)
ROOTS = ["".join(RNG.choices("aeioulnrst", k=3)) for _ in range(40)]
BAD = ["grumbel", "zwicket", "vorlupp"]


def text(toxic):
    words = ["".join(RNG.choices(ROOTS, k=2)) for _ in range(RNG.randint(30, 120))]
    if toxic:
        for _ in range(len(words) // 20 + 2):
            words[RNG.randrange(len(words))] = RNG.choice(BAD) + RNG.choice(["", "s", "en", "ix"])
    return " ".join(words)


def made(spark, flip=None):
    truth = [RNG.random() < 0.25 for _ in range(600)]
    texts = [text(t) for t in truth]
    rows = rows_of([*texts, *ODD])
    labels = [(i, 1, int(t) if flip is None or zlib.crc32(str(i).encode()) % 3 != 1 else int(flip(t))) for i, t in enumerate(truth)]
    labels += [(0, 1, int(not truth[0])), (5, None, None), (None, 1, 1), (999_999, 0, 1)]
    return truth, spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_op5_held_out_accuracy_and_no_peeking(spark):
    state = RNG.getstate()
    truth, docs, labels = made(spark)
    got = toxicity.score(docs, labels)
    rows = {r["doc_id"]: r for r in got.collect()}
    assert got.count() == docs.count() and got.columns == ["doc_id", "held_out", "score", "predicted"]
    held = [i for i in range(600) if rows[i]["held_out"]]
    assert set(held) == {i for i in range(600) if zlib.crc32(str(i).encode()) % 3 == 1}
    right = sum(rows[i]["predicted"] == truth[i] for i in held)
    wrong = sum(rows[i]["predicted"] and not truth[i] for i in held)
    assert right >= 0.9 * len(held) and wrong <= 0.02 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows.values())
    # labels of held-out rows are never learnt from
    RNG.setstate(state)
    _, docs2, labels2 = made(spark, flip=lambda t: not t)
    other = {r["doc_id"]: r["score"] for r in toxicity.score(docs2, labels2).collect()}
    assert all(abs(other[i] - rows[i]["score"]) < 1e-6 for i in range(600))


def test_no_labels_and_empty_tables(spark, documents, no_documents, tmp_path):
    labels = "doc_id long, quality int, toxic int"
    for folder in (documents(ODD), no_documents):
        spark.createDataFrame([], labels).write.parquet(f"{folder}/labels.parquet")
    got = QUERIES["op5_toxicity"](spark, str(tmp_path)).collect()
    assert len(got) == len(ODD) + 2 and all(r["predicted"] == 0 for r in got)
    assert QUERIES["op5_toxicity"](spark, no_documents).count() == 0


def test_stream_and_ratio_by_hand():
    data = pa.array(["Ab,  c", "", " x", None, "é"])
    folded, starts = toxicity.stream(*toxicity.text_bytes(data.fill_null("")))
    cut = [bytes(folded[a:b]) for a, b in zip(starts[:-1], starts[1:])]
    assert cut == [b" ab c", b" ", b" x", b" ", b" \xc3\xa9"]
    key, whole = toxicity.grams(folded, starts)
    assert [hex(int(k)) for k in key[whole]] == [hex(int.from_bytes(b" ab c", "big"))]


def test_fit_equals_plain_counts(spark):
    train = [(1, "abcabd"), (1, "abcabx"), (0, "abcabc abd"), (0, "abcabe"), (0, "abcabe")] * 2
    ratios = toxicity.fit(spark.createDataFrame(train, "toxic int, text string"))
    t, o = {}, {}
    for label, s in train:
        b = b" " + s.encode()
        for g in {b[k:k + 5] for k in range(len(b) - 4)}:
            t[g], o[g] = t.get(g, 0) + label, o.get(g, 0) + 1 - label
    d, low = toxicity.DISCOUNT, toxicity.LOWER_DISCOUNT
    c4, c3 = {}, {}
    for g in t:
        c4[g[1:]] = c4.get(g[1:], 0) + 1
    for g in c4:
        c3[g[1:]] = c3.get(g[1:], 0) + 1

    def lower(c, g, rest):
        same = [v for k, v in c.items() if k[:-1] == g[:-1]]
        return (c[g] - low) / sum(same) + low * len(same) / sum(same) * rest

    def upper(c, g, rest):
        same = [v for k, v in c.items() if k[:-1] == g[:-1]]
        n = sum(same)
        return rest if not n else max(c[g] - d, 0) / n + sum(min(v, d) for v in same) / n * rest

    for g in t:
        shared = lower(c4, g[1:], lower(c3, g[2:], 1 / 64))
        ordinary = upper(o, g, shared)
        want = np.log(upper(t, g, ordinary)) - np.log(ordinary)
        key = np.array([int.from_bytes(g, "big")], np.uint64)
        assert abs(float(ratios.seen[toxicity.slot(key, toxicity.SLOT_BITS)][0]) - want) < 1e-5


def test_grams_of_one_slot_keep_their_own_ratios(spark):
    words = ["".join(w) for w in itertools.product("abcdefghijklmnopqrstuvwxyz0123456789", repeat=4)]
    key = np.array([int.from_bytes(b" " + w.encode(), "big") for w in words], np.uint64)
    at = toxicity.slot(key, toxicity.SLOT_BITS)
    places, n = np.unique(at, return_counts=True)
    bad, plain, unseen = (words[k] for k in np.flatnonzero(at == places[n >= 3][0])[:3])
    train = [(1, bad)] * 12 + [(0, f"{plain} {bad[:3]} x")] * 400
    ratios = toxicity.fit(spark.createDataFrame(train, "toxic int, text string"))
    rate, n_words = ratios.of_texts(pa.array([bad, plain, unseen]))
    assert rate[0] > 0 and rate[1] == rate[2] == 0 and list(n_words) == [1, 1, 1]
    # two toxic words of one slot: one stands in the sorted list
    train = [(1, bad)] * 12 + [(1, plain)] * 8 + [(0, f"{unseen} {bad[:3]} x {plain[:3]} y")] * 400
    ratios = toxicity.fit(spark.createDataFrame(train, "toxic int, text string"))
    rate, _ = ratios.of_texts(pa.array([bad, plain, unseen]))
    assert len(ratios.seen.keys) == 1 and rate[0] > 0 and rate[1] > 0 and rate[2] == 0


def test_long_texts_are_rated_whole(spark):
    """What stands at the end of megabytes counts as much as at the beginning."""
    plain = [" ".join("".join(RNG.choices(ROOTS, k=2)) for _ in range(40)) for _ in range(60)]
    bad = " ".join(RNG.choices(BAD, k=40))
    train = [(0, t) for t in plain] * 3 + [(1, f"{t} {bad}") for t in plain[:20]]
    ratios = toxicity.fit(spark.createDataFrame(train, "toxic int, text string"))
    long = " ".join(plain * 1500)
    rate, words = ratios.of_texts(pa.array([long, f"{bad} {long}", f"{long} {bad}", bad]))
    assert words.tolist() == [60 * 1500 * 40 + k for k in (0, 40, 40, 0)][:3] + [40]
    assert rate[0] == 0 and rate[3] > 0 and abs(rate[1] - rate[2]) <= 0.1 * rate[3] and rate[2] > 0.8 * rate[3]
