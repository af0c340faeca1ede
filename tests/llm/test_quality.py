"""Weak labels: the label model recovers planted accuracies, the scorer tells junk from prose."""

import random

import numpy as np
import pyarrow as pa

from eventflow.llm import quality
from eventflow.llm.common import text_bytes
from eventflow.llm.queries import QUERIES
from tests.llm.conftest import SCHEMA, rows_of
from tests.llm.test_texts import ODD

RNG = random.Random(13)
KINDS = [f"{a}{b}" for a in ("an", "re", "tion", "ing", "the", "out", "lo", "mi") for b in ("er", "ed", "la", "se", "no", "", "ta", "ri")]


def prose(n):
    out = []
    while n > 0:
        k = RNG.randint(4, 14)
        out.append(" ".join(RNG.choices(KINDS, k=k)).capitalize() + RNG.choice([". ", ".\n"]))
        n -= k
    return "".join(out).strip()


def junk(n):
    w = RNG.choices(KINDS, k=n)
    return RNG.choice([lambda: " ".join(x.upper() + "!!" for x in w), lambda: " | ".join(w), lambda: " ".join(x + RNG.choice(["%%%", "$$$"]) for x in w),
                       lambda: " ".join(x for x in w[:n // 10 + 1] for _ in range(10))])()


def test_op2_tells_junk_from_prose(spark):
    truth = [RNG.random() < 0.85 for _ in range(700)]
    texts = [prose(RNG.randint(20, 200)) if t else junk(RNG.randint(20, 200)) for t in truth]
    got = quality.score(spark.createDataFrame(rows_of(texts + ODD), SCHEMA).repartition(3))
    rows = {r["doc_id"]: r for r in got.collect()}
    assert got.count() == len(texts) + len(ODD) + 2
    assert all(0 <= r["score"] <= 1 and r["keep"] == (r["score"] >= quality.KEEP) for r in rows.values())
    lost = sum(not rows[i]["keep"] for i, t in enumerate(truth) if t)
    caught = sum(not rows[i]["keep"] for i, t in enumerate(truth) if not t)
    assert lost <= 0.01 * sum(truth) and caught >= 0.9 * (len(truth) - sum(truth))


def test_estimation_recovers_accuracies():
    rng = np.random.default_rng(1)
    n, wide = 40_000, len(quality.LABELLERS)
    good = rng.random(n) < 0.8
    miss, alarm = np.linspace(0.1, 0.6, wide), np.linspace(0.01, 0.05, wide)
    bad_vote = np.where(good[:, None], rng.random((n, wide)) < alarm, rng.random((n, wide)) > miss)
    v = np.where(rng.random((n, wide)) < 0.3, 1, np.where(bad_vote, 0, 2)).astype(np.int8)
    found, counts = np.unique(v, axis=0, return_counts=True)
    model = quality.LabelModel.estimate(found, counts.astype(float))
    assert abs(model.prior - 0.8) < 0.02
    assert np.abs(model.chance[:, 0, 0] - (1 - miss)).max() < 0.05 and np.abs(model.chance[:, 1, 0] - alarm).max() < 0.02
    assert ((model.posterior(v) > 0.5) == good).mean() > 0.97
    assert set(model.accuracies()) == set(quality.LABELLERS)


def test_measures_by_hand():
    m = quality.measures(*text_bytes(pa.array(["AB cd ab!! | cd", "", "a a a a\nx\nx"])))
    assert m["words"].tolist() == [4, 0, 6]
    assert m["upper"].tolist() == [2 / 8, 0, 0] and m["stutter"].tolist() == [0, 0, 4 / 6]
    assert m["sign_runs"].tolist() == [1 / 4, 0, 0] and m["lone_signs"].tolist() == [1 / 4, 0, 0]
    assert m["repeats"].tolist() == [2 / 4, 0, 4 / 6] and np.allclose(m["same_lines"], [0, 0, 1 / 3])


def test_empty_table(spark, no_documents):
    assert QUERIES["op2_quality"](spark, no_documents).count() == 0


def plain_estimate(votes):
    """Expectation-maximisation text by text."""
    wide = len(votes[0])
    prior, chance = 0.85, [[{0: 0.4, 2: 0.6}, {0: 0.02, 2: 0.98}] for _ in range(wide)]

    def posterior(v):
        bad, good = 1 - prior, prior
        for k, x in enumerate(v):
            if x != 1:
                bad, good = bad * chance[k][0][x], good * chance[k][1][x]
        return good / (good + bad)

    last = None
    for _ in range(200):
        good = [posterior(v) for v in votes]
        new = [[{0: 2.0, 2: 3.0}, {0: 0.1, 2: 4.9}] for _ in range(wide)]
        for v, p in zip(votes, good):
            for k, x in enumerate(v):
                if x != 1:
                    new[k][0][x] += 1 - p
                    new[k][1][x] += p
        prior = min(max((sum(good) + 4) / (len(votes) + 5), 1e-3), 1 - 1e-3)
        chance = [[{x: c / sum(q.values()) for x, c in q.items()} for q in pair] for pair in new]
        if last is not None and max(abs(a - b) for a, b in zip(good, last)) < 1e-6:
            break
        last = good
    return [posterior(v) for v in votes]


def plain_features(text, v):
    """Slot -> weight: hashed four-grams of runs of byte classes, and the votes."""
    runs, data = [], text.encode()
    k = 0
    while k < len(data):
        e = k
        while e < len(data) and quality._CLASS[data[e]] == quality._CLASS[data[k]]:
            e += 1
        kind = int(quality._CLASS[data[k]])
        runs.append(kind * 4 + (0 if kind in (97, 128) else min(e - k, 3)))
        k = e
    count = {}
    for a in range(len(runs) - 3):
        h = 0
        for r in runs[a:a + 4]:
            h = (h * 1031 + r) % 2 ** 64
        slot = (h * 0x9E3779B97F4A7C15 % 2 ** 64) >> (64 - quality.SHAPE_BITS)
        count[slot] = count.get(slot, 0) + 1
    norm = sum(np.log1p(c) ** 2 for c in count.values()) ** 0.5
    out = {s: np.log1p(c) / norm for s, c in count.items()}
    return out | {(1 << quality.SHAPE_BITS) + k * 3 + x: quality.VOTE_WEIGHT for k, x in enumerate(v) if x != 1}


def plain_scorer(rows):
    size = (1 << quality.SHAPE_BITS) + 3 * len(quality.LABELLERS) + 1
    w, ahead = np.zeros(size), np.zeros(size)
    for r in range(120):
        grad = 1e-4 * ahead
        for x, y in rows:
            g = 1 / (1 + np.exp(-(sum(ahead[s] * a for s, a in x.items()) + ahead[-1]))) - y
            for s, a in x.items():
                grad[s] += g * a / len(rows)
            grad[-1] += g / len(rows)
        after = ahead - 2.0 * grad
        ahead, w = after + r / (r + 3) * (after - w), after
    return w


def test_op2_equals_plain_estimation_and_scorer(spark):
    texts = [prose(RNG.randint(20, 80)) if RNG.random() < 0.8 else junk(RNG.randint(20, 80)) for _ in range(120)] + ["", "é! x", "word"]
    got = {r["doc_id"]: r for r in quality.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)).collect()}
    v = [quality.votes(quality.measures(*text_bytes(pa.array([t]))))[0].tolist() for t in texts]
    good = plain_estimate(v)
    rows = [plain_features(t, x) for t, x in zip(texts, v)]
    w = plain_scorer([(x, p) for x, p in zip(rows, good) if x])
    for i, (x, p) in enumerate(zip(rows, good)):
        want = 1 / (1 + np.exp(-(sum(w[s] * a for s, a in x.items()) + w[-1]))) if x else p
        assert abs(got[i]["posterior"] - p) < 1e-6 and abs(got[i]["score"] - want) < 1e-4
