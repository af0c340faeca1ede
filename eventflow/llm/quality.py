"""Quality classifier from weak labels.

Heuristic labellers look at a text and say good, bad or nothing; their votes
overlap and contradict each other. Expectation-maximisation over the counts of
all vote patterns of the corpus estimates how often each labeller says what
about good and about bad texts (votes independent given the quality). The
posterior of a text's own pattern is its label; on FIT_ROWS documents at most
(smallest hashes of id and text) these labels train a logistic scorer over
hashed shapes: runs of byte classes (upper, lower, digit, non-ASCII, each
other sign for itself), four at a time, and the votes. A labeller that says
nothing neither counts for nor against. The scorer rates every text.

Counts of patterns (3 ** labellers at most) and the sample are all that
reaches the driver. A null text is the empty text; texts without shapes or
votes get the posterior of their votes instead of a score. Repeated rows
give repeated scores. Texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventflow.llm.common import col, steps, text_bytes, texts, with_fields
from eventflow.llm.wordhash import word_hashes

FIT_ROWS = 8_000
SHAPE_BITS = 12
KEEP = 0.5
VOTE_WEIGHT = 0.5

#: labeller: (measure, bad if above, good if below), or with the signs turned round
LABELLERS = {
    "shouting": ("upper", 0.4, 0.15),
    "signs": ("signs", 0.06, 0.012),
    "sign_runs": ("sign_runs", 0.08, 0.02),
    "lone_signs": ("lone_signs", 0.2, 0.03),
    "stutter": ("stutter", 0.15, 0.03),
    "few_kinds": ("repeats", 0.75, 0.55),
    "same_lines": ("same_lines", 0.3, 0.05),
    "digits": ("digits", 0.2, 0.03),
    "endless": ("endless", 120.0, 40.0),
    "long_words": ("word_bytes", 16.0, 9.0),
}
_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[48:58] = 48
_CLASS[65:91] = 65
_CLASS[97:123] = 97
_CLASS[128:] = 128
_SIGNS = np.isin(np.arange(256), np.frombuffer(b"!#$%&*+/<=>@[\\]^_`{|}~", np.uint8))
_ENDS = np.isin(np.arange(256), np.frombuffer(b".!?;:\n", np.uint8))


def _sums(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return total[off[1:]] - total[off[:-1]]


def measures(data: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    """What the labellers look at, for every text of a batch."""
    kind = _CLASS[data]
    inner = off[(off > 0) & (off < len(data))]
    same = np.zeros(len(data), bool)
    same[1:] = data[1:] == data[:-1]
    same[inner] = False
    signs = _SIGNS[data]
    gap = np.concatenate(([True], data <= 32, [True]))
    visible = np.maximum(_sums(data > 32, off), 1)
    words, before = word_hashes(data, off)
    n = np.diff(before)
    many = np.maximum(n, 1)
    stutter = np.zeros(len(words), bool)
    stutter[1:] = words[1:] == words[:-1]
    first = before[:-1][n > 0]
    stutter[first] = False
    text = np.repeat(np.arange(len(n), dtype=np.uint64), n)
    # distinct words of each text, compared within blocks of 1,000 words so that long texts are not punished
    block = text * np.uint64(1 << 32) + ((np.arange(len(words)) - np.repeat(before[:-1], n)) // 1000).astype(np.uint64)
    key = words ^ (block * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    repeat = np.zeros(len(words), bool)
    repeat[order[1:]] = key[order[1:]] == key[order[:-1]]
    upper, lower = _sums(kind == 65, off), _sums(kind == 97, off)
    lines = [bytes(data[a:b]).split(b"\n") for a, b in zip(off[:-1], off[1:])]
    return {
        "words": n,
        "upper": upper / np.maximum(upper + lower, 1),
        "signs": _sums(signs, off) / visible,
        "sign_runs": _sums(signs & same, off) / many,
        "lone_signs": _sums(signs & gap[:-2] & gap[2:], off) / many,
        "stutter": _sums(stutter, before) / many,
        "repeats": _sums(repeat, before) / many,
        "same_lines": np.array([1 - len(set(x)) / len(x) for x in lines]),
        "digits": _sums(kind == 48, off) / visible,
        "endless": n / np.maximum(_sums(_ENDS[data], off), 1),
        "word_bytes": visible / many,
    }


def votes(m: dict[str, np.ndarray]) -> np.ndarray:
    """One column a labeller: 0 bad, 1 nothing, 2 good. Texts of fewer than eight words get no good votes."""
    out = np.ones((len(m["words"]), len(LABELLERS)), np.int8)
    for k, (what, bad, good) in enumerate(LABELLERS.values()):
        out[m[what] > bad, k] = 0
        out[(m[what] < good) & (m["words"] >= 8), k] = 2
    return out


def patterns(docs: DataFrame) -> DataFrame:
    """(pattern, n): how many texts of (text) have each pattern of votes, as a number in base three."""
    base = 3 ** np.arange(len(LABELLERS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in steps(batches, 0):
            found, n = np.unique(votes(measures(*text_bytes(b.column(0)))) @ base, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int64)), pa.array(n.astype(np.int64))], names=["pattern", "n"])

    return docs.mapInArrow(run, "pattern long, n long").groupBy("pattern").agg(F.sum("n").alias("n"))


class LabelModel:
    """Prior of good texts, and how often each labeller that votes says bad or good of bad and good texts."""

    def __init__(self, prior: float, chance: np.ndarray):
        self.prior, self.chance = prior, chance  # chance[labeller, quality, vote]; 1 for no vote

    def posterior(self, v: np.ndarray) -> np.ndarray:
        """Probability that a text with these votes is good."""
        at = np.arange(len(LABELLERS))
        log = np.log(self.chance)
        good = np.log(self.prior) + log[at, 1, v].sum(1)
        bad = np.log1p(-self.prior) + log[at, 0, v].sum(1)
        return 1 / (1 + np.exp(np.clip(bad - good, -50, 50)))

    def accuracies(self) -> dict[str, float]:
        """How often each labeller that votes is right."""
        right = (1 - self.prior) * self.chance[:, 0, 0] + self.prior * self.chance[:, 1, 2]
        return dict(zip(LABELLERS, right.tolist()))

    @classmethod
    def estimate(cls, v: np.ndarray, n: np.ndarray, rounds: int = 200) -> LabelModel:
        """Expectation-maximisation from pattern counts, begun at labellers that are seldom wrong about good texts."""
        begin = np.array([[0.4, 0.0, 0.6], [0.02, 0.0, 0.98]])
        model = cls(0.85, np.repeat((begin + [0, 1, 0])[None], v.shape[1], 0))
        onehot = (v[:, :, None] == np.array([0, -1, 2])).astype(float)
        last = None
        for _ in range(rounds):
            good = model.posterior(v)
            w = np.stack([(1 - good) * n, good * n])
            counts = np.einsum("qp,plv->lqv", w, onehot) + begin * 5  # held to the beginning by a few texts
            model = cls(float(np.clip((w[1].sum() + 4) / (n.sum() + 5), 1e-3, 1 - 1e-3)),
                        counts / counts.sum(2, keepdims=True) + [0, 1, 0])
            if last is not None and np.abs(good - last).max(initial=0) < 1e-6:
                break
            last = good
        return model


def features(v: np.ndarray, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, slot, weight) of shapes and of votes, by text."""
    of, slot, weight = shapes(data, off)
    voted, who = np.nonzero(v != 1)
    of = np.concatenate((of, voted))
    slot = np.concatenate((slot, (1 << SHAPE_BITS) + who * 3 + v[voted, who]))
    weight = np.concatenate((weight, np.full(len(voted), VOTE_WEIGHT)))
    order = np.argsort(of, kind="stable")
    return of[order], slot[order], weight[order]


def shapes(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed four-grams of byte-class runs: (text, slot, weight), the weights of a text of length one."""
    kind = _CLASS[data]
    new = np.ones(len(kind), bool)
    new[1:] = kind[1:] != kind[:-1]
    new[off[(off > 0) & (off < len(data))]] = True
    # a run of one, two or more of a sign differ
    at = np.flatnonzero(new)
    size = np.minimum(np.diff(np.append(at, len(kind))), 3).astype(np.uint64)
    letter = (kind[at] == 97) | (kind[at] == 128)
    run = kind[at].astype(np.uint64) * np.uint64(4) + np.where(letter, np.uint64(0), size)
    text = np.searchsorted(off, at, "right") - 1
    h = run.copy()
    for k in range(1, 4):
        h[:-k] = h[:-k] * np.uint64(1031) + run[k:] if len(run) > k else h[:-k]
    ok = np.ones(len(run), bool)
    ok[max(0, len(run) - 3):] = False
    ok[:-3] &= text[:-3] == text[3:]
    slot = (h[ok] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SHAPE_BITS)
    pair, count = np.unique(text[ok].astype(np.int64) << SHAPE_BITS | slot.astype(np.int64), return_counts=True)
    of, weight = pair >> SHAPE_BITS, np.log1p(count.astype(float))
    norm = np.sqrt(np.bincount(of, weight ** 2, len(off) - 1))
    return of, pair & ((1 << SHAPE_BITS) - 1), weight / norm[of]


def fit_scorer(rows: list[tuple[np.ndarray, np.ndarray, float]], rounds: int = 120) -> np.ndarray:
    """Weights and intercept of a logistic curve over (slots, weights, label) by accelerated gradient steps."""
    size = (1 << SHAPE_BITS) + 3 * len(LABELLERS) + 1
    if not rows:
        return np.zeros(size)
    at = np.repeat(np.arange(len(rows)), [len(s) for s, _, _ in rows])
    slot, x = np.concatenate([s for s, _, _ in rows]), np.concatenate([w for _, w, _ in rows])
    y = np.array([p for _, _, p in rows])
    w, ahead = np.zeros(size), np.zeros(size)
    for r in range(rounds):
        z = np.bincount(at, ahead[slot] * x, len(rows)) + ahead[-1]
        g = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        grad = np.append(np.bincount(slot, g[at] * x, size - 1), g.sum()) / len(rows) + 1e-4 * ahead
        after = ahead - 2.0 * grad
        ahead, w = after + r / (r + 3) * (after - w), after
    return w


def score(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None,
          keep_text: bool = False) -> DataFrame:
    """Per row: id, (text,) carry, ``posterior`` (of the votes), ``score`` (0 to 1, higher: better) and ``keep``."""
    spark = df.sparkSession
    src = texts(df, id_col, text_col)
    base = 3 ** np.arange(len(LABELLERS))
    seen = patterns(src.select(col(src, text_col))).toPandas()
    v, n = (seen["pattern"].to_numpy()[:, None] // base % 3).astype(np.int8), seen["n"].to_numpy(float)
    model = LabelModel.estimate(v, n)
    total = n.sum()
    # a hash share that holds FIT_ROWS and a little more, then the smallest hashes
    hashed = F.xxhash64(col(src, id_col), col(src, text_col), F.lit(5))
    share = min(1.0, 1.3 * FIT_ROWS / max(total, 1))
    picked = src.select(col(src, text_col).alias("text"), hashed.alias("h"))
    if share < 1:
        picked = picked.where(F.col("h") <= F.lit(int(-2 ** 63 + share * (2 ** 64 - 1))))

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in steps(batches, 0):
            data, off = text_bytes(b.column(0))
            v = votes(measures(data, off))
            of, slot, weight = features(v, data, off)
            cut = np.searchsorted(of, np.arange(b.num_rows + 1))
            yield pa.RecordBatch.from_arrays(
                [b.column(1), pa.array([slot[a:e].astype(np.int16) for a, e in zip(cut[:-1], cut[1:])], pa.list_(pa.int16())),
                 pa.array([weight[a:e].astype(np.float32) for a, e in zip(cut[:-1], cut[1:])], pa.list_(pa.float32())),
                 pa.array(model.posterior(v))], names=["h", "slots", "weights", "label"])

    taken = picked.mapInArrow(sampled, "h long, slots array<short>, weights array<float>, label double").orderBy("h").limit(FIT_ROWS)
    rows = [(np.asarray(r["slots"], np.int64), np.asarray(r["weights"], float), r["label"]) for r in taken.toLocalIterator() if r["slots"]]
    fitted = spark.sparkContext.broadcast((fit_scorer(rows), model))
    src = texts(df, id_col, text_col, carry)
    at = src.columns.index(text_col)
    out = with_fields(src, "posterior double, score double, keep boolean", () if keep_text else (text_col,))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, own = fitted.value
        for b in steps(batches, at):
            data, off = text_bytes(b.column(at))
            v = votes(measures(data, off))
            posterior = own.posterior(v)
            of, slot, weight = features(v, data, off)
            z = np.bincount(of, w[slot] * weight, b.num_rows) + w[-1]
            rated = np.where(np.bincount(of, minlength=b.num_rows) > 0, 1 / (1 + np.exp(-np.clip(z, -30, 30))), posterior)
            kept = [b.column(i) for i in range(b.num_columns) if keep_text or i != at]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(posterior), pa.array(rated), pa.array(rated >= KEEP)], names=out.names)

    return src.mapInArrow(run, out)
