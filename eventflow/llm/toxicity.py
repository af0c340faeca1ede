"""Toxicity by class-conditional Kneser-Ney models over byte n-grams.

A text becomes a stream of bytes: A-Z lower-cased, everything but letters,
digits and non-ASCII bytes a space, runs of spaces made one. For both classes
(toxic, ordinary) the model gives the probability of a byte after the four
before it, by interpolated Kneser-Ney: counts are numbers of labelled training
texts that hold a five-gram, less an absolute discount of DISCOUNT (so what a
single text alone holds says nothing about itself). What the discount frees in
the toxic class, which has far fewer texts, goes to the ordinary class's
distribution, and what it frees there to lower orders that both classes share,
estimated from continuation counts of all training texts: a rare expression
has the same shared backoff on both sides. A word's log-likelihood ratio is
the sum over its five-grams; what the toxic likelihood has ahead of the
ordinary one beyond MARGIN nats a word, summed over a text and divided by its
number of words, is the text's rate. The margin keeps the noise of ordinary
words out of long texts. The rate's square root is mapped to a probability by
a logistic curve fitted on the training texts.

Counts cover every labelled training row and grow with the input. Every
five-gram and every context keeps its own ratio. A five-gram in no more than
DISCOUNT toxic texts has exactly its context's ratio, and a context without
another five-gram the ratio 0, so only the others have to be known to score.
They are the only thing that is broadcast: one key a slot in two tables, and
those whose slot another key has in sorted lists (12 bytes each), which grow
with the five-grams that stand in more than DISCOUNT toxic training texts.

Training uses labelled rows whose crc32 of the id as text is not 1 modulo 3.
Labels that are null, or given twice with different values, are not used. A
null text is the empty text; texts without words have rate 0.
With no labelled rows of a class every score is the same. Repeated rows give repeated
scores. Whole texts are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventflow.llm.common import col, only, staged, steps, text_bytes, texts, with_fields

SLOT_BITS, CONTEXT_BITS = 21, 19
DISCOUNT, LOWER_DISCOUNT = 3.0, 0.75
MARGIN = 2.0
THRESHOLD = 0.7
#: bins of the histogram of the rate's square root that the logistic curve is fitted on
BINS, SPAN = 2000, 4.0

_FOLD = np.full(256, 32, np.uint8)
_FOLD[48:58] = np.arange(48, 58)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def stream(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Folded bytes of all texts, each led by one space and without one at its end, and the texts' starts."""
    n = len(off) - 1
    out = np.full(len(data) + n, 32, np.uint8)
    at = np.arange(len(data)) + np.repeat(np.arange(1, n + 1), np.diff(off))
    out[at] = _FOLD[data]
    starts = off[:-1] + np.arange(n)
    space = out == 32
    keep = ~space
    keep[1:] |= ~space[:-1]  # the first of a run of spaces
    keep[starts] = True
    second = starts[np.diff(off) > 0] + 1  # a space behind the leading one goes
    keep[second] &= ~space[second]
    places = np.concatenate(([0], np.cumsum(keep)))
    return out[keep], np.concatenate((places[starts], places[-1:]))


def grams(folded: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The five-gram that ends at each place as a number, and which places have one inside their text."""
    b = folded.astype(np.uint64)
    key = b.copy()
    for k in range(1, 5):
        key[k:] |= b[:-k] << np.uint64(8 * k) if len(b) > k else 0
    whole = np.ones(len(b), bool)
    for k in range(4):
        at = starts[:-1] + k
        whole[at[at < starts[1:]]] = False
    return key, whole


def slot(key: np.ndarray, bits: int) -> np.ndarray:
    return (key * _MIX) >> np.uint64(64 - bits)


def is_held_out(id_column):
    return F.crc32(id_column.cast("string").cast("binary")) % 3 == 1


def _usable(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """(of, toxic): one row per id that has exactly one label value."""
    labels = only(labels, [id_col, label_col])
    return (labels.select(col(labels, id_col).alias("of"), col(labels, label_col).cast("int").alias("toxic"))
            .where("of IS NOT NULL AND toxic IN (0, 1)").groupBy("of")
            .agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most")).where("toxic = most").drop("most"))


def count_grams(train: DataFrame) -> DataFrame:
    """(gram, t, o): in how many toxic and ordinary texts of (toxic, text) each five-gram stands."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = np.uint64((1 << 40) - 1)
        for b in steps(batches, 1):
            toxic = b.column(0).to_numpy(zero_copy_only=False).astype(bool)
            for first in range(0, b.num_rows, 1 << 20):  # 40 bits of gram, 20 of place, one of class
                part = b.slice(first, 1 << 20)
                folded, starts = stream(*text_bytes(part.column(1)))
                key, whole = grams(folded, starts)
                doc = np.repeat(np.arange(part.num_rows, dtype=np.uint64), np.diff(starts))
                own = np.unique(doc[whole] << np.uint64(40) | key[whole])  # once a text
                label = toxic[first + (own >> np.uint64(40)).astype(np.int64)]
                found, at = np.unique(own & low, return_inverse=True)
                t = np.bincount(at, label, len(found)).astype(np.int64)
                n = np.bincount(at, minlength=len(found))
                yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int64)), pa.array(t), pa.array(n - t)], names=["gram", "t", "o"])

    return train.mapInArrow(run, "gram long, t long, o long").groupBy("gram").agg(F.sum("t").alias("t"), F.sum("o").alias("o"))


def _lower_orders(counted: DataFrame) -> DataFrame:
    """(four, p): the shared probability of a four-gram's last byte after its first three."""
    four = counted.groupBy(F.col("gram").bitwiseAND(F.lit(0xFFFFFFFF)).alias("four")).agg(F.count("*").alias("c"))
    three = four.groupBy(F.col("four").bitwiseAND(F.lit(0xFFFFFF)).alias("three")).agg(F.count("*").alias("c"))
    two = three.groupBy(F.shiftright("three", 8).alias("two")).agg(F.sum("c").alias("s"), F.count("*").alias("n"))
    p3 = (three.join(two, F.shiftright("three", 8) == F.col("two"))
          .select(F.col("three").alias("of3"), ((F.col("c") - LOWER_DISCOUNT) / F.col("s") + LOWER_DISCOUNT * F.col("n") / F.col("s") / 64).alias("p3")))
    head = four.groupBy(F.shiftright("four", 8).alias("head")).agg(F.sum("c").alias("s"), F.count("*").alias("n"))
    return (four.join(head, F.shiftright("four", 8) == F.col("head")).join(p3, F.col("four").bitwiseAND(F.lit(0xFFFFFF)) == F.col("of3"))
            .select("four", ((F.col("c") - LOWER_DISCOUNT) / F.col("s") + LOWER_DISCOUNT * F.col("n") / F.col("s") * F.col("p3")).alias("p")))


class Exact:
    """A value for each of many keys: one key a slot, the others in a sorted list."""

    def __init__(self, bits: int, rows: pa.Table):
        self.value = np.full(1 << bits, np.nan, np.float32)
        self.owner = np.zeros(1 << bits, np.uint64)
        at = rows.column("slot").to_numpy()
        self.value[at] = rows.column("ratio").to_numpy()
        self.owner[at] = rows.column("key").to_numpy().astype(np.uint64)
        more = pa.concat_arrays(rows.column("more").chunks).flatten() if rows.num_rows else None
        keys, values = (np.zeros(0, np.uint64), np.zeros(0, np.float32)) if more is None else (
            more.field("key").to_numpy(zero_copy_only=False).astype(np.uint64),
            more.field("ratio").to_numpy(zero_copy_only=False).astype(np.float32))
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]

    def __getitem__(self, slots: np.ndarray) -> np.ndarray:
        return self.value[slots]

    def of(self, key: np.ndarray) -> np.ndarray:
        """The keys' values; NaN for a key that is not held."""
        at = slot(key, len(self.value).bit_length() - 1)
        got = self.value[at]
        other = np.flatnonzero(self.owner[at] != key)
        got[other] = np.nan
        if len(self.keys):
            asked = key[other]
            place = np.minimum(np.searchsorted(self.keys, asked), len(self.keys) - 1)
            held = self.keys[place] == asked
            got[other[held]] = self.values[place[held]]
        return got


class Ratios:
    """Log-likelihood ratios: of five-grams seen in training, and of contexts for the others."""

    def __init__(self, seen: Exact, context: Exact):
        self.seen, self.context = seen, context

    def of_texts(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Sum of what the words' ratios have beyond the margin, and number of words, of each text."""
        folded, starts = stream(*text_bytes(column))
        key, whole = grams(folded, starts)
        got = self.seen.of(key)
        new = np.isnan(got)
        got[new] = np.nan_to_num(self.context.of(key[new] >> np.uint64(8)))
        got[~whole] = 0
        begin = folded == 32  # each word with the space that leads it
        word = np.bincount(np.cumsum(begin) - 1, got, int(begin.sum()))
        before = np.searchsorted(np.flatnonzero(begin), starts)
        beyond = np.concatenate(([0.0], np.cumsum(np.maximum(word - MARGIN, 0))))
        words = np.diff(before)
        words[np.diff(starts) == 1] = 0  # the lone space of an empty text
        return np.diff(beyond[before]), words


def fit(train: DataFrame) -> Ratios:
    """The models' ratios from (toxic, text).

    One five-gram a slot reaches the driver, one context a slot, and what else
    has a ratio of its own: five-grams of more than DISCOUNT toxic texts, and
    their contexts.
    """
    counted = staged(count_grams(train), "toxicity-counts")
    context = counted.groupBy(F.shiftright("gram", 8).alias("context")).agg(
        F.sum("t").alias("ct"), F.sum("o").alias("co"), F.sum(F.least("t", F.lit(DISCOUNT))).alias("nt"),
        F.sum(F.least("o", F.lit(DISCOUNT))).alias("no"))
    lower = _lower_orders(counted)

    def freed(n: str, c: str):
        return F.when(F.col(c) > 0, F.col(n) / F.col(c)).otherwise(1.0)

    def chance(k: str, n: str, c: str, backoff):
        held = F.when(F.col(c) > 0, F.greatest(F.col(k) - DISCOUNT, F.lit(0.0)) / F.col(c)).otherwise(0.0)
        return held + freed(n, c) * backoff

    ordinary = chance("o", "no", "co", F.col("p"))

    mixed = (counted.join(context, F.shiftright("gram", 8) == F.col("context"))
             .join(lower, F.col("gram").bitwiseAND(F.lit(0xFFFFFFFF)) == F.col("four"))
             .select(F.col("gram").alias("key"), (F.log(chance("t", "nt", "ct", ordinary)) - F.log(ordinary)).alias("ratio"),
                     (F.col("t") > DISCOUNT).alias("own")))
    apart = context.where("nt < ct").select(F.col("context").alias("key"), F.log(freed("nt", "ct")).alias("ratio"), F.lit(True).alias("own"))
    return Ratios(_exact(mixed, SLOT_BITS), _exact(apart, CONTEXT_BITS))


def _exact(df: DataFrame, bits: int) -> Exact:
    """The ratios of (key, ratio, own); a key that is not ``own`` is held if its slot is free."""
    best, more = F.max(F.struct("own", "key", "ratio")), F.collect_list(F.when(F.col("own"), F.struct("key", "ratio")))
    slots = _with_slot(df, bits).groupBy("slot").agg(best.alias("best"), more.alias("more"))
    return Exact(bits, slots.select("slot", "best.key", "best.ratio", F.filter("more", lambda x: x["key"] != F.col("best.key")).alias("more")).toArrow())


def _with_slot(df: DataFrame, bits: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = slot(b.column(0).to_numpy().astype(np.uint64), bits).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(s), b.column(0), b.column(1).cast(pa.float32()), b.column(2)], names=["slot", "key", "ratio", "own"])

    return df.mapInArrow(run, "slot int, key long, ratio float, own boolean")


def logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a logistic curve through counted points, lightly held back."""
    scale = max(float(np.sqrt((n * x * x).sum() / n.sum())), 1e-6)
    a = np.stack([x / scale, np.ones_like(x)], 1)
    w, hold = np.zeros(2), np.array([1e-6, 1e-8]) * n.sum()
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        g = a.T @ (n * (p - y)) + hold * w
        h = (a * (n * p * (1 - p))[:, None]).T @ a + np.diag(hold + 1e-9)
        step = np.linalg.solve(h, g)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0] / scale), float(w[1])


def score(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          carry: list[str] | None = None, keep_text: bool = False) -> DataFrame:
    """Per row: id, (text,) carry, ``held_out``, ``score`` and ``predicted``."""
    usable = _usable(labels, id_col, label_col)
    learn = usable.where(~is_held_out(F.col("of")))
    src = texts(df, id_col, text_col)
    # one plan at every size: labels grow with the documents
    train = (src.where(~is_held_out(col(src, id_col))).join(learn.hint("merge"), col(src, id_col) == F.col("of"))
             .select("toxic", col(src, text_col)))
    ratios = fit(train)
    spread = df.sparkSession.sparkContext.broadcast((ratios.seen, ratios.context))
    src = texts(df, id_col, text_col, carry)
    at = src.columns.index(text_col)
    out = with_fields(src, "rate double", () if keep_text else (text_col,))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Ratios(*spread.value)
        for b in steps(batches, at):
            total, words = own.of_texts(b.column(at))
            kept = [b.column(i) for i in range(b.num_columns) if keep_text or i != at]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(np.maximum(total, 0) / np.maximum(words, 1))], names=out.names)

    rated = src.mapInArrow(run, out)
    if keep_text:  # the training rows are rated twice, so that no text is staged
        known = src.where(~is_held_out(col(src, id_col))).mapInArrow(run, out)
    else:
        known = rated = staged(rated, "toxicity-rates")
    known = known.select(col(known, id_col).alias("id"), "rate").where(~is_held_out(F.col("id"))).join(learn, F.col("id") == F.col("of"))
    root = F.sqrt("rate")
    place = F.floor(F.least(root, F.lit(SPAN)) * (BINS / SPAN))
    points = known.groupBy(place.alias("place"), "toxic").agg(F.count("*").alias("n")).toPandas()
    slope, intercept = (0.0, -3.0) if points["toxic"].nunique() < 2 else logistic(
        (points["place"].to_numpy(float) + 0.5) * (SPAN / BINS), points["toxic"].to_numpy(float), points["n"].to_numpy(float))
    chance = 1 / (1 + F.exp(-(root * slope + intercept)))
    kept = [c for c in rated.columns if c != "rate"]
    return rated.select(*[col(rated, c) for c in kept], F.coalesce(is_held_out(col(rated, id_col)), F.lit(False)).alias("held_out"),
                        chance.alias("score"), (chance >= THRESHOLD).cast("int").alias("predicted"))
