"""Benchmark decontamination by greedy string tiling.

Words are runs of ASCII letters (case folded), digits and non-ASCII
characters. A seed is ``min_words`` consecutive words that a text shares with
a benchmark item. Texts are held to a bit table of the items' seeds (a fixed
number of bits whatever the benchmark's size); what passes is joined with the
seeds exactly. A pair whose shared seeds could cover ``threshold`` of the item
is tiled: with a falling search length, running Karp-Rabin hashes find the
longest matches of words neither side has marked, which are marked, longest
first, until none of ``min_words`` is left. The tiles' words over the item's
words are its coverage; reordered passages are covered piece by piece.

Items of at most ``short_words`` words, of which one common phrase is half,
have to be covered whole; an item of fewer than ``min_words`` words has itself as
its only seed. A null text or item has no words, and an item without words is
never matched. Repeated rows, of texts or of items, give repeated results.
Tiles lie inside runs of shared seeds, so only those runs of a text are kept,
whole, however long the text.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventflow.llm.common import col, only, staged, steps, text_bytes, texts
from eventflow.llm.wordhash import mix, shingle_hashes, word_hashes

MIN_WORDS, THRESHOLD = 5, 0.5
#: items of up to so many words have to be covered whole
SHORT_WORDS = 12
TABLE_BITS = 24
_BASE, _MOD = 1_000_003, (1 << 61) - 1


def _table(seed: np.ndarray) -> np.ndarray:
    return (seed >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def _signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def _seeds(words: np.ndarray, before: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The seed of ``size`` words that begins at each word, and which stay inside their text."""
    h, whole = shingle_hashes(words, before, size)
    return mix(h + np.uint64(size)), whole


def item_seeds(items: DataFrame, min_words: int) -> DataFrame:
    """(item, words, seed_words, seeds): the word hashes of each item, the size of its seeds and the seed that begins at each word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in steps(batches, 1):
            words, before = word_hashes(*text_bytes(b.column(1)))
            by_size = {k: _seeds(words, before, k) for k in range(1, min_words + 1)}
            spans = list(zip(before[:-1].tolist(), before[1:].tolist()))
            size = [min(min_words, e - a) for a, e in spans]
            w = [_signed(words[a:e]) for a, e in spans]
            s = [_signed(by_size[k][0][a:e][by_size[k][1][a:e]]) if k else np.zeros(0, np.int64) for (a, e), k in zip(spans, size)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(w, pa.list_(pa.int64())), pa.array(size, pa.int32()), pa.array(s, pa.list_(pa.int64()))],
                                             names=["item", "words", "seed_words", "seeds"])

    out = T.StructType([T.StructField("item", items.schema.fields[0].dataType), T.StructField("words", T.ArrayType(T.LongType())),
                        T.StructField("seed_words", T.IntegerType()), T.StructField("seeds", T.ArrayType(T.LongType()))])
    return items.mapInArrow(run, out)


def seed_table(items: DataFrame) -> np.ndarray:
    """2**TABLE_BITS bits, set where an item has a seed: one bit array of a fixed size from each task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << TABLE_BITS, bool)
        for b in batches:
            bits[_table(b.column(0).flatten().to_numpy().view(np.uint64))] = True
        at = np.flatnonzero(bits)
        yield pa.RecordBatch.from_arrays([pa.array(at)], names=["at"])

    bits = np.zeros(1 << TABLE_BITS, bool)
    bits[items.select("seeds").mapInArrow(run, "at long").distinct().toArrow().column("at").to_numpy()] = True
    return np.packbits(bits)


def shared_runs(src: DataFrame, bits: np.ndarray, sizes: list[int]) -> DataFrame:
    """(id, tk, places, runs, seeds) of texts with seeds in the table: the words of each run of such seeds, and the seeds."""
    spread = src.sparkSession.sparkContext.broadcast(bits)
    kind = src.schema.fields[0].dataType
    out = T.StructType([T.StructField("id", kind), T.StructField("tk", T.LongType()), T.StructField("places", T.ArrayType(T.IntegerType())),
                        T.StructField("words", T.ArrayType(T.LongType())), T.StructField("seeds", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.unpackbits(spread.value).view(bool)
        for b in steps(batches, 2):
            words, before = word_hashes(*text_bytes(b.column(2)))
            found = []
            for size in sizes:
                seeds, whole = _seeds(words, before, size)
                at = np.flatnonzero(known[_table(seeds)] & whole)
                found.append((at, np.full(len(at), size), seeds[at]))
            hit, size, seed = (np.concatenate(c) for c in zip(*found)) if found else (np.zeros(0, np.int64),) * 3
            if not len(hit):
                continue
            order = np.argsort(hit, kind="stable")
            hit, size, seed = hit[order], size[order], seed[order]
            text = np.searchsorted(before, hit, "right") - 1
            rows, at = np.unique(text, return_index=True)
            got = []
            for own, long, seeds in zip(*[np.split(c, at[1:]) for c in (hit, size, seed)]):
                # the words of the runs
                reach = np.zeros(own[-1] - own[0] + int(long.max()) + 1, np.int32)
                np.add.at(reach, own - own[0], 1)
                np.subtract.at(reach, own - own[0] + long, 1)
                inside = np.flatnonzero(np.cumsum(reach) > 0) + own[0]
                got.append((inside, seeds))
            first = before[rows]
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(rows)), b.column(1).take(pa.array(rows)),
                 pa.array([i - f for (i, _), f in zip(got, first)], pa.list_(pa.int32())),
                 pa.array([_signed(words[i]) for i, _ in got], pa.list_(pa.int64())),
                 pa.array([_signed(np.unique(s)) for _, s in got], pa.list_(pa.int64()))], names=out.names)

    return src.mapInArrow(run, out)


def _rolling(tokens: list[int], marked: list[bool], s: int) -> Iterator[tuple[int, int]]:
    """(place, running Karp-Rabin hash) of every s unmarked tokens in a row."""
    top = pow(_BASE, s - 1, _MOD)
    h = n = 0
    for i, t in enumerate(tokens):
        if marked[i]:
            h = n = 0
            continue
        if n == s:
            h -= tokens[i - s] * top
            n -= 1
        h = (h * _BASE + t) % _MOD
        n += 1
        if n == s:
            yield i - s + 1, h


def tiles(item: list[int], text: list[int], min_words: int) -> list[tuple[int, int, int]]:
    """(item place, text place, length) of the tiles of a greedy string tiling; tokens below 0 never match."""
    used_i, used_t = [x < 0 for x in item], [x < 0 for x in text]
    out, s = [], max(min_words, min(len(item), 32))
    while True:
        places: dict[int, list[int]] = {}
        for j, h in _rolling(text, used_t, s):
            places.setdefault(h, []).append(j)
        found, longest = [], 0
        for i, h in _rolling(item, used_i, s):
            for j in places.get(h, ()):
                k = 0
                while (i + k < len(item) and j + k < len(text) and item[i + k] == text[j + k]
                       and not used_i[i + k] and not used_t[j + k]):
                    k += 1
                if k >= s:
                    found.append((k, i, j))
                    longest = max(longest, k)
        if longest > 2 * s:  # search from there, so that long matches come first
            s = longest
            continue
        again = False
        for k, i, j in sorted(found, key=lambda f: (-f[0], f[1], f[2])):
            if any(used_i[i:i + k]) or any(used_t[j:j + k]):
                again = True  # what is left of it may be longer than the next
                break
            used_i[i:i + k] = used_t[j:j + k] = [True] * k
            out.append((i, j, k))
        if again:
            continue
        if s == min_words:
            return out
        s = max(min_words, s // 2)


def find_contamination(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       item_id_col: str = "item_id", item_text_col: str = "text",
                       min_words: int = MIN_WORDS, threshold: float = THRESHOLD, short_words: int = SHORT_WORDS) -> DataFrame:
    """(id, item id, text_key, n_tiles, covered, item_words, coverage) of every pair whose coverage reaches the threshold.

    ``text_key`` is xxhash64 of the text, to tell texts with one id apart.
    """
    df = only(df, [id_col, text_col])
    src = df.select(col(df, id_col).alias("id"), F.coalesce(col(df, text_col).cast("string"), F.lit("")).alias("text"))
    src = src.select("id", F.xxhash64("text").alias("tk"), "text")
    items = item_seeds(texts(benchmark, item_id_col, item_text_col), min_words).withColumn("item_row", F.monotonically_increasing_id())
    items = staged(items, "benchmark-items")
    sizes = sorted(r["seed_words"] for r in items.where("seed_words > 0").select("seed_words").distinct().collect())  # min_words at most
    need = F.when(F.col("item_words") <= short_words, F.lit(1.0)).otherwise(F.lit(threshold))
    shared = staged(shared_runs(src, seed_table(items), sizes).withColumn("row", F.monotonically_increasing_id()), "benchmark-runs")
    places = items.select("item_row", F.size("words").alias("item_words"), "seed_words", F.explode("seeds").alias("seed")).groupBy(
        "item_row", "item_words", "seed_words", "seed").agg(F.count("*").alias("n"))
    hits = shared.select("row", F.explode("seeds").alias("hit"))
    # a seed covers its words of the item at each of its places: no tiling covers more
    pairs = (hits.join(places, hits["hit"] == places["seed"]).groupBy("row", "item_row", "item_words", "seed_words").agg(F.sum("n").alias("n"))
             .where(F.col("n") * F.col("seed_words") >= need * F.col("item_words"))
             .select(F.col("row").alias("pair_row"), F.col("item_row").alias("pair_item")))
    both = (pairs.join(items.select("item", "item_row", F.col("words").alias("item_words")), F.col("pair_item") == F.col("item_row"))
            .join(shared.select("row", "id", "tk", "places", "words"), F.col("pair_row") == F.col("row"))
            .select("id", "item", "tk", "item_words", "places", "words"))
    out = T.StructType([df.schema[id_col], T.StructField(item_id_col, benchmark.schema[item_id_col].dataType),
                        *T._parse_datatype_string("text_key long, n_tiles int, covered int, item_words int, coverage double").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = []
            for item, places, words in zip(*[b.column(i).to_pylist() for i in (3, 4, 5)]):
                known, least = {w: k for k, w in enumerate(dict.fromkeys(item))}, min(min_words, len(item))
                own, cut = [known.get(w, -1) for w in words], np.flatnonzero(np.diff(places) > 1) + 1
                runs = Counter(tuple(own[a:e]) for a, e in zip([0, *cut], [*cut, len(own)]))
                text = []
                for r, n in runs.items():  # more equal runs than an item has room for tiles change nothing
                    text += [*r, -1] * min(n, len(item) // least + 1)
                made.append(tiles([known[w] for w in item], text, least))
            covered = np.array([sum(k for _, _, k in t) for t in made], np.int32)
            size = np.array([len(x) for x in b.column(3).to_pylist()], np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array([len(t) for t in made], pa.int32()), pa.array(covered), pa.array(size),
                 pa.array(covered / size)], names=out.names)

    return both.mapInArrow(run, out).where(F.col("coverage") >= need)
