"""Substring dedup by sliding sentence spans.

A sentence ends behind ``. ! ?`` or a line break. Every run of SENTENCES
consecutive sentences is a span, however short. So that passages inside long or
unpunctuated sentences are found too, sentences are cut into pieces by
winnowing: behind the word with the smallest XXH64 (the last of equals) of
every window of WINDOW words, which depends on the words alone and leaves no
window without a cut; from every piece a run that has PIECES pieces and WORDS
words is a span as well. Any passage of 51 words that two texts share holds such a run: cuts next to its
edges may differ, two windows, and six cuts follow each other by at most one.

Spans are hashed (words lower-cased, white space made single) and joined
globally; every piece that a non-first occurrence of a repeated span covers is
removed. First is the smallest (id, text digest, place); a null id comes last.

Texts are packed into staged chunks. Each distinct span of a chunk sends 32 bits
to its bucket and gets back whether it stands anywhere else; only spans that do
are joined, by 128 bits. A span that a third of all documents hold is one entry
a chunk, then one partial aggregate a task.

Rows with the same id and the same text are one document and give the same
result, so a repeated row keeps what its first occurrence keeps. A null text
counts as empty. Texts are read whole; one that has room for no span loses
nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventflow.llm.common import col, only, shuffle_partitions, staged
from eventflow.llm.suffix_dedup import _SENT, Entries, _answer, _answered, _read, _send, _unpack, pack
from eventflow.llm.wordhash import mix, run_hashes

SENTENCES, PIECES, WORDS, WINDOW = 3, 5, 18, 6

_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_END = np.zeros(256, bool)
_END[np.frombuffer(b".!?\n", np.uint8)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SECOND = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(lowered: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """XXH64 of every word; each distinct word is hashed once."""
    import xxhash
    if not len(starts):
        return np.zeros(0, np.uint64)
    sizes = ends - starts
    off = np.concatenate(([0], np.cumsum(sizes)))
    inside = np.zeros(len(lowered) + 1, np.int8)
    inside[starts] += 1
    np.subtract.at(inside, ends, 1)
    # a word may end where the next begins (at the end of a text or a sentence)
    data = lowered[np.cumsum(inside[:-1]) > 0]
    coded = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(off), pa.py_buffer(data.tobytes())]).dictionary_encode()
    distinct = np.array([xxhash.xxh64_intdigest(w) for w in coded.dictionary.to_pylist()], np.uint64)
    return distinct[coded.indices.to_numpy(zero_copy_only=False)]


def winnowed(hashes: np.ndarray, sentence: np.ndarray, window: int) -> np.ndarray:
    """Words that are the smallest (the last of equals) of a window inside their sentence."""
    out = np.zeros(len(hashes), bool)
    n = len(hashes) - window + 1
    for a in range(0, max(n, 0), 1 << 20):
        b = min(n, a + (1 << 20))
        rows = np.lib.stride_tricks.sliding_window_view(hashes[a:b + window - 1], window)
        least = np.arange(a, b) + window - 1 - np.argmin(rows[:, ::-1], axis=1)
        out[least[sentence[a:b] == sentence[a + window - 1:b + window - 1]]] = True
    return out


class Cut:
    """The pieces of a chunk of texts.

    ``begin`` and ``end`` are places in the chunk's bytes, ``word`` the number
    of words in front of each piece (and in all), ``of`` the number of pieces in
    front of each text (and in all), ``heads`` the pieces that begin a sentence.
    A text that is not empty has a piece, with no words if it has none.
    """

    def __init__(self, data: np.ndarray, off: np.ndarray):
        n = len(data)
        space, ending = _SPACE[data], _END[data]
        blank = space & ~ending  # white space that does not end a sentence
        inner = off[(off > 0) & (off < n)]
        # a sentence begins behind a run of sentence ends and the blanks that follow it
        last = np.maximum.accumulate(np.where(blank, -1, np.arange(n))) if n else np.zeros(0, np.int64)
        before = np.concatenate(([-1], last[:-1]))[:n]
        begins = ~blank & (before >= 0) & ending[before]
        begins[1:] &= ~(ending[1:] & ending[:-1])
        begins[inner] = True
        if n:
            begins[0] = True
        solid = ~space
        first = solid.copy()
        first[1:] &= space[:-1] | begins[1:]
        final = solid.copy()
        final[:-1] &= space[1:] | begins[1:]
        starts, ends = np.flatnonzero(first), np.flatnonzero(final) + 1
        self.hashes = word_hashes(_LOWER[data], starts, ends)
        opening = np.flatnonzero(begins)
        sentence = np.searchsorted(opening, starts, "right") - 1
        text = np.searchsorted(off, starts, "right") - 1
        new_text, new_sentence, cut = (np.ones(len(starts), bool) for _ in range(3))
        new_text[1:] = text[1:] != text[:-1]
        new_sentence[1:] = sentence[1:] != sentence[:-1]
        cut[1:] = winnowed(self.hashes, sentence, WINDOW)[:-1]
        head = np.flatnonzero(new_text | new_sentence | cut)
        # a piece begins where the sentence of the word before it ended, or at its own first word
        at = starts[head]
        behind = np.append(opening, n)[sentence[np.maximum(head - 1, 0)] + 1]
        at = np.where(new_sentence[head], behind, at)
        at = np.where(new_text[head], off[text[head]], at)
        # texts without words, one piece each
        bare = np.flatnonzero((np.diff(off) > 0) & (np.bincount(text, minlength=len(off) - 1) == 0))
        whose = np.concatenate((text[head], bare))
        order = np.argsort(whose, kind="stable")
        self.text = whose[order]
        self.begin = np.concatenate((at, off[bare]))[order]
        self.word = np.append(np.concatenate((head, np.searchsorted(starts, off[bare])))[order], len(starts))
        self.heads = np.flatnonzero(np.concatenate((new_sentence[head] | new_text[head], np.ones(len(bare), bool)))[order])
        self.of = np.searchsorted(self.text, np.arange(len(off)))
        self.end = np.append(self.begin[1:], n)
        closing = self.of[1:][np.diff(self.of) > 0] - 1
        self.end[closing] = off[self.text[closing] + 1]

    def spans(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(piece it begins at, number of pieces, two hashes) of every span that its text has room for."""
        bounds = np.append(self.heads, len(self.text))
        k, e = [np.arange(len(self.text)), self.heads], []
        e.append(np.maximum(k[0] + PIECES, np.searchsorted(self.word, self.word[:-1] + WORDS)))
        e.append(bounds[np.minimum(np.arange(len(self.heads)) + SENTENCES, len(bounds) - 1)])
        whole = np.arange(len(self.heads)) + SENTENCES < len(bounds)
        k, e = np.concatenate(k), np.concatenate(e)
        ok = np.concatenate((np.ones(len(self.text), bool), whole))
        ok &= e <= (self.of[self.text[k] + 1] if len(k) else 0)
        kind = np.repeat(np.array([0, 1], np.uint64), [len(self.text), len(self.heads)])[ok]
        k, e = k[ok], e[ok]
        a, b = self.word[k], self.word[e]
        return k, e - k, run_hashes(self.hashes, a, b) ^ kind, run_hashes(mix(self.hashes ^ _SECOND), a, b)


def pieces(text: bytes) -> list[tuple[int, int, int]]:
    """(start, end, number of words) of each piece of one text; together they are the text."""
    cut = Cut(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    return list(zip(cut.begin.tolist(), cut.end.tolist(), np.diff(cut.word).tolist()))


def _chunk_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        for i in range(b.num_rows):
            yield tuple(c[i] for c in b.columns)


def repeated_spans(chunks: DataFrame, id_type: T.DataType) -> DataFrame:
    """(chunk, at, id, tk, place, size, h1, h2): the spans that may stand at more than one place; ``at`` is the text in its chunk."""
    buckets = shuffle_partitions(chunks.sparkSession)

    def entries_of(sizes, body):
        data, off = _unpack(body.as_py(), sizes.as_py())
        cut = Cut(data, off)
        found = cut.spans()
        return cut, found, Entries(found[2], None)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, sizes, body in _chunk_rows(batches):
            yield _send(chunk.as_py(), 0, entries_of(sizes, body)[2], buckets, 0, buckets, np.uint32)

    answers = staged(_answer(chunks.select("chunk", "sizes", "body").mapInArrow(send, _SENT), buckets, np.uint32), "span-ties")
    out = T.StructType([*T._parse_datatype_string("chunk long, at int").fields, T.StructField("id", id_type),
                        *T._parse_datatype_string("tk long, place int, size int, h1 long, h2 long").fields])

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, keys, sizes, body, bits in _chunk_rows(batches):
            cut, (k, size, h1, h2), entries = entries_of(sizes, body)
            tied = np.flatnonzero(_read(bits.as_py(), 0, entries, buckets))
            k = k[tied]
            text = cut.text[k]
            ids, tks = keys.values.field("id"), keys.values.field("tk")
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(k), chunk.as_py(), np.int64)), pa.array(text.astype(np.int32)), ids.take(pa.array(text)), tks.take(pa.array(text)),
                 pa.array((k - cut.of[text]).astype(np.int32)), pa.array(size[tied].astype(np.int32)),
                 pa.array(h1[tied].view(np.int64)), pa.array(h2[tied].view(np.int64))], names=out.names)

    asked = _answered(chunks.select("chunk", "ids", "sizes", "body"), answers).where("bits IS NOT NULL")
    return asked.select("chunk", "ids", "sizes", "body", "bits").mapInArrow(pick, out)


def removed_runs(chunks: DataFrame, id_type: T.DataType) -> DataFrame:
    """(of, runs): per chunk, the runs (at, place, size) of pieces that non-first repeated spans cover."""
    found = staged(repeated_spans(chunks, id_type), "span-rows")
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "tk", "place")
    firsts = (found.groupBy(F.col("h1").alias("f1"), F.col("h2").alias("f2")).agg(F.min(order).alias("first"), F.max(order).alias("last"))
              .where(F.col("first") != F.col("last")).select("f1", "f2", "first"))
    # staged, so that the join's skewed side is a plain exchange that Spark can split
    firsts = staged(firsts, "span-firsts")
    later = found.join(firsts, (found["h1"] == firsts["f1"]) & (found["h2"] == firsts["f2"])).where(order != F.col("first"))
    return staged(later.groupBy(F.col("chunk").alias("of")).agg(F.collect_list(F.struct("at", "place", "size")).alias("runs")), "span-runs")


def deduplicate(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Per row: id, carry, ``n_bytes``, ``n_removed`` (bytes), ``n_spans`` (removed runs), ``n_pieces``,
    ``n_pieces_removed`` and ``kept`` (the remaining text)."""
    df = only(df, [id_col, text_col, *(carry or [])])
    text = F.coalesce(col(df, text_col).cast("string"), F.lit(""))
    kept_cols = [id_col, *(carry or [])]
    key = F.struct(col(df, id_col).alias("id"), F.xxhash64(text).alias("tk"), *[col(df, c).alias(f"c{k}") for k, c in enumerate(carry or [])])
    chunks = pack(df.select(key.alias("key"), text.alias("text")), "key", "text")
    runs = removed_runs(chunks, df.schema[id_col].dataType)
    joined = chunks.join(runs, chunks["chunk"] == runs["of"], "left").select("ids", "sizes", "body", "runs")
    out = T.StructType([df.schema[c] for c in kept_cols] + T._parse_datatype_string(
        "n_bytes long, n_removed long, n_spans long, n_pieces long, n_pieces_removed long, kept string").fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, sizes, body, runs in _chunk_rows(batches):
            data, off = _unpack(body.as_py(), sizes.as_py())
            cut = Cut(data, off)
            gone = np.zeros(len(cut.text) + 1, np.int64)
            if runs.is_valid:
                at, place, size = (runs.values.field(k).to_numpy() for k in range(3))
                first = cut.of[at] + place
                np.add.at(gone, first, 1)
                np.subtract.at(gone, first + size, 1)
            gone = np.cumsum(gone[:-1]) > 0
            opens = gone.copy()
            opens[1:] &= ~gone[:-1] | (cut.text[1:] != cut.text[:-1])
            length = np.where(gone, cut.end - cut.begin, 0)

            def by_text(x):
                total = np.concatenate(([0], np.cumsum(x, dtype=np.int64)))
                return total[cut.of[1:]] - total[cut.of[:-1]]

            n_bytes, removed = np.diff(off), by_text(length)
            keep = np.repeat(~gone, cut.end - cut.begin)
            ends = np.concatenate(([0], np.cumsum(n_bytes - removed))).astype(np.int64)
            left = pa.Array.from_buffers(pa.large_string(), len(n_bytes), [None, pa.py_buffer(ends), pa.py_buffer(data[keep].tobytes())]).cast(pa.string())
            own = [keys.values.field("id"), *[keys.values.field(f"c{k}") for k in range(len(kept_cols) - 1)]]
            yield pa.RecordBatch.from_arrays([*own, pa.array(n_bytes), pa.array(removed), pa.array(by_text(opens)),
                                              pa.array(np.diff(cut.of)), pa.array(by_text(gone)), left], names=out.names)

    return joined.mapInArrow(run, out)
