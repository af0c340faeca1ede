"""Exact substring dedup: which ``length``-byte strings start at more than one place.

Blockwise construction over a difference cover, bounded memory throughout:

1. Texts are packed into chunks of bytes and staged, so that every later step
   sees the same bytes at the same places.
2. The cover sample: places whose offset in their text, modulo the cover's
   period v, lies in the cover. Any two places have a common shift below v
   that puts both in the sample, so two equal ``length``-byte strings contain
   equal sample strings of ``length - v + 1`` bytes at the same shift. Sample
   places are named by those bytes, dealt out by name, and each bucket of
   names is sorted by itself; a place whose neighbour has its name is tied.
3. Only suffixes less than v in front of a tied sample place can have a long
   common prefix with another suffix. They are sorted by the 96-bit name of
   their first ``length`` bytes, one range of names (suffix bucket) after the
   other, each range dealt over all tasks: one range is in flight at a time.
4. Suffixes with an equal neighbour mark ``length`` bytes each.

Only equality of long prefixes matters here, so names (hashes of the bytes)
stand where a full suffix array has lexicographic ranks. A name mixes hashes of
pieces of at most PIECE bytes, under tables and multipliers drawn anew for
every call, so no text can be made to share names; two different strings have
one name with probability 2^-96. The four-byte names of the cover sample are a
filter only. Every distinct name is sent once a chunk, with a bit that says
whether it stands there more than once, and without places: answers are bit
lists in the order of the names. A string that a third of all texts hold is one
entry a chunk, one sign over megabytes one entry in all of them.

A null text is the empty text: no bytes, nothing removed. Texts shorter than
``length`` lose nothing. Copies (repeated rows too) all count as other places,
so every byte of a long text that occurs twice goes. Matches never cross texts.
A long text is one chunk; its places are sent in parts of PART_PLACES.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventflow.llm.common import col, shuffle_partitions, staged, steps, text_bytes, texts

CHUNK_BYTES = 4 << 20
#: ranges of names that are sorted one after the other
RANGES = 3
#: places of a chunk that are sent at once
PART_PLACES = 1 << 23
#: bytes that one hash covers, and hashed at once
PIECE, _SLICE = 128, 1 << 19
_STIR = np.uint64(0xD6E8FEB86659FD93)


def difference_cover(r: int) -> tuple[int, list[int]]:
    """Period 24 r^2 + 36 r + 13 and its cover of 6 r + 4 members (Colbourn and Ling's construction)."""
    gaps = [1] * r + [r + 1] + [2 * r + 1] * r + [4 * r + 3] * (2 * r + 1) + [2 * r + 2] * (r + 1) + [1] * r
    return 24 * r * r + 36 * r + 13, [0, *np.cumsum(gaps).tolist()]


def cover_for(length: int) -> tuple[int, list[int]]:
    """The largest cover whose sample strings keep at least half of ``length``."""
    best = (1, [0])
    r = 0
    while (found := difference_cover(r))[0] <= length // 2:
        best = found
        r += 1
    return best


class Names:
    """96-bit names of substrings: two mixed hashes of every piece, combined under drawn multipliers."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.hashes = []
        for _ in range(2):
            base = int(rng.integers(1, 2 ** 62)) * 2 + 1
            self.hashes.append((rng.integers(1, 2 ** 63, 256, dtype=np.uint64), self._powers(base), self._powers(pow(base, -1, 1 << 64))))
        self.factors = rng.integers(1, 2 ** 62, (2, 1 << 10), dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    @staticmethod
    def _powers(base: int) -> np.ndarray:
        out = np.full(_SLICE + 1, base & (2 ** 64 - 1), np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    def __call__(self, data: np.ndarray, at: np.ndarray, size: int, both: bool = True) -> tuple[np.ndarray, np.ndarray | None]:
        """64 and (if ``both``) 32 bits of the names of data[p:p + size] for the sorted places p in ``at``; memory is bounded by the slice."""
        room, piece = _SLICE - size, min(PIECE, size)
        shifts = [*range(0, size - piece, piece), size - piece]
        if room < 1 or len(shifts) > self.factors.shape[1]:
            raise ValueError("strings of that length are not supported")
        long, short = np.empty(len(at), np.uint64), np.empty(len(at), np.uint32) if both else None
        a = 0
        while a < len(at):
            start = int(at[a])
            b = int(np.searchsorted(at, start + room, "right"))
            part, p = data[start:int(at[b - 1]) + size], at[a:b] - start
            dense = len(p) * 3 > len(part)
            for k, (of_byte, up, down) in enumerate(self.hashes[:1 + both]):
                sums = np.zeros(len(part) + 1, np.uint64)
                np.cumsum(of_byte[part] * up[:len(part)], out=sums[1:])
                mixed = (sums[piece:] - sums[:-piece]) * down[:len(part) - piece + 1]
                mixed ^= mixed >> np.uint64(32)
                mixed *= _STIR
                mixed ^= mixed >> np.uint64(29)
                n = len(part) - size + 1
                name = np.zeros(n if dense else len(p), np.uint64)
                for j, shift in enumerate(shifts):
                    name += (mixed[shift:shift + n] if dense else mixed[p + shift]) * self.factors[k, j]
                name = name[p] if dense else name
                name ^= name >> np.uint64(32)
                name *= _STIR
                name ^= name >> np.uint64(29)
                if k:
                    short[a:b] = name >> np.uint64(32)
                else:
                    long[a:b] = name
            a = b
        return long, short


_NAMES: dict[int, Names] = {}


def names(seed: int) -> Names:
    if seed not in _NAMES:
        if len(_NAMES) > 1:  # a task needs two at most
            _NAMES.clear()
        _NAMES[seed] = Names(seed)
    return _NAMES[seed]


def dealt(named: np.ndarray, n: int) -> np.ndarray:
    """Bucket of each name, by its high bits."""
    return ((named >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


class Entries:
    """The distinct names of some places, in order, and how often each stands there."""

    def __init__(self, long: np.ndarray, short: np.ndarray | None):
        self.order = np.argsort(long)
        ranked = long[self.order]
        other = ranked[1:] != ranked[:-1]
        if short is not None:
            second = short[self.order]
            apart = second[1:] != second[:-1]
            if (apart & ~other).any():  # names that share their first half
                self.order = np.lexsort((short, long))
                second = short[self.order]
                apart = second[1:] != second[:-1]
            other |= apart
        self.head = np.flatnonzero(np.concatenate(([True], other))) if len(long) else np.zeros(0, np.int64)
        self.size = np.diff(np.append(self.head, len(long)))
        self.long, self.short = ranked[self.head], None if short is None else second[self.head]

    def cut(self, n: int) -> np.ndarray:
        """Where each of n buckets begins among the entries (names in order are buckets in order)."""
        return np.searchsorted(dealt(self.long, n), np.arange(n + 1))

    def of_places(self, entry_bits: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self.order), bool)
        out[self.order] = np.repeat(entry_bits, self.size)
        return out


def tied_entries(long: np.ndarray, short: np.ndarray | None, many: np.ndarray) -> np.ndarray:
    """Which entries of a bucket stand at more than one place: more than one entry, or marked as many."""
    order = np.argsort(long)
    if short is not None:
        same = long[order][1:] == long[order][:-1]
        if (same & (short[order][1:] != short[order][:-1])).any():
            order = np.lexsort((short, long))
    ranked = long[order]
    same = ranked[1:] == ranked[:-1]
    if short is not None:
        same &= short[order][1:] == short[order][:-1]
    out = many.copy()
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def sample_places(offsets: np.ndarray, size: int, period: int, cover: list[int]) -> np.ndarray:
    """Places of a chunk whose offset in their text is in the cover and that ``size`` bytes follow."""
    longest = int(np.diff(offsets).max(initial=0))
    pattern = (np.arange(longest // period + 1)[:, None] * period + np.array(cover)).ravel()
    parts = [a + pattern[:np.searchsorted(pattern, b - a - size, "right")]
             for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()) if b - a >= size]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def _unpack(body: bytes, sizes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    import zstandard
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(body, max_output_size=max(1, sum(sizes))), np.uint8)
    return data, np.concatenate(([0], np.cumsum(np.array(sizes, np.int64))))


def pack(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(chunk, ids, sizes, body): texts packed into chunks of about CHUNK_BYTES, staged."""
    src = texts(df, id_col, text_col)
    kind = src.schema.fields[0].dataType
    out = T.StructType([T.StructField("ids", T.ArrayType(kind)), T.StructField("sizes", T.ArrayType(T.LongType())),
                        T.StructField("body", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        zstd = zstandard.ZstdCompressor(level=3)
        ids, sizes, parts, total, arrow = [], [], [], 0, None

        def chunk():
            return pa.RecordBatch.from_arrays(
                [pa.array([ids], pa.list_(arrow)), pa.array([sizes], pa.list_(pa.int64())),
                 pa.array([zstd.compress(b"".join(parts))], pa.binary())], names=out.names)

        for b in steps(batches, 1, CHUNK_BYTES):
            arrow = b.column(0).type
            data, off = text_bytes(b.column(1))
            if ids and total + len(data) > CHUNK_BYTES:
                yield chunk()
                ids, sizes, parts, total = [], [], [], 0
            ids += b.column(0).to_pylist()
            sizes += np.diff(off).tolist()
            parts.append(data.tobytes())
            total += len(data)
        if ids:
            yield chunk()

    return staged(src.mapInArrow(run, out).withColumn("chunk", F.monotonically_increasing_id()), "suffix-chunks")


_SENT = "chunk long, part int, bucket int, task int, names binary, more binary, many binary"


def _send(chunk: int, part: int, entries: Entries, n: int, low: int, high: int, kind) -> pa.RecordBatch:
    """The entries of the buckets low .. high of n, one row a bucket."""
    begin = entries.cut(n)
    filled = [k for k in range(low, high) if begin[k] < begin[k + 1]]
    cols: list[list] = [[], [], []]
    for k in filled:
        own = slice(begin[k], begin[k + 1])
        cols[0].append(entries.long[own].astype(kind).tobytes())
        cols[1].append(b"" if entries.short is None else entries.short[own].tobytes())
        cols[2].append(np.packbits(entries.size[own] > 1).tobytes())
    m = len(filled)
    return pa.RecordBatch.from_arrays(
        [pa.array([chunk] * m, pa.int64()), pa.array([part] * m, pa.int32()), pa.array(filled, pa.int32()), pa.array([k - low for k in filled], pa.int32()),
         *[pa.array(c, pa.binary()) for c in cols]], names=["chunk", "part", "bucket", "task", "names", "more", "many"])


def _answer(sent: DataFrame, buckets: int, kind) -> DataFrame:
    """Sort each bucket of names by itself: (chunk, part, bucket, bits), a bit an entry in the order of the names."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: dict[int, list] = {}
        for b in batches:
            for i in range(b.num_rows):
                long, more = np.frombuffer(b.column(3)[i].as_buffer(), kind), np.frombuffer(b.column(4)[i].as_buffer(), np.uint32)
                many = np.unpackbits(np.frombuffer(b.column(5)[i].as_buffer(), np.uint8), count=len(long)).astype(bool)
                got.setdefault(b.column(2)[i].as_py(), []).append((b.column(0)[i].as_py(), b.column(1)[i].as_py(), long, more, many))
        # a task may be dealt several buckets: equal names have equal buckets
        for k in sorted(got):
            rows = got.pop(k)
            long, more, many = (np.concatenate([r[c] for r in rows]) for c in (2, 3, 4))
            tied = tied_entries(long, more if len(more) else None, many)
            ends = np.cumsum([len(r[2]) for r in rows])
            out = [(r[0], r[1], k, np.packbits(x).tobytes()) for r, x in zip(rows, np.split(tied, ends[:-1])) if x.any()]
            if out:
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int32()),
                                                  pa.array(cols[3], pa.binary())], names=["chunk", "part", "bucket", "bits"])

    return sent.repartitionById(buckets, "task").select("chunk", "part", "bucket", "names", "more", "many").mapInArrow(
        run, "chunk long, part int, bucket int, bits binary")


def _read(bits: list, part: int, entries: Entries, n: int) -> np.ndarray:
    """Answered bits of a part as bits of its places."""
    begin, out = entries.cut(n), np.zeros(len(entries.long), bool)
    for r in bits:
        if r["part"] == part:
            a, b = begin[r["bucket"]], begin[r["bucket"] + 1]
            out[a:b] = np.unpackbits(np.frombuffer(r["bits"], np.uint8), count=b - a).astype(bool)
    return entries.of_places(out)


def _in_parts(at: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    for k, a in enumerate(range(0, len(at), PART_PLACES)):
        yield k, at[a:a + PART_PLACES]


def _answered(chunks: DataFrame, answers: DataFrame) -> DataFrame:
    lists = answers.groupBy(F.col("chunk").alias("of")).agg(F.collect_list(F.struct("part", "bucket", "bits")).alias("bits"))
    return chunks.join(lists, chunks["chunk"] == lists["of"], "left").drop("of")


def _tied_runs(data: np.ndarray, off: np.ndarray, tied: np.ndarray, period: int, length: int) -> np.ndarray:
    """Runs (begin, end) of places less than ``period`` in front of a tied sample place, with a whole string behind them."""
    if not len(tied):
        return np.zeros((0, 2), np.int64)
    doc = np.searchsorted(off, tied, "right") - 1
    a = np.maximum(tied - period + 1, off[doc])
    b = np.minimum(tied + 1, off[doc + 1] - length + 1)
    ok = b > a
    a, b, doc = a[ok], b[ok], doc[ok]
    if not len(a):
        return np.zeros((0, 2), np.int64)
    # both a and b grow, so a run ends where the next begins behind all before
    new = np.concatenate(([True], (a[1:] > b[:-1]) | (doc[1:] != doc[:-1])))
    first = np.flatnonzero(new)
    return np.stack([a[first], b[np.append(first[1:] - 1, len(b) - 1)]], 1)


def _places(runs: np.ndarray) -> np.ndarray:
    if not len(runs):
        return np.zeros(0, np.int64)
    sizes = runs[:, 1] - runs[:, 0]
    return np.arange(sizes.sum()) + np.repeat(runs[:, 0] - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes)


class Repeats:
    """Which ``length``-byte strings of staged chunks start at more than one place, by names of 96 bits or, if not ``strong``, 64."""

    def __init__(self, chunks: DataFrame, length: int, strong: bool = True):
        self.length, self.strong, self.buckets = length, strong, shuffle_partitions(chunks.sparkSession)
        self.period, self.cover = cover_for(length)
        self.short = length - self.period + 1
        self.seed = int.from_bytes(os.urandom(8), "little")  # drawn once, the same in every task and attempt
        body = chunks.select("chunk", "sizes", "body")
        answers = staged(_answer(body.mapInArrow(self._sample, _SENT), self.buckets, np.uint32), "suffix-cover-ties")
        hopeful = _answered(body, answers).where("bits IS NOT NULL")
        #: (chunk, runs, region): places that can be repeated, and their bytes
        self.regions = staged(hopeful.mapInArrow(self._regions, "chunk long, runs binary, region binary"), "suffix-regions")
        ranges = []
        for k in range(RANGES):
            sent = self.regions.mapInArrow(self._suffixes(k * self.buckets), _SENT)
            ranges.append(staged(_answer(sent, self.buckets, np.uint64), "suffix-repeats"))
        #: (chunk, part, bucket, bits)
        self.bits = reduce(DataFrame.union, ranges)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("regions", "bits")}

    def _cover_entries(self, data: np.ndarray, off: np.ndarray) -> Iterator[tuple[int, np.ndarray, Entries]]:
        for part, at in _in_parts(sample_places(off, self.short, self.period, self.cover)):
            yield part, at, Entries(names(self.seed)(data, at, self.short, False)[0], None)

    def _sample(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for chunk, sizes, body in zip(*[b.column(i).to_pylist() for i in range(3)]):
                for part, _, entries in self._cover_entries(*_unpack(body, sizes)):
                    yield _send(chunk, part, entries, self.buckets, 0, self.buckets, np.uint32)

    def _regions(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        zstd = zstandard.ZstdCompressor(level=3)
        for b in batches:
            for chunk, sizes, packed, bits in zip(*[b.column(i).to_pylist() for i in range(4)]):
                data, off = _unpack(packed, sizes)
                tied = [at[_read(bits, part, entries, self.buckets)] for part, at, entries in self._cover_entries(data, off)]
                runs = _tied_runs(data, off, np.concatenate(tied), self.period, self.length) if tied else np.zeros((0, 2), np.int64)
                if len(runs):
                    cut = [data[a:e + self.length - 1] for a, e in runs.tolist()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([chunk], pa.int64()), pa.array([runs.tobytes()], pa.binary()),
                         pa.array([zstd.compress(np.concatenate(cut).tobytes())], pa.binary())], names=["chunk", "runs", "region"])

    def _suffix_names(self, data: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray | None]]:
        for part, own in _in_parts(at):
            yield part, own, *names(self.seed)(data, own, self.length, self.strong)

    def _suffixes(self, low: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for chunk, raw, region in zip(*[b.column(i).to_pylist() for i in range(3)]):
                    runs = np.frombuffer(raw, np.int64).reshape(-1, 2)
                    sizes = runs[:, 1] - runs[:, 0]
                    data, _ = _unpack(region, (sizes + self.length - 1).tolist())
                    begin = np.arange(len(runs)) * (self.length - 1) + np.concatenate(([0], np.cumsum(sizes)[:-1]))
                    for part, _, long, short in self._suffix_names(data, _places(np.stack([begin, begin + sizes], 1))):
                        bucket = dealt(long, RANGES * self.buckets)
                        own = (bucket >= low) & (bucket < low + self.buckets)
                        short = None if short is None else short[own]
                        yield _send(chunk, part, Entries(long[own], short), RANGES * self.buckets, low, low + self.buckets, np.uint64)
        return run

    def attached(self, chunks: DataFrame, name: str) -> DataFrame:
        """chunks with the answers of their places (``<name>_bits``, ``<name>_runs``)."""
        runs = self.regions.select(F.col("chunk").alias("of"), F.col("runs").alias(f"{name}_runs"))
        got = _answered(chunks, self.bits).withColumnRenamed("bits", f"{name}_bits")
        return got.join(runs, F.col("chunk") == F.col("of"), "left").drop("of")

    def covered(self, data: np.ndarray, bits: list | None, raw: bytes | None) -> np.ndarray:
        """Which bytes of a chunk a repeated string covers."""
        if not bits:
            return np.zeros(len(data), bool)
        depth = np.zeros(len(data) + 1, np.int32)
        for part, at, long, short in self._suffix_names(data, _places(np.frombuffer(raw, np.int64).reshape(-1, 2))):
            starts = at[_read(bits, part, Entries(long, short), RANGES * self.buckets)]
            depth[starts] += 1
            depth[starts + self.length] -= 1
        return np.cumsum(depth[:-1]) > 0


def _by_text(marked: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marked bytes and maximal marked runs of each text."""
    begins = marked & ~np.concatenate(([False], marked[:-1]))
    inner = off[(off > 0) & (off < len(marked))]
    begins[inner] = marked[inner]
    bytes_, runs = np.concatenate(([0], np.cumsum(marked))), np.concatenate(([0], np.cumsum(begins)))
    return bytes_[off[1:]] - bytes_[off[:-1]], runs[off[1:]] - runs[off[:-1]]


def deduplicate(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400, passage: int | None = None) -> DataFrame:
    """Per row: the id, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs) and ``kept`` (the remaining bytes).

    With ``passage`` also ``n_passage`` and ``n_passages``: the bytes that ``passage``-byte strings cover which start
    elsewhere too (by 64-bit names), and their maximal runs. They are reported, not removed: passages shorter than
    ``length`` repeat as well.
    """
    chunks = pack(df, id_col, text_col)
    wanted = [("cut", Repeats(chunks, length))] + ([("seen", Repeats(chunks, passage, strong=False))] if passage else [])
    marked = chunks
    for name, r in wanted:
        marked = r.attached(marked, name)
    marked = marked.select("ids", "sizes", "body", *[f"{n}_{x}" for n, _ in wanted for x in ("bits", "runs")])
    more = "n_bytes long, n_removed long, n_spans long, kept binary" + (", n_passage long, n_passages long" if passage else "")
    out = T.StructType([df.schema[id_col], *T._parse_datatype_string(more).fields])
    finders = [r for _, r in wanted]

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kind = b.column(0).type.value_type
            for row in zip(*[c.to_pylist() for c in b.columns]):
                data, off = _unpack(row[2], row[1])
                found = [f.covered(data, row[3 + 2 * k], row[4 + 2 * k]) for k, f in enumerate(finders)]
                removed, spans = _by_text(found[0], off)
                kept = data[~found[0]]
                n = np.diff(off)
                ends = np.concatenate(([0], np.cumsum(n - removed)))
                seen = [pa.array(x) for x in _by_text(found[1], off)] if passage else []
                texts_kept = pa.Array.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(kept.tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row[0], kind), pa.array(n), pa.array(removed), pa.array(spans), texts_kept.cast(pa.binary()), *seen], names=out.names)

    return marked.mapInArrow(remove, out)
