"""Token-id files: one sorted stream of ids, entropy coded with a static range asymmetric numeral system.

Writing. Rows are dealt by ranges of the id and sorted in each; every text is
encoded by the tokenizers library (through a bounded memo of its pre-tokens),
``end_id`` is appended, and whole documents are packed into blocks of about
``BLOCK_TOKENS`` ids, which are staged. One frequency table over all ids is
shared by all blocks. Each block is coded by itself: ``lanes`` states take
turns over its ids and share one stream of 32-bit words.

File format. ``<path>/table``: Parquet rows (id, frequency, occurrences), the
frequencies sum to 2^bits. ``<path>/blocks/part=<k>``: Parquet rows (start,
n_tokens, ids, sizes, block): the place of the block's first id in the whole
stream, its documents and their numbers of ids; rows and parts in ascending
order of ``start`` are in ascending order of the document id. ``block`` is
little-endian: the magic ``TRNS``, a version, bits, lanes, steps a checkpoint,
numbers of ids, words and checkpoints; per checkpoint the place in the words,
the CRC-32 of the ids (unsigned 32-bit) up to the next checkpoint and all lanes'
states; the words; the CRC-32 of all before.

Reading. Blocks are independent; inside a block every checkpoint is an entry,
so that all its stretches are decoded side by side and :func:`decode` can give
any range of ids. Checksums, words used up and final states are verified;
damage raises ``ValueError``.

A null text is the empty text (the end id alone). A null id comes first; rows
with one id follow each other by their text's hash, so repeated rows are
repeated documents. A document longer than a block is a block of its own. An
empty table gives a table and blocks without rows.
"""

from __future__ import annotations

import gc
import os
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventflow.llm.common import col, shuffle_partitions, staged, steps, texts

BLOCK_TOKENS = 1 << 20
LANES, STEPS = 1024, 256
#: bits of the frequency table's sum
BITS = 20
#: pre-tokens, and words between blanks, that a worker remembers
MEMO_WORDS = 300_000
#: letters of a text that are split at once, bytes of texts that are looked up together
SLICE, STEP = 1 << 20, 1 << 21

_HEAD = struct.Struct("<4sHBxIIQQI")
_MAGIC, _VERSION = b"TRNS", 1
_LOW = np.uint64(1 << 31)

# fixed values: the pre-token pattern of byte-level vocabularies, and scripts whose characters all Unicode versions class alike
PRE_TOKEN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SETTLED = ("\\u0000-\\u052f\\u1e00-\\u206f\\u20a0-\\u20bf\\u2100-\\u23ff\\u2500-\\u27ff\\u3000-\\u30ff\\u4e00-\\u9fa5\\uac00-\\ud7a3\\uff00-\\uffef"
           "\\U0001f300-\\U0001f5ff")
#: the same without white space other than blanks and line ends
SIMPLE = ("\\u0000-\\u0008\\n\\u000e-\\u001b\\u0020-\\u0084\\u0086-\\u009f\\u00a1-\\u052f\\u1e00-\\u1fff\\u200b-\\u2027\\u202a-\\u202e\\u2030-\\u205e"
          "\\u2060-\\u206f\\u20a0-\\u20bf\\u2100-\\u23ff\\u2500-\\u27ff\\u3001-\\u30ff\\u4e00-\\u9fa5\\uac00-\\ud7a3\\uff00-\\uffef"
          "\\U0001f300-\\U0001f5ff")


class Memo(dict):
    """Values of a function, at most ``limit`` at a time."""

    def __init__(self, of, limit: int):
        super().__init__()
        self.of, self.limit = of, limit

    def __missing__(self, key: str) -> bytes:
        if len(self) >= self.limit:
            self.clear()
        got = self[key] = self.of(key)
        return got


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: itself if it is visible, else one from 256 on."""
    seen = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [x for x in range(256) if x not in seen]
    return [chr(x) if x in seen else chr(256 + hidden.index(x)) for x in range(256)]


def _spelt(words: pa.Array) -> list[str]:
    """The strings of a large_string array none of which holds a blank: one text, split at blanks."""
    off = np.frombuffer(words.buffers()[1], np.int64)[:len(words) + 1]
    joined = np.full(off[-1] + len(words), 32, np.uint8)
    joined[np.arange(off[-1]) + np.repeat(np.arange(len(words)), np.diff(off))] = np.frombuffer(words.buffers()[2], np.uint8)[:off[-1]]
    return joined.tobytes().decode()[:-1].split(" ")


class Encoder:
    """Ids of texts (as little-endian 32-bit bytes), exactly the library's, from memos.

    Pre-tokens are merged by the library's model. A blank or line end between
    two visible characters always has a pre-token boundary in front of it, so
    texts without other white space are looked up by what stands between them,
    and only what is new there is split into pre-tokens.
    """

    def __init__(self, model: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import json

        import regex
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(model)
        spec = json.loads(self.library.to_str())
        pre = spec.get("pre_tokenizer") or {}
        # the memos hold for plain byte-level vocabularies; any other is left to the library
        self.plain = (spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
                      and not pre.get("add_prefix_space") and spec.get("truncation") is None)
        self.special = [t["content"] for t in spec.get("added_tokens") or []]
        self.merge = self.library.model.tokenize
        self.letters = dict(enumerate(byte_letters()))
        self.split = regex.compile(PRE_TOKEN).findall
        self.settled = regex.compile(f"[{SETTLED}]*").fullmatch
        self.simple = regex.compile(f"[{SIMPLE}]*").fullmatch
        self.gap = regex.compile(r"(?<=\S) (?=\S)").search
        self.pieces = Memo(self._piece, MEMO_WORDS)
        self.first = Memo(lambda w: self._piece(w) if w.isalpha() else self._split(w), MEMO_WORDS)
        self.later = Memo(self._behind_blank, MEMO_WORDS * 3)

    def size(self) -> int:
        return self.library.get_vocab_size(with_added_tokens=True)

    def _whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _piece(self, piece: str) -> bytes:
        if piece.isascii() and piece.isprintable():
            got = self.merge(piece.replace(" ", self.letters[32]))
        else:
            got = self.merge(piece.encode().decode("latin-1").translate(self.letters))
        return struct.pack(f"<{len(got)}I", *[t.id for t in got])

    def _split(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.split(text)))

    def _behind_blank(self, word: str) -> bytes:
        """The ids of a blank and what follows it up to the next."""
        if word.isalpha():
            return self._piece(" " + word)
        if word[0] == "\n":
            return self.pieces["\n"] + self.first[word[1:]]
        if word[-1] in ".,;:!?" and word[:-1].isalpha():
            return self.later[word[:-1]] + self.pieces[word[-1]]
        return self._split(" " + word)

    def _slices(self, text: str) -> Iterator[str]:
        """Parts of a long text, cut in front of single blanks, where a pre-token always begins."""
        a = 0
        while len(text) - a > SLICE:
            m = self.gap(text, a + SLICE)
            if not m:
                break
            yield text[a:m.start()]
            a = m.start()
        yield text[a:]

    def _lines(self, text: str) -> bytes:
        # a word that begins a line keeps its line end in front of it, where others have had a blank
        words = text.replace("\n", " \n").split(" ")
        begin = self.first[words[0]] if words[0] else b""
        return begin + b"".join(map(self.later.__getitem__, words[1:]))

    def _easy(self, text: str) -> bool:
        """Whether single blanks and line ends between visible characters are its only white space."""
        return bool(self.plain and not any(s in text for s in self.special) and self.simple(text)
                    and not ("  " in text or "\n\n" in text or " \n" in text or "\n " in text)
                    and text[:1] not in " \n" and text[-1:] not in " \n")

    def many(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of many texts: what stands between blanks is looked up once for all of them."""
        easy = [i for i, t in enumerate(texts) if 0 < len(t) <= SLICE and self._easy(t)]
        out: list = [None] * len(texts)
        for i in set(range(len(texts))).difference(easy):
            out[i] = np.frombuffer(self(texts[i]), "<u4")
        if not easy:
            return out
        raw = [texts[i].encode() for i in easy]
        data = np.frombuffer(b"".join(raw), np.uint8)
        ends_of = np.cumsum([len(r) for r in raw])
        begins_of = np.concatenate(([0], ends_of[:-1]))
        blank, line = np.flatnonzero(data == 32), np.flatnonzero(data == 10)
        # a line end stays in front of its word, a blank is dropped
        starts = np.sort(np.concatenate((begins_of, blank + 1, line)))
        sizes = np.sort(np.concatenate((ends_of, blank, line))) - starts
        off = np.concatenate(([0], np.cumsum(sizes)))
        words = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(off.astype(np.int64)), pa.py_buffer(data[data != 32].tobytes())])
        coded = words.dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        distinct, opening = _spelt(coded.dictionary), np.searchsorted(starts, begins_of)
        lead = [distinct[c] for c in codes[opening].tolist()]
        used = np.ones(len(codes), bool)
        used[opening] = False
        seen = np.zeros(len(distinct), bool)
        seen[codes[used]] = True
        values = [self.later[w] if s else b"" for w, s in zip(distinct, seen.tolist())] + [self.first[w] for w in lead]
        codes[opening] = len(distinct) + np.arange(len(lead))  # no blank in front of a text's first word
        n = np.fromiter(map(len, values), np.int64, len(values)) >> 2
        place, flat = np.concatenate(([0], np.cumsum(n)[:-1])), np.frombuffer(b"".join(values), "<u4")
        count = n[codes]
        behind = np.cumsum(count)
        ids = flat[np.repeat(place[codes] - behind + count, count) + np.arange(behind[-1])]
        cut = np.append(behind[opening] - count[opening], behind[-1])
        for k, i in enumerate(easy):
            out[i] = ids[cut[k]:cut[k + 1]]
        return out

    def __call__(self, text: str) -> bytes:
        if not self.plain or any(s in text for s in self.special):
            return self._whole(text)
        if self._easy(text):
            return b"".join([self._lines(part) for part in self._slices(text)])
        if not self.settled(text):
            return self._whole(text)
        return b"".join([self._split(part) for part in self._slices(text)])


@lru_cache(maxsize=1)
def encoder(model: str) -> Encoder:
    return Encoder(model)


class Table:
    """Frequencies of ids that sum to 2^bits, and what coding needs of them."""

    def __init__(self, freq: np.ndarray, bits: int):
        self.bits, self.freq = bits, freq.astype(np.uint64)
        self.cum = np.concatenate(([0], np.cumsum(self.freq)))[:-1].astype(np.uint64)
        self.filler = int(np.argmax(self.freq)) if len(freq) else 0

    @staticmethod
    def scaled(counts: np.ndarray, bits: int) -> np.ndarray:
        """Frequencies in proportion to counts: at least 1 for every id that occurs, 2^bits in all."""
        total, whole = int(counts.sum()), 1 << bits
        if not total:
            return np.zeros(len(counts), np.int64)
        if np.count_nonzero(counts) > whole:
            raise ValueError("more ids than frequencies")
        freq = np.array([max(1, c * whole // total) if c else 0 for c in counts.tolist()], np.int64)
        short = whole - int(freq.sum())
        for k in np.argsort(-freq, kind="stable").tolist():  # the commonest ids give or take the rest
            step = short if short > 0 else -min(-short, int(freq[k]) // 2)
            freq[k] += step
            short -= step
            if not short:
                break
        while short:  # many rare ids: whatever has room gives one
            room = np.flatnonzero(freq > 1)[:-short]
            freq[room] -= 1
            short += len(room)
        return freq

    def slots(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.freq), dtype=np.uint32), self.freq.astype(np.int64))


def encode(ids: np.ndarray, table: Table) -> bytes:
    """One block of at least one id."""
    n = len(ids)
    lanes = 1
    while lanes < LANES and n >= lanes * 64:
        lanes *= 2
    rows = -(-n // lanes)
    padded = np.full(rows * lanes, table.filler, np.int64)
    padded[:n] = ids
    freq, cum = table.freq[padded].reshape(rows, lanes), table.cum[padded].reshape(rows, lanes)
    if not freq.all():
        raise ValueError("an id has no frequency")
    bits, half = np.uint64(table.bits), np.uint64(32)
    full = freq << np.uint64(63 - table.bits)
    x = np.full(lanes, _LOW, np.uint64)
    words, written, marks = [], 0, []
    for t in range(rows - 1, -1, -1):
        f = freq[t]
        big = x >= full[t]
        out = x[big].astype(np.uint32)
        if len(out):
            words.append(out)
            written += len(out)
            x = np.where(big, x >> half, x)
        q = x // f
        x = (q << bits) + (x - q * f) + cum[t]
        if t % STEPS == 0:
            marks.append((written, x))
    marks.reverse()
    places = np.array([written - w for w, _ in marks], "<u8")  # words in front of a checkpoint's step
    crcs = np.array([zlib.crc32(ids[k * STEPS * lanes:(k + 1) * STEPS * lanes].astype("<u4").tobytes()) for k in range(len(marks))], "<u4")
    states = np.concatenate([s for _, s in marks]).astype("<u8")
    body = b"".join([_HEAD.pack(_MAGIC, _VERSION, table.bits, lanes, STEPS, n, written, len(marks)), places.tobytes(), crcs.tobytes(),
                     states.tobytes(), np.concatenate(words[::-1]).astype("<u4").tobytes() if words else b""])
    return body + struct.pack("<I", zlib.crc32(body))


def decode(block: bytes, table: Table, slots: np.ndarray, first: int = 0, last: int | None = None) -> np.ndarray:
    """The ids first .. last of a block (all of it by default), from the checkpoints around them."""
    if len(block) < _HEAD.size + 4 or zlib.crc32(block[:-4]) != struct.unpack("<I", block[-4:])[0]:
        raise ValueError("damaged block")
    magic, version, bits, lanes, step, n, n_words, n_marks = _HEAD.unpack_from(block)
    if magic != _MAGIC or version != _VERSION or bits != table.bits:
        raise ValueError("not a block of this table")
    at = _HEAD.size
    places = np.frombuffer(block, "<u8", n_marks, at).astype(np.int64)
    crcs = np.frombuffer(block, "<u4", n_marks, at + 8 * n_marks)
    states = np.frombuffer(block, "<u8", n_marks * lanes, at + 12 * n_marks).reshape(n_marks, lanes)
    words = np.frombuffer(block, "<u4", n_words, at + 12 * n_marks + 8 * n_marks * lanes)
    words = np.append(words, np.zeros(1, np.uint32)).astype(np.uint64)
    last = n if last is None else min(last, n)
    first = max(first, 0)
    if first >= last:
        return np.zeros(0, np.uint32)
    a, b = first // (step * lanes), -(-last // (step * lanes))
    rows = -(-n // lanes)
    x, ptr = states[a:b].astype(np.uint64), places[a:b].copy()
    sizes = np.minimum(step, rows - np.arange(a, b) * step)
    out = np.zeros((b - a, step, lanes), np.uint32)
    bits, mask, half = np.uint64(table.bits), np.uint64((1 << table.bits) - 1), np.uint64(32)
    for t in range(int(sizes[0])):
        live = len(sizes) if t < sizes[-1] else len(sizes) - 1  # the last stretch may be shorter
        y = x[:live]
        slot = y & mask
        got = slots[slot.astype(np.int64)]
        out[:live, t] = got
        y = table.freq[got] * (y >> bits) + slot - table.cum[got]
        need = y < _LOW
        behind = np.cumsum(need, axis=1)
        take = np.minimum(ptr[:live, None] + behind - 1, len(words) - 1)
        x[:live] = np.where(need, (y << half) | words[take], y)
        ptr[:live] += behind[:, -1]
    ends = np.append(places, n_words)[a + 1:b + 1]
    if (ptr != ends).any() or (b == n_marks and (x[-1] != _LOW).any()) or (x[:-1] != states[a + 1:b]).any():
        raise ValueError("damaged block")
    ids = out.reshape(-1)[:n - a * step * lanes]
    for k in range(a, b):
        if zlib.crc32(ids[(k - a) * step * lanes:(k - a + 1) * step * lanes].astype("<u4").tobytes()) != crcs[k]:
            raise ValueError("damaged ids")
    return ids[first - a * step * lanes:last - a * step * lanes]


def packed(df: DataFrame, model: str, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """(place, before, n_tokens, ids, sizes, body): documents in ascending order of the id, packed into blocks, staged.

    ``place`` is the range's number (high bits) and the row's in it, ``before`` the ids of the range in front of the block.
    """
    src = texts(df, id_col, text_col)
    src = src.select(col(src, id_col).alias("id"), col(src, text_col).alias("text"))
    # rows of one id are told apart, so that an id that many rows hold is more than one range
    keyed = src.withColumn("_k", F.xxhash64("text")).withColumn("_in", F.monotonically_increasing_id())
    order = ["id", "_k", "_in"]
    ranged = keyed.repartitionByRange(shuffle_partitions(df.sparkSession), *order).sortWithinPartitions(*order).select("id", "text")
    out = T.StructType([*T._parse_datatype_string("before long, n_tokens long").fields,
                        T.StructField("ids", T.ArrayType(src.schema["id"].dataType)),
                        *T._parse_datatype_string("sizes array<long>, body binary").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        zstd, code = zstandard.ZstdCompressor(level=1), encoder(model)
        end, kind = np.array([end_id], "<u4"), np.uint16 if max(code.size(), end_id + 1) <= 1 << 16 else np.uint32
        ids, sizes, parts, total, before, arrow = [], [], [], 0, 0, None

        def block():
            body = zstd.compress(np.concatenate(parts).astype(kind).tobytes())
            return pa.RecordBatch.from_arrays(
                [pa.array([before], pa.int64()), pa.array([total], pa.int64()), pa.array([ids], pa.list_(arrow)),
                 pa.array([sizes], pa.list_(pa.int64())), pa.array([body], pa.binary())], names=out.names)

        gc.disable()  # nothing here makes cycles, and the collector would walk the memos again and again
        for b in steps(batches, 1, STEP):
            arrow = b.column(0).type
            for i, got in zip(b.column(0).to_pylist(), code.many(b.column(1).to_pylist())):
                if ids and total + len(got) + 1 > BLOCK_TOKENS:
                    yield block()
                    before += total
                    ids, sizes, parts, total = [], [], [], 0
                ids.append(i)
                sizes.append(len(got) + 1)
                parts += [got, end]
                total += len(got) + 1
        gc.enable()
        if ids:
            yield block()

    return staged(ranged.mapInArrow(run, out).withColumn("place", F.monotonically_increasing_id()), "token-blocks")


def _unpacked(body: bytes, n: int) -> np.ndarray:
    import zstandard
    raw = zstandard.ZstdDecompressor().decompress(body, max_output_size=4 * n)
    return np.frombuffer(raw, np.uint16 if len(raw) == 2 * n else np.uint32)


def occurrences(blocks: DataFrame) -> DataFrame:
    """(id, n): how often each id occurs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for b in batches:
            for n, body in zip(b.column(0).to_pylist(), b.column(1)):
                got = np.bincount(_unpacked(body.as_py(), n))
                if len(got) > len(total):
                    total = np.append(total, np.zeros(len(got) - len(total), np.int64))
                total[:len(got)] += got
        which = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(which, pa.int64()), pa.array(total[which], pa.int64())], names=["id", "n"])

    rows = blocks.select("n_tokens", "body").mapInArrow(run, "id long, n long")
    return rows.groupBy("id").agg(F.sum("n").alias("n"))


def write(df: DataFrame, path: str, model: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the rows' ids as token files under ``path``.

    Only the frequency table (a row an id of the vocabulary) and one number a range pass through the driver.
    """
    spark = df.sparkSession
    blocks = packed(df, model, end_id, id_col, text_col)
    counted = sorted((r["id"], r["n"]) for r in occurrences(blocks).collect())
    counts = np.zeros(counted[-1][0] + 1 if counted else 0, np.int64)
    for i, n in counted:
        counts[i] = n
    bits = max(BITS, int(len(counts)).bit_length() + 2)
    freq = Table.scaled(counts, bits)
    spark.createDataFrame([(i, int(freq[i]), n) for i, n in counted], "id long, frequency long, occurrences long").coalesce(1).write.parquet(f"{path}/table")
    part = F.shiftright("place", 33)
    sizes = sorted((r["part"], r["n"]) for r in blocks.groupBy(part.alias("part")).agg(F.sum("n_tokens").alias("n")).collect())
    starts = np.cumsum([0, *[n for _, n in sizes]]).tolist()
    begins = spark.createDataFrame([(p, a) for (p, _), a in zip(sizes, starts)], "part long, begin long")  # a row a range
    placed = blocks.withColumn("part", part).join(F.broadcast(begins), "part").select(
        (F.col("begin") + F.col("before")).alias("start"), "n_tokens", "ids", "sizes", "body", "part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table(freq, bits)
        for b in batches:
            at = b.schema.get_field_index("body")
            for k in range(b.num_rows):
                row = b.slice(k, 1)
                block = encode(_unpacked(row.column(at)[0].as_py(), row.column(1)[0].as_py()).astype(np.int64), table)
                cols = [pa.array([block], pa.binary()) if c == at else row.column(c) for c in range(b.num_columns)]
                yield pa.RecordBatch.from_arrays(cols, names=[x if x != "body" else "block" for x in b.schema.names])

    schema = T.StructType([T.StructField("block", T.BinaryType()) if f.name == "body" else f for f in placed.schema.fields])
    placed.mapInArrow(run, schema).write.partitionBy("part").parquet(f"{path}/blocks")


def read_table(spark: SparkSession, path: str) -> Table:
    rows = sorted((r["id"], r["frequency"]) for r in spark.read.parquet(f"{path}/table").collect())
    freq = np.zeros(rows[-1][0] + 1 if rows else 0, np.int64)
    for i, f in rows:
        freq[i] = f
    return Table(freq, max(int(freq.sum()).bit_length() - 1, 0))


def read(spark: SparkSession, path: str, id_type: T.DataType | None = None, tokens: bool = True) -> DataFrame:
    """One row a document: id, start (ids in front of it), n_tokens, ids_crc32 and, unless ``tokens`` is false, its ids (little-endian 32-bit).

    ``id_type`` is the type of the ids, a long by default.
    """
    table = read_table(spark, path)
    freq, bits = table.freq, table.bits
    kind = id_type or T.LongType()
    stored = T.StructType([*T._parse_datatype_string("start long, n_tokens long").fields, T.StructField("ids", T.ArrayType(kind)),
                           *T._parse_datatype_string("sizes array<long>, block binary, part long").fields])
    blocks = spark.read.schema(stored).parquet(f"{path}/blocks").select("start", "ids", "sizes", "block")
    out = T.StructType([T.StructField("id", kind), *T._parse_datatype_string("start long, n_tokens long, ids_crc32 long").fields,
                        *(T._parse_datatype_string("tokens binary").fields if tokens else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Table(freq, bits)
        slots = own.slots()
        for b in batches:
            for k in range(b.num_rows):
                sizes = np.array(b.column(2)[k].as_py(), np.int64)
                ids = decode(b.column(3)[k].as_py(), own, slots).astype("<u4")
                at = np.concatenate(([0], np.cumsum(sizes)))
                if at[-1] != len(ids):
                    raise ValueError("damaged block")
                own_ids = [ids[x:y].tobytes() for x, y in zip(at[:-1].tolist(), at[1:].tolist())]
                cols = [b.column(1)[k].values, pa.array(at[:-1] + b.column(0)[k].as_py()), pa.array(sizes),
                        pa.array([zlib.crc32(x) for x in own_ids], pa.int64())]
                if tokens:
                    cols.append(pa.array(own_ids, pa.binary()))
                yield pa.RecordBatch.from_arrays(cols, names=out.names)

    return blocks.mapInArrow(run, out)
