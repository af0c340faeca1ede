"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

A text is normalised as the model says (identity normalisation, spaces
written as U+2581, one put in front), cut into segments that no vocabulary
piece spans, and each segment is merged with a score-ordered agenda of its
adjacent symbol pairs: the best-scored pair is joined first, the leftmost of
equals, until no adjacent pair forms a piece. The agendas of a batch's new
short segments are rows of arrays (each round joins every row's best pair); a
long segment gets a heap of its own. Every segment that enters a worker's
bounded memo is encoded and decoded by the sentencepiece library too, many in
one text; a difference raises. A memo has a younger and an older half: when the
younger is full the older goes, and what is asked for again moves up, so that
frequent segments are not encoded anew. Every text is decoded by the library
from its own ids.

Nulls encode like the empty text (no ids, empty decoded text). Repeated rows
give repeated results. Texts of any length are encoded whole: an agenda holds
one segment, not one text.
"""

from __future__ import annotations

import gc
import re
import sys
from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventflow.llm.common import steps, texts, with_fields

SPACE = "▁"
#: segments, and words made of them, a Python worker remembers
MEMO_SEGMENTS, MEMO_WORDS = 500_000, 200_000
#: bytes of text that are cut and encoded at once
TEXT_BYTES = 2 << 20
#: segments of up to so many signs share arrays of agendas, so many an array
SHORT, ROWS = 24, 1 << 13
#: segments that the library encodes as one text
CHECKED = 32
_NONE = np.int32(2 ** 31 - 1)
_LEFT = 40  # bits of an agenda key that hold the left symbol's place
#: U+2581s with the letters or the other signs behind them; or U+2581s at the end
_BY_KIND = re.compile(f"{SPACE}*(?:[^\\W\\d_]+|(?:[^\\w{SPACE}]|[\\d_])+)|{SPACE}+")
_BY_SPACE = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


def _ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (count[0] numbers), then the same from start[1] on, ..."""
    return np.repeat(start - np.cumsum(count) + count, count) + np.arange(int(count.sum()))


class Memo:
    """A bounded dict in two halves: when the younger is full it becomes the older one, which goes.

    Holds what one call asks for, even if that alone is beyond the limit.
    """

    def __init__(self):
        self.young: dict[str, str] = {}
        self.old: dict[str, str] = {}

    def missing(self, wanted: set[str], limit: int) -> set[str]:
        """Those of ``wanted`` that are to be put into ``young``; the others are there."""
        new = wanted.difference(self.young)
        if len(self.young) + len(new) > limit // 2:
            self.young, self.old, new = {}, self.young if self.young else self.old, wanted
        known = self.old.keys() & new
        for k in known:
            self.young[k] = self.old[k]
        if len(self.old) + len(self.young) + len(new) - len(known) > limit:
            self.old = {}
        return new - known

    def __len__(self) -> int:
        return len(self.young) + len(self.old)


class MergeVocabulary:
    """Pieces, scores and byte ids of one model file, with a memo of encoded segments."""

    def __init__(self, model_file: str):
        import sentencepiece
        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        n = sp.get_piece_size()
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) for i in range(n)]
        if any(sp.is_unused(i) for i in range(n)):
            raise ValueError("vocabularies with unused pieces are not supported")
        probe = "  a\tﬁ  \u00a0１ "
        if sp.decode(sp.encode(probe)) != probe or sp.encode("", out_type=str) or sp.encode(" ", out_type=str) == [SPACE]:
            raise ValueError("only identity normalisation with a dummy prefix is supported")
        self.ids = {sp.id_to_piece(i): i for i in range(n) if not special[i]}
        self.byte_ids = {int(sp.id_to_piece(i)[1:-1], 16): i for i in range(n) if sp.is_byte(i)}
        if len(self.byte_ids) != 256:
            raise ValueError("the vocabulary has no byte fallback")
        order = sorted({sp.get_score(i) for i in self.ids.values()}, reverse=True)
        place = {s: k for k, s in enumerate(order)}
        self.rank = {p: place[sp.get_score(i)] for p, i in self.ids.items()}
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("a piece holds a space behind another sign")
        self.cut = (_BY_KIND if all(_BY_KIND.fullmatch(p) for p in self.ids) else _BY_SPACE).findall
        self.by_segment, self.by_word = Memo(), Memo()
        self.id_bytes = {i: p.replace(SPACE, " ").encode() for p, i in self.ids.items()}
        self.id_bytes.update((i, bytes([b])) for b, i in self.byte_ids.items())
        self.id_size = np.array([len(self.id_bytes.get(i, b"")) for i in range(n)], np.int64)
        self.id_text = [f"{i}," for i in range(n)]
        self.text_size = np.array([len(t) for t in self.id_text], np.int64)
        self.of_byte = np.array([self.byte_ids[b] for b in range(256)], np.int32)
        # the id of each sign; -2 - its code point if it is none
        self.of_sign = -2 - np.arange(sys.maxunicode + 1, dtype=np.int32)
        for p, i in self.ids.items():
            if len(p) == 1:
                self.of_sign[ord(p)] = i
        # every way to write a piece as two pieces: the pairs an agenda can hold
        pairs = [(self.ids[p[:k]] * n + self.ids[p[k:]], i) for p, i in self.ids.items()
                 for k in range(1, len(p)) if p[:k] in self.ids and p[k:] in self.ids]
        pairs.sort()
        self.pair_key = np.array([k for k, _ in pairs] + [2 ** 62], np.int64)
        self.pair_id = np.array([i for _, i in pairs] + [0], np.int32)
        self.pair_rank = np.array([self.rank[sp.id_to_piece(i)] for _, i in pairs] + [_NONE], np.int32)
        # slots of a hash table over the pairs, so that most looks are one gather
        bits = 21
        self.shift = np.uint64(64 - bits)
        self.slots = np.full(1 << bits, len(pairs), np.int32)
        at = self._slot(self.pair_key[:-1])
        self.slots[at] = np.arange(len(pairs), dtype=np.int32)
        self.crowded = np.zeros(1 << bits, bool)
        self.crowded[at[self.slots[at] != np.arange(len(pairs))]] = True
        self.size = n

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Places in pair_rank of the pairs (left, right); the last place for those that form no piece."""
        key = left.astype(np.int64) * self.size + right
        key[(left < 0) | (right < 0)] = -1
        slot = self._slot(key)
        at = self.slots[slot]
        wrong = self.pair_key[at] != key
        look = wrong & self.crowded[slot]
        at[wrong] = len(self.pair_key) - 1
        if look.any():
            k = np.searchsorted(self.pair_key, key[look])
            at[look] = np.where(self.pair_key[k] == key[look], k, len(self.pair_key) - 1)
        return at

    def merge_rows(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of short segments one after the other, and how many each has; a sign outside the vocabulary stands as -2 - its code point."""
        size = np.fromiter(map(len, segments), np.int64, len(segments))
        ids = self.of_sign[np.frombuffer("".join(segments).encode("utf-32-le"), np.uint32)]
        wide = int(size.max())
        sym = np.full((len(segments), wide), -1, np.int32)
        sym[np.arange(wide) < size[:, None]] = ids
        rows, ready = np.arange(len(segments)), []

        def done(which: np.ndarray) -> None:
            if which.any():
                got = sym[which]
                full = got != -1
                ready.append((rows[which], full.sum(1), got[full]))

        rank = self.pair_rank[self._pairs(sym[:, :-1].ravel(), sym[:, 1:].ravel())].reshape(len(sym), -1)
        while len(rows) and rank.shape[1]:
            best = rank.argmin(1)
            going = rank[np.arange(len(rows)), best] != _NONE
            done(~going)
            rows, sym, rank, best = rows[going], sym[going], rank[going], best[going]
            if not len(rows):
                break
            every = np.arange(len(rows))
            joined = self.pair_id[self._pairs(sym[every, best], sym[every, best + 1])]
            keep = np.ones(sym.shape, bool)
            keep[every, best + 1] = False
            sym = sym[keep].reshape(len(rows), -1)
            sym[every, best] = joined
            rank = rank[keep[:, 1:]].reshape(len(rows), -1)
            for left in (best - 1, best):
                ok = (left >= 0) & (left < rank.shape[1])
                r, k = every[ok], left[ok]
                rank[r, k] = self.pair_rank[self._pairs(sym[r, k], sym[r, k + 1])]
        done(np.ones(len(rows), bool))
        at, count, flat = (np.concatenate(x) for x in zip(*ready))
        order = np.argsort(at)
        start = (np.cumsum(count) - count)[order]
        count = count[order]
        return flat[_ranges(start, count)], count

    def merge_short(self, segments: list[str]) -> list[list[int]]:
        """Ids of short segments; a sign outside the vocabulary stands as -2 - its code point."""
        if not segments:
            return []
        flat, count = self.merge_rows(segments)
        end = np.cumsum(count)
        return [flat[b - n:b].tolist() for b, n in zip(end.tolist(), count.tolist())]

    def merge(self, segment: str) -> list[str]:
        """The symbols left when the agenda of one segment is empty."""
        rank, sym = self.rank.get, list(segment)
        n = len(sym)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = []
        for i in range(n - 1):
            r = rank(sym[i] + sym[i + 1])
            if r is not None:
                agenda.append(r << _LEFT | i)
        heapify(agenda)
        here = (1 << _LEFT) - 1
        while agenda:
            key = heappop(agenda)
            i = key & here
            j = after[i]
            if not sym[i] or j >= n:
                continue
            piece = sym[i] + sym[j]
            if rank(piece) != key >> _LEFT:  # one side has changed since
                continue
            sym[i], sym[j] = piece, ""
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                r = rank(piece + sym[k])
                if r is not None:
                    heappush(agenda, r << _LEFT | i)
            h = before[i]
            if h >= 0:
                r = rank(sym[h] + piece)
                if r is not None:
                    heappush(agenda, r << _LEFT | h)
        return [s for s in sym if s]

    def encode_segment(self, segment: str) -> list[int]:
        out = []
        for s in self.merge(segment):
            i = self.ids.get(s)
            if i is None:
                out += [self.byte_ids[b] for b in s.encode()]
            else:
                out.append(i)
        return out

    def decode_ids(self, ids: list[int]) -> str:
        """Pieces written out, runs of byte ids read as UTF-8."""
        return b"".join(map(self.id_bytes.__getitem__, ids)).decode("utf-8", "replace")

    def encode_segments(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of segments, at best in order of length, one after the other; and how many each has."""
        flats, counts = [], []
        sizes = np.fromiter(map(len, segments), np.int64, len(segments))
        a = 0
        while a < len(segments):
            if sizes[a] > SHORT:
                ids = self.encode_segment(segments[a])
                flats.append(np.array(ids, np.int32))
                counts.append(np.array([len(ids)]))
                a += 1
                continue
            long = np.flatnonzero(sizes[a:a + ROWS] > SHORT)
            b = a + int(long[0]) if len(long) else min(a + ROWS, len(segments))
            flat, count = self.merge_rows(segments[a:b])
            odd = np.flatnonzero(flat < 0)
            if len(odd):
                sign = -2 - flat[odd]
                times = np.ones(len(flat), np.int64)
                times[odd] = 1 + (sign >= 0x80) + (sign >= 0x800) + (sign >= 0x10000)
                count = np.add.reduceat(times, np.cumsum(count) - count)
                flat = np.repeat(flat, times)
                flat[flat < 0] = self.of_byte[np.frombuffer("".join(map(chr, sign.tolist())).encode(), np.uint8)]
            flats.append(flat)
            counts.append(count)
            a = b
        return np.concatenate(flats), np.concatenate(counts)

    def learn(self, segments: Iterable[str]) -> None:
        """Encode new segments, hold them against the library and remember them."""
        segments = sorted(segments, key=len)
        spaced = [s for s in segments if s[0] == SPACE]
        for own in (spaced, [s for s in segments if s[0] != SPACE]):
            if not own:
                continue
            flat, count = self.encode_segments(own)
            end = np.cumsum(count)
            self.check(own, flat, end - count, count, own is spaced)
            names = "".join(map(self.id_text.__getitem__, flat.tolist()))
            size = np.cumsum(self.text_size[flat])[end - 1].tolist()
            self.by_segment.young.update(zip(own, map(names.__getitem__, map(slice, [0, *size], size))))

    def check(self, own: list[str], flat: np.ndarray, start: np.ndarray, count: np.ndarray, spaced: bool) -> None:
        """Raise if the ids of any segment are not the library's, or do not decode to it."""
        text = "".join(own).replace(SPACE, " ")
        sign = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        last = np.cumsum(np.fromiter(map(len, own), np.int64, len(own))) - 1
        want = np.cumsum(1 + (sign >= 0x80) + (sign >= 0x800) + (sign >= 0x10000))[last]
        # the text in all, and where each segment ends in its bytes
        if self.decode_ids(flat.tolist()) != text or not np.array_equal(np.cumsum(self.id_size[flat])[start + count - 1], want):
            for s, a, n in zip(own, start.tolist(), count.tolist()):
                if self.decode_ids(flat[a:a + n].tolist()) != s.replace(SPACE, " "):
                    raise ValueError(f"{s!r} decodes to {self.decode_ids(flat[a:a + n].tolist())!r}")
        blank = np.fromiter((s[-1] == SPACE for s in own), bool, len(own))
        self.each([(s, a, n) for s, a, n, x in zip(own, start.tolist(), count.tolist(), blank.tolist()) if x], flat, spaced)
        if blank.all():
            return
        many = [s for s in own if s[-1] != SPACE] if blank.any() else own
        mine = flat[np.repeat(~blank, count)]
        # the library puts a space in front; a segment without one follows a sign no piece joins it to
        first = self.library.encode("\n")
        if spaced:
            asked = ["".join(many[a:a + CHECKED])[1:].replace(SPACE, " ") for a in range(0, len(many), CHECKED)]
            theirs = self.library.encode(asked, out_type="numpy", num_threads=1)
        else:
            asked = ["\n" + "\n".join(many[a:a + CHECKED]) for a in range(0, len(many), CHECKED)]
            theirs = [t[len(first) - 1:] for t in self.library.encode(asked, out_type="numpy", num_threads=1)]
            mine = np.insert(mine, start, first[-1])
        if not np.array_equal(np.concatenate(theirs), mine):
            self.each(list(zip(own, start.tolist(), count.tolist())), flat, spaced)
        # the library takes one leading space away
        flat = flat[np.repeat(np.array([s != SPACE for s in own]), count)]
        text = "".join([s for s in own if s != SPACE]).replace(SPACE, " ")
        if self.library.decode(flat) != (text[1:] if spaced else text):
            raise ValueError("decoding differs from the library")

    def each(self, own: list[tuple[str, int, int]], flat: np.ndarray, spaced: bool) -> None:
        """Raise if the ids of a segment (its place and number in ``flat``) are not those of the library for it alone."""
        first = [] if spaced else self.library.encode("\n")
        for s, a, n in own:
            if s == SPACE:  # what the library is asked for would be empty
                continue
            ids, theirs = flat[a:a + n].tolist(), self.library.encode(("" if spaced else "\n") + s[spaced:].replace(SPACE, " "))
            if first + ids != theirs:
                raise ValueError(f"the agenda and the library differ on {s!r}: {ids} and {theirs[len(first):]}")

    def encode_texts(self, many: list[str]) -> tuple[list[int], list[str], list[str]]:
        """Numbers of ids, ids joined by commas, and decoded texts."""
        plain, whole = [], []
        for t in many:
            # words that runs of spaces stick to are cut from the whole text
            odd = "  " in t or SPACE in t or t[:1] == " " or t[-1:] == " "
            (whole if odd else plain).append(self.cut(SPACE + t.replace(" ", SPACE)) if odd else t.split(" ") if t else [])
        new = list(self.by_word.missing(set(chain.from_iterable(plain)), MEMO_WORDS))
        cut = self.cut(SPACE + SPACE.join(new)) if new else []  # no segment goes on behind a space
        unknown = self.by_segment.missing(set(chain(cut, chain.from_iterable(whole))), MEMO_SEGMENTS)
        if unknown:
            self.learn(unknown)
        of, word = self.by_segment.young.__getitem__, self.by_word.young
        if new:
            got = list(map(of, cut))
            ends = np.cumsum(np.fromiter(map(len, cut), np.int64, len(cut)))
            last = np.searchsorted(ends, np.cumsum(np.fromiter(map(len, new), np.int64, len(new)) + 1))
            end = np.cumsum(np.fromiter(map(len, got), np.int64, len(got)))[last].tolist()
            word.update(zip(new, map("".join(got).__getitem__, map(slice, [0, *end], end))))
        counts, ids = [], []
        plain, whole = iter(plain), iter(whole)
        for t in many:
            odd = "  " in t or SPACE in t or t[:1] == " " or t[-1:] == " "
            got = "".join(map(of, next(whole)) if odd else map(word.__getitem__, next(plain)))
            counts.append(got.count(","))
            ids.append(got[:-1])
        return counts, ids, self.decode_texts(counts, ids)

    def decode_texts(self, counts: list[int], ids: list[str]) -> list[str]:
        """What the library decodes each text's ids (joined by commas, so many) to."""
        names = ",".join(filter(None, ids))
        flat = np.fromstring(names, np.int32, sep=",") if names else np.zeros(0, np.int32)
        end = np.cumsum(counts).tolist()
        return self.library.decode([flat[b - n:b] for b, n in zip(end, counts)], num_threads=1)


_LOADED: dict[str, MergeVocabulary] = {}


def vocabulary(model_file: str) -> MergeVocabulary:
    if model_file not in _LOADED:
        _LOADED[model_file] = MergeVocabulary(model_file)
    return _LOADED[model_file]


def encode_decode(df: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text",
                  carry: list[str] | None = None) -> DataFrame:
    """Per row: the id and ``carry`` columns, ``n_tokens``, ``ids`` (decimal ids joined by commas) and ``decoded``.

    ``model_file`` must exist on every executor. No shuffle; rows with equal
    texts give equal results; an empty table gives an empty table.
    """
    src = texts(df, id_col, text_col, carry)
    at = src.columns.index(text_col)
    out = with_fields(src, "n_tokens long, ids string, decoded string", (text_col,))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(model_file)
        gc.disable()  # nothing here makes cycles, and the collector would walk the memos again and again
        try:
            for b in steps(batches, at, TEXT_BYTES):
                counts, ids, decoded = vocab.encode_texts(b.column(at).to_pylist())
                kept = [b.column(i) for i in range(b.num_columns) if i != at]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(counts, pa.int64()), pa.array(ids, pa.string()),
                                                  pa.array(decoded, pa.string())], names=out.names)
        finally:
            gc.enable()

    return src.mapInArrow(run, out)


def id_array(ids):
    """The ``ids`` column as array<int>."""
    return F.when(ids == "", F.array().cast("array<int>")).otherwise(F.split(ids, ",").cast("array<int>"))
