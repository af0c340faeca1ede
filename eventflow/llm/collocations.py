"""Phrase collocations from a weighted de Bruijn graph of words.

Texts are lower-cased (A-Z), split into pieces at ``. , ; : ! ?`` and line
ends, and those into words at blanks and tabs. All counts are per language.

1. Texts are packed into chunks of bytes and staged (a text longer than a chunk
   is cut between pieces). In each chunk words get exact numbers, and phrases of
   one to three words are counted by those numbers.
2. Which phrases can reach ``min_count``: each chunk sends a 32-bit name and a
   count (cut at ``min_count``) of every distinct phrase to the phrase's bucket;
   answers are bit lists. Equal phrases have equal names, so no phrase that
   reaches it is missed; names that two phrases share only let more through.
3. Edges: every word occurrence counts for the longest phrase that starts there
   and can reach ``min_count``. Three words are an edge from its first pair to
   its last; a shorter phrase is a correction of its node: the piece ends
   there, or goes on with a rare word. Counts are summed by the phrases' text.
4. A node's flow, its edges out and its corrections, is the pair's count; the
   flows of all pairs of a first word and that word's corrections are the
   word's count.
5. Nodes with one edge in and one out are inside a unary path; paths are found
   by pointer doubling and kept as rows of at most ``STRETCH`` edges with each
   edge's weight and its node's correction. Edges of a ring of such nodes are
   paths of their own.
6. Candidates are read off paths (three words) and nodes (two words).

A hot phrase, line or language is one partial count a chunk; nothing is
broadcast by hint. A null text is empty, a null language ``und``. Repeated rows
count each. An empty table gives no rows. Sums are longs, products
decimal(38, 0): exact for counts below 10^16.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventflow.llm.common import col, only, shuffle_partitions, staged, steps, text_bytes
from eventflow.llm.wordhash import byte_values, mix, run_hashes

CHUNK_BYTES = 4 << 20
#: edges that a row of a path holds at most
STRETCH = 256
#: parts in which a language's candidates are cut to its first ones before they meet
PARTS = 32

_GAP = np.zeros(256, bool)
_GAP[[9, 32]] = True
_BREAK = np.zeros(256, bool)
_BREAK[np.frombuffer(b".,;:!?\x0a\x0b\x0c\x0d", np.uint8)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def between_pieces(data: np.ndarray, limit: int) -> list[tuple[int, int]]:
    """Cut one text into parts of about ``limit`` bytes behind piece ends; a longer piece stays whole."""
    if len(data) <= limit:
        return [(0, len(data))]
    ends = np.flatnonzero(_BREAK[data]) + 1
    out, a = [], 0
    while len(data) - a > limit:
        k = int(np.searchsorted(ends, a + limit, "right"))
        b = int(ends[k - 1]) if k and ends[k - 1] > a else int(ends[k]) if k < len(ends) else len(data)
        out.append((a, b))
        a = b
    return [*out, (a, len(data))] if a < len(data) else out


def chunks(df: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    """(chunk, langs, sizes, body): lower-cased texts packed into chunks of about CHUNK_BYTES, staged."""
    df = only(df, [lang_col, text_col])
    src = df.select(F.coalesce(col(df, lang_col).cast("string"), F.lit("und")).alias("lang"),
                    F.coalesce(col(df, text_col).cast("string"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        zstd = zstandard.ZstdCompressor(level=1)
        langs, sizes, parts, total = [], [], [], 0

        def chunk():
            return pa.RecordBatch.from_arrays(
                [pa.array([langs], pa.list_(pa.string())), pa.array([sizes], pa.list_(pa.int64())),
                 pa.array([zstd.compress(b"".join(parts))], pa.binary())], names=["langs", "sizes", "body"])

        for b in steps(batches, 1, CHUNK_BYTES):
            data, off = text_bytes(b.column(1))
            data = _LOWER[data]
            for lang, a, e in zip(b.column(0).to_pylist(), off[:-1].tolist(), off[1:].tolist()):
                for x, y in between_pieces(data[a:e], CHUNK_BYTES):
                    if parts and total + y - x > CHUNK_BYTES:
                        yield chunk()
                        langs, sizes, parts, total = [], [], [], 0
                    langs.append(lang)
                    sizes.append(y - x)
                    parts.append(data[a + x:a + y].tobytes())
                    total += y - x
        if parts:
            yield chunk()

    packed = src.mapInArrow(run, "langs array<string>, sizes array<long>, body binary")
    return staged(packed.withColumn("chunk", F.monotonically_increasing_id()), "phrase-chunks")


class Grams:
    """The phrases of one, two and three words of a chunk.

    ``codes[k]`` numbers the phrase of k + 1 words that starts at each of the
    places ``at[k]``; ``keys[k]`` has, per number, the number of the phrase
    without its last word (of the language, for one word) and the last word.
    """

    def __init__(self, langs: list[str], sizes: list[int], body: bytes):
        import zstandard
        raw = zstandard.ZstdDecompressor().decompress(body, max_output_size=max(1, sum(sizes)))
        data, off = np.frombuffer(raw, np.uint8), np.concatenate(([0], np.cumsum(np.array(sizes, np.int64))))
        word = ~(_GAP[data] | _BREAK[data])
        first = word.copy()
        first[1:] &= ~word[:-1]
        inner = off[(off > 0) & (off < len(data))]
        first[inner] = word[inner]  # a word ends with its text
        starts = np.flatnonzero(first)
        last = word.copy()
        last[:-1] &= ~word[1:] | first[1:]
        sizes_of = np.flatnonzero(last) + 1 - starts
        n = len(starts)
        text = np.searchsorted(off, starts, "right") - 1
        piece = np.cumsum(_BREAK[data], dtype=np.int64)[starts]
        go_on = np.zeros(n, bool)  # the next word is in the same piece
        go_on[:-1] = (piece[1:] == piece[:-1]) & (text[1:] == text[:-1])
        two = np.flatnonzero(go_on)
        three = two[go_on[np.minimum(two + 1, max(n - 1, 0))]] if n else two
        self.at = [np.arange(n), two, three]

        ends = np.concatenate(([0], np.cumsum(sizes_of)))
        words = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data[word].tobytes())])
        coded = words.dictionary_encode()
        self.words = coded.dictionary
        number = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.size = max(1, len(self.words))
        self.langs = list(dict.fromkeys(langs))
        spoken = {x: k for k, x in enumerate(self.langs)}
        lang = np.array([spoken[x] for x in langs], np.int64)[text] if n else np.zeros(0, np.int64)
        self.per_lang = np.bincount(lang, minlength=len(self.langs))
        self.codes, self.keys = [], []
        prefix = lang
        for k, at in enumerate(self.at):
            if k:
                place = np.zeros(n, np.int64)
                place[self.at[k - 1]] = self.codes[k - 1]
                prefix = place[at]
            code, key = pd.factorize(prefix * self.size + number[at + k])
            self.codes.append(code.astype(np.int64))
            self.keys.append(np.asarray(key, np.int64))

    def counts(self, k: int, where: np.ndarray | None = None) -> np.ndarray:
        codes = self.codes[k] if where is None else self.codes[k][where]
        return np.bincount(codes, minlength=len(self.keys[k]))

    def names(self) -> list[np.ndarray]:
        """64-bit names of the phrases of one, two and three words, language included."""
        import xxhash
        off = np.frombuffer(self.words.buffers()[1], np.int64)[:len(self.words) + 1]
        raw = np.frombuffer(self.words.buffers()[2], np.uint8)[:off[-1]] if len(self.words) else np.zeros(0, np.uint8)
        own = run_hashes(byte_values(raw), off[:-1], off[1:])
        before = np.array([xxhash.xxh64_intdigest(x) for x in self.langs], np.uint64)
        out = []
        for k, key in enumerate(self.keys):
            before = mix(before[key // self.size] * np.uint64(2 * k + 3) + own[key % self.size] + np.uint64(k))
            out.append(before)
        return out

    def phrases(self, k: int, which: np.ndarray) -> tuple[pa.Array, pa.Array]:
        """Languages and texts of the phrases ``which`` of k + 1 words."""
        parts = []
        for level in range(k, -1, -1):
            key = self.keys[level][which]
            parts.append(self.words.take(pa.array(key % self.size)))
            which = key // self.size
        joined = pc.binary_join_element_wise(*parts[::-1], pa.scalar(b" ", pa.large_binary())) if k else parts[0]
        return pa.array(self.langs, pa.string()).take(pa.array(which)), joined.cast(pa.large_string()).cast(pa.string())


def _dealt(names: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of names by bucket (their high bits), and where each bucket begins in it."""
    bucket = ((names >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)
    return np.argsort(bucket.astype(np.uint16) if n < 1 << 16 else bucket, kind="stable"), np.concatenate(
        ([0], np.cumsum(np.bincount(bucket, minlength=n))))


def _chunk_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        for i in range(b.num_rows):
            yield tuple(c[i].as_py() for c in b.columns)


def frequent_bits(packed: DataFrame, min_count: int) -> DataFrame:
    """(chunk, answers): per chunk and bucket, bits of the names that reach ``min_count`` in all chunks together."""
    buckets = shuffle_partitions(packed.sparkSession)
    kind = np.uint8 if min_count < 256 else np.uint32

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, langs, sizes, body in _chunk_rows(batches):
            grams = Grams(langs, sizes, body)
            names = np.concatenate(grams.names())
            counts = np.minimum(np.concatenate([grams.counts(k) for k in range(3)]), min_count).astype(kind)
            order, begin = _dealt(names, buckets)
            names, counts = names[order].astype(np.uint32), counts[order]
            filled = np.flatnonzero(np.diff(begin)).tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array([chunk] * len(filled), pa.int64()), pa.array(filled, pa.int32()),
                 pa.array([names[begin[k]:begin[k + 1]].tobytes() for k in filled], pa.binary()),
                 pa.array([counts[begin[k]:begin[k + 1]].tobytes() for k in filled], pa.binary())],
                names=["chunk", "bucket", "names", "counts"])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: dict[int, list] = {}
        for b in batches:
            for i in range(b.num_rows):
                got.setdefault(b.column(1)[i].as_py(), []).append(
                    (b.column(0)[i].as_py(), np.frombuffer(b.column(2)[i].as_buffer(), np.uint32),
                     np.frombuffer(b.column(3)[i].as_buffer(), kind)))
        for bucket in sorted(got):
            sent = got.pop(bucket)
            names = np.concatenate([s[1] for s in sent])
            order = np.argsort(names, kind="stable")
            ranked = names[order]
            head = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
            total = np.add.reduceat(np.concatenate([s[2] for s in sent])[order].astype(np.int64), head)
            often = np.empty(len(names), bool)
            often[order] = np.repeat(total >= min_count, np.diff(np.append(head, len(names))))
            a, rows = 0, []
            for chunk, own, _ in sent:
                bits = often[a:a + len(own)]
                a += len(own)
                if bits.any():
                    rows.append((chunk, np.packbits(bits).tobytes()))
            if rows:
                ids, bits = zip(*rows)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([bucket] * len(ids), pa.int32()),
                                                  pa.array(bits, pa.binary())], names=["chunk", "bucket", "bits"])

    sent = packed.select("chunk", "langs", "sizes", "body").mapInArrow(send, "chunk long, bucket int, names binary, counts binary")
    bits = sent.repartitionById(buckets, "bucket").mapInArrow(answer, "chunk long, bucket int, bits binary")
    lists = bits.groupBy(F.col("chunk").alias("of")).agg(F.collect_list(F.struct("bucket", "bits")).alias("answers"))
    return staged(lists, "phrase-bits")


def phrase_counts(packed: DataFrame, min_count: int) -> DataFrame:
    """(lang, k, phrase, c): occurrences by the longest phrase (k words) that starts there and can reach ``min_count``;
    k = 0 counts all words of the language. Staged."""
    buckets = shuffle_partitions(packed.sparkSession)
    bits = frequent_bits(packed, min_count)
    joined = packed.join(bits, packed["chunk"] == bits["of"], "left").select("langs", "sizes", "body", "answers")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for langs, sizes, body, answers in _chunk_rows(batches):
            grams = Grams(langs, sizes, body)
            names = grams.names()
            order, begin = _dealt(np.concatenate(names), buckets)
            often = np.zeros(len(order), bool)
            for r in answers or ():
                own = order[begin[r["bucket"]]:begin[r["bucket"] + 1]]
                often[own] = np.unpackbits(np.frombuffer(r["bits"], np.uint8), count=len(own)).astype(bool)
            often = np.split(often, np.cumsum([len(x) for x in names])[:-1])
            free = np.ones(len(grams.at[0]), bool)
            for k in (2, 1, 0):
                counted = often[k][grams.codes[k]] & free[grams.at[k]]
                free[grams.at[k][counted]] = False
                c = grams.counts(k, counted)
                which = np.flatnonzero(c)
                for a in range(0, len(which), 50_000):
                    part = which[a:a + 50_000]
                    lang, text = grams.phrases(k, part)
                    yield pa.RecordBatch.from_arrays([lang, pa.array(np.full(len(part), k + 1, np.int32)), text, pa.array(c[part].astype(np.int64))],
                                                     names=["lang", "k", "phrase", "c"])
            m = len(grams.langs)
            yield pa.RecordBatch.from_arrays([pa.array(grams.langs, pa.string()), pa.array(np.zeros(m, np.int32)), pa.array([""] * m, pa.string()),
                                              pa.array(grams.per_lang.astype(np.int64))], names=["lang", "k", "phrase", "c"])

    rows = joined.mapInArrow(run, "lang string, k int, phrase string, c long")
    return staged(rows.groupBy("lang", "k", "phrase").agg(F.sum("c").alias("c")), "phrase-counts")


def first_words(phrase, n: int):
    return F.substring_index(phrase, " ", n)


def last_words(phrase, n: int):
    return F.substring_index(phrase, " ", -n)


class Graph:
    """Edges, nodes and words of the phrases that reach ``min_count``, staged.

    ``edges``: lang, phrase, c, tail, head (its first and last pair).
    ``nodes``: lang, node, flow, unary, most (weight of its heaviest edge, 0 for none).
    ``words``: lang, word, f. ``sizes``: lang, n.
    """

    def __init__(self, counts: DataFrame, min_count: int):
        phrase = F.col("phrase")
        self.min_count = min_count
        is_edge = (F.col("k") == 3) & (F.col("c") >= min_count)
        self.edges = counts.where(is_edge).select("lang", "phrase", "c", first_words(phrase, 2).alias("tail"), last_words(phrase, 2).alias("head"))
        flows = counts.where("k >= 2").groupBy("lang", first_words(phrase, 2).alias("node")).agg(
            F.sum("c").alias("flow"), F.count_if(is_edge).alias("outs"), F.max(F.when(is_edge, F.col("c"))).alias("most_out"))
        flows = staged(flows, "phrase-flows")
        ins = self.edges.groupBy(F.col("lang").alias("l"), "head").agg(F.count("*").alias("ins"), F.max("c").alias("most_in"))
        kept = flows.where(F.col("flow") >= min_count)
        nodes = kept.join(ins, (kept["lang"] == ins["l"]) & (kept["node"] == ins["head"]), "left")
        self.nodes = staged(nodes.select(
            "lang", "node", "flow", ((F.col("outs") == 1) & (F.coalesce("ins", F.lit(0)) == 1)).alias("unary"),
            F.greatest(F.coalesce("most_out", F.lit(0)), F.coalesce("most_in", F.lit(0))).alias("most")), "phrase-nodes")
        # a word's count: the flows of the pairs it begins, and its own corrections
        starts = flows.select("lang", first_words(F.col("node"), 1).alias("word"), "flow").unionByName(
            counts.where("k = 1").select("lang", phrase.alias("word"), F.col("c").alias("flow")))
        self.words = staged(starts.groupBy("lang", "word").agg(F.sum("flow").alias("f")).where(F.col("f") >= min_count), "phrase-words")
        self.sizes = counts.where("k = 0").select("lang", F.col("c").alias("n"))

    def paths(self) -> DataFrame:
        """(lang, start, stretch, words, weights, corrections, last_flow): unary paths, cut into stretches of edges.

        The flow of a stretch's i-th node is ``weights[i] + corrections[i]``, that of its last node ``last_flow``.
        """
        tails, heads = self.nodes.alias("t"), self.nodes.select("lang", "node", "flow").alias("h")
        e = self.edges.alias("e")
        edges = (e.join(tails, (F.col("e.lang") == F.col("t.lang")) & (F.col("e.tail") == F.col("t.node")))
                 .join(heads, (F.col("e.lang") == F.col("h.lang")) & (F.col("e.head") == F.col("h.node")))
                 .select("e.lang", "e.phrase", "e.c", "e.tail", "e.head", F.col("t.flow").alias("flow"), F.col("t.unary").alias("unary"),
                         F.col("h.flow").alias("next_flow")))
        edges = staged(edges, "phrase-edges")
        # a unary node's one edge in is the edge before its one edge out
        back = edges.select(F.col("lang").alias("l"), F.col("head").alias("h"), F.col("phrase").alias("before"))
        inside = edges.where("unary").join(back, (F.col("lang") == F.col("l")) & (F.col("tail") == F.col("h"))).select("lang", "phrase", "before")
        # jumps: from each inner edge back along its path; done where the path starts
        outer = edges.where(~F.col("unary")).select(F.col("lang").alias("l"), F.col("phrase").alias("p"), F.col("phrase").alias("start"), F.lit(0).cast("long").alias("steps"))
        jumps = staged(inside.select("lang", "phrase", F.col("before").alias("to"), F.lit(1).cast("long").alias("d"), F.lit(False).alias("done")), "phrase-jumps")
        starts = staged(outer, "phrase-starts")
        left = jumps.count()
        while left:
            ahead = jumps.where(~F.col("done")).select(F.col("lang").alias("l"), F.col("phrase").alias("p"), F.col("to").alias("to2"), F.col("d").alias("d2"))
            ended = jumps.where("done").select(F.col("lang").alias("l"), F.col("phrase").alias("p"), F.col("to").alias("to2"), F.col("d").alias("d2"))
            ended = ended.unionByName(starts.select("l", "p", F.col("start").alias("to2"), F.col("steps").alias("d2")))
            known = ahead.withColumn("end", F.lit(False)).unionByName(ended.withColumn("end", F.lit(True)))
            going = jumps.where(~F.col("done"))
            moved = going.join(known, (going["lang"] == known["l"]) & (going["to"] == known["p"])).select(
                "lang", "phrase", F.col("to2").alias("to"), (F.col("d") + F.col("d2")).alias("d"), F.col("end").alias("done"))
            jumps = staged(jumps.where("done").unionByName(moved), "phrase-jumps")
            still = jumps.where(~F.col("done")).count()
            if still == left:
                break  # rings alone are left
            left = still
        placed = jumps.select("lang", "phrase", F.when(F.col("done"), F.col("to")).otherwise(F.col("phrase")).alias("start"),
                              F.when(F.col("done"), F.col("d")).otherwise(F.lit(0)).alias("d"))
        placed = placed.unionByName(starts.select(F.col("l").alias("lang"), F.col("p").alias("phrase"), "start", F.col("steps").alias("d")))
        placed = placed.select(F.col("lang").alias("l"), F.col("phrase").alias("p"), "start", "d")
        rows = edges.join(placed, (edges["lang"] == placed["l"]) & (edges["phrase"] == placed["p"]))
        path = rows.groupBy("lang", "start", F.floor(F.col("d") / STRETCH).cast("long").alias("stretch")).agg(
            F.array_sort(F.collect_list(F.struct("d", "phrase", "c", (F.col("flow") - F.col("c")).alias("rest"), "next_flow"))).alias("m"))
        words = F.concat(F.split(first_words(F.get("m.phrase", F.lit(0)), 2), " "), F.transform("m.phrase", lambda p: last_words(p, 1)))
        return path.select("lang", "start", "stretch", words.alias("words"), F.col("m.c").alias("weights"),
                           F.col("m.rest").alias("corrections"), F.element_at("m.next_flow", -1).alias("last_flow"))

    def candidates(self) -> DataFrame:
        """(lang, phrase, a, first, last, head_flow, tail_flow): phrases of three words with the counts of their pairs, and of
        two words (null flows) that no longer candidate holds in half their places."""
        p = self.paths()
        i = F.col("i")
        each = p.select("lang", "words", "weights", "corrections", "last_flow", F.posexplode("weights").alias("i", "a"))
        flow = lambda k: F.get("weights", k) + F.get("corrections", k)
        three = each.select(
            "lang", F.array_join(F.slice("words", i + 1, F.lit(3)), " ").alias("phrase"), "a", F.get("words", i).alias("first"),
            F.get("words", i + 2).alias("last"), flow(i).alias("head_flow"), F.coalesce(flow(i + 1), "last_flow").alias("tail_flow"))
        none = F.lit(None).cast("long")
        two = self.nodes.where(100 * F.col("most") < 50 * F.col("flow")).select(
            "lang", F.col("node").alias("phrase"), F.col("flow").alias("a"), first_words(F.col("node"), 1).alias("first"),
            last_words(F.col("node"), 1).alias("last"), none.alias("head_flow"), none.alias("tail_flow"))
        return three.unionByName(two)


def scored(graph: Graph) -> DataFrame:
    """(lang, phrase, a, l, r, score): every candidate by its lowest-scoring cut."""
    found = staged(graph.candidates(), "phrase-candidates")
    one, two = graph.words.alias("f1"), graph.words.alias("f2")
    both = (found.alias("x").join(one, (F.col("x.lang") == F.col("f1.lang")) & (F.col("x.first") == F.col("f1.word")))
            .join(two, (F.col("x.lang") == F.col("f2.lang")) & (F.col("x.last") == F.col("f2.word")))
            .select("x.*", F.col("f1.f").alias("w1"), F.col("f2.f").alias("w2")))
    exact = lambda c: F.col(c).cast("decimal(38,0)")
    for name, l, r in (("s1", "l1", "r1"), ("s2", "l2", "r2")):
        pair = {"l1": F.col("w1"), "r1": F.coalesce("tail_flow", "w2"), "l2": F.col("head_flow"), "r2": F.col("w2")}
        both = both.withColumn(l, pair[l]).withColumn(r, pair[r])
        both = both.withColumn("_p", exact(l) * exact(r)).withColumn("_a", F.lit(1000000).cast("decimal(38,0)") * exact("a") * exact("a"))
        both = both.withColumn(name, F.expr("_a div _p"))
    second = F.col("s2").isNotNull() & (F.col("s2") < F.col("s1"))
    return both.select("lang", "phrase", "a", F.when(second, F.col("l2")).otherwise(F.col("l1")).alias("l"),
                       F.when(second, F.col("r2")).otherwise(F.col("r1")).alias("r"),
                       F.when(second, F.col("s2")).otherwise(F.col("s1")).alias("score"))


def collocations(df: DataFrame, lang_col: str = "lang", text_col: str = "text", min_count: int = 10, top: int = 2000) -> DataFrame:
    """Each language's first ``top`` phrases: lang, rank, phrase, a, l, r, n, score.

    By score, then count, both descending, then phrase (bytewise).
    """
    graph = Graph(phrase_counts(chunks(df, lang_col, text_col), min_count), min_count)
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    found = scored(graph).withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
    # a language's candidates are cut in parts first, so that PARTS * top rows meet at most
    near = found.withColumn("_r", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order))).where(F.col("_r") <= top)
    best = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    sizes = graph.sizes.withColumnRenamed("lang", "_lang")
    return best.join(sizes, best["lang"] == sizes["_lang"]).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def oracle_sql(min_count: int = 10, top: int = 2000) -> str:
    """The same by listing every phrase of every piece, for DuckDB."""
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({lower}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
      FROM w, (VALUES (1), (2), (3)) AS v(k) WHERE len(w) >= k),
f AS MATERIALIZED (SELECT lang, k, phrase, count(*)::HUGEINT AS a FROM g GROUP BY ALL),
n AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS MATERIALIZED (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND a >= {min_count}),
y AS MATERIALIZED (SELECT lang, phrase, a, cut, k - cut AS rest, array_to_string(w[:cut], ' ') AS lp, array_to_string(w[cut + 1:], ' ') AS rp
      FROM c, (VALUES (1), (2)) AS v(cut) WHERE cut < k),
x AS (SELECT y.lang, y.phrase, y.a, cut, l.a AS l, r.a AS r, 1000000 * y.a * y.a // (l.a * r.a) AS score
      FROM y JOIN f l ON l.lang = y.lang AND l.k = cut AND l.phrase = lp JOIN f r ON r.lang = y.lang AND r.k = rest AND r.phrase = rp),
b AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
d AS (SELECT lang, array_to_string(w[1:2], ' ') AS phrase, max(a) AS most FROM c WHERE k = 3 GROUP BY ALL
      UNION ALL SELECT lang, array_to_string(w[2:3], ' '), max(a) FROM c WHERE k = 3 GROUP BY ALL),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
      FROM b WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.lang = b.lang AND d.phrase = b.phrase AND 100 * most >= 50 * b.a))
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM o JOIN n USING (lang) WHERE rank <= {top}"""
