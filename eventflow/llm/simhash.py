"""SimHash near-duplicates with a segment-popcount embedding.

Fingerprints: A-Z is lower-cased, words are runs of anything but ASCII white
space, a shingle is ``shingle`` consecutive words joined by spaces (a text of
fewer words is one shingle; a text without words has fingerprint zero). A bit
is set if it is set in over half the shingles' XXH64 values (seed 42),
repeats counted.

Linking: a fingerprint is embedded as 32 coordinates, the bit counts of its
two-bit segments. The Manhattan distance of two embeddings is at most their
Hamming distance, so fingerprints within ``max_bits`` lie within ``max_bits``
there. The coordinates form eight axis groups; a total distance of 4 leaves
at least four groups at distance zero, so a grid cell per choice of four
groups (70 cells a fingerprint) meets every pair. In a cell, pairs are held to
the Manhattan bound on eight coarse counts and then to the exact Hamming
distance, and reported by the first cell they share only. Only distinct
fingerprints are linked: copies are one vertex however many they are.

Nulls count as empty texts. Documents with one fingerprint belong together.
A component's id is the smallest non-null id reachable (null if there is
none). Repeated rows give repeated results.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventflow.llm.common import col, staged, steps, texts, with_fields
from eventflow.llm.graph import components

SEED = 42
GROUPS, EQUAL = 8, 4


def _fingerprint(text: bytes, size: int, digest) -> int:
    words = text.lower().split()
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    if n <= size:
        hashes = digest(joined, SEED)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        hashes = b"".join([digest(joined[a:b], SEED) for a, b in zip(starts[:n - size + 1].tolist(), ends[size - 1:].tolist())])
    rows = np.frombuffer(hashes, np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for k in range(0, len(rows), 4096):
        ones += np.unpackbits(rows[k:k + 4096], axis=1).sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(rows)).view(">i8")[0])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                 carry: list[str] | None = None, keep_text: bool = False) -> DataFrame:
    """Per row: id, (text,) carry, ``fp`` (the 64 bits as a long)."""
    src = texts(df, id_col, text_col, carry)
    at = src.columns.index(text_col)
    out = with_fields(src, "fp long", () if keep_text else (text_col,))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        for b in steps(batches, at):
            got = [_fingerprint(t, shingle, xxhash.xxh64_digest) for t in b.column(at).cast(pa.binary()).to_pylist()]
            kept = [b.column(i) for i in range(b.num_columns) if keep_text or i != at]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(got, pa.int64())], names=out.names)

    return src.mapInArrow(run, out)


def links(distinct: DataFrame, max_bits: int = 4) -> DataFrame:
    """Pairs (u, v), u < v, of distinct fingerprints ``fp`` that differ in at most ``max_bits`` (4 at most) bits."""
    if not 0 <= max_bits <= GROUPS - EQUAL:
        raise ValueError(f"the grid holds for 0 to {GROUPS - EQUAL} bits")
    cells, skips = [], []
    for chosen in combinations(range(GROUPS), EQUAL):
        mask = sum(0xFF << 8 * g for g in chosen)
        cells.append(mask - (1 << 64) if mask >> 63 else mask)
        # groups before the last chosen one: equal there, an earlier cell has the pair already
        skips.append(sum(1 << g for g in range(chosen[-1]) if g not in chosen))
    # a cell's number: the choice in the low seven bits, the coordinates' hash above
    grid = F.explode(F.array(*[F.shiftleft(F.xxhash64(F.col("e").bitwiseAND(F.lit(mask))), 7).bitwiseOR(F.lit(k).cast("long"))
                               for k, mask in enumerate(cells)]))
    # only (cell, fp) is shuffled, the same for both sides; the rest is made anew from fp
    placed = distinct.select("fp", embedded(F.col("fp")).alias("e")).select("fp", grid.alias("cell"))
    # Spark sizes the cells as what they are made from, 70 times too low: left to itself it may broadcast them
    a, b = placed.alias("a").hint("merge"), placed.alias("b")
    u, v = F.col("a.fp"), F.col("b.fp")
    s, t = coarse(embedded(u)), coarse(embedded(v))
    manhattan = sum(F.abs(F.shiftrightunsigned(s, 8 * g).bitwiseAND(F.lit(15)) - F.shiftrightunsigned(t, 8 * g).bitwiseAND(F.lit(15)))
                    for g in range(GROUPS))
    differ = embedded(u).bitwiseXOR(embedded(v))
    skipped = F.get(F.array(*[F.lit(x) for x in skips]), F.col("a.cell").bitwiseAND(F.lit(127)).cast("int"))
    first = F.lit(True)
    for g in range(GROUPS - 1):
        first = first & ((skipped.bitwiseAND(F.lit(1 << g)) == 0) | (differ.bitwiseAND(F.lit(0xFF << 8 * g)) != 0))
    return (a.join(b, (F.col("a.cell") == F.col("b.cell")) & (u < v) & (manhattan <= max_bits)
                   & (F.bit_count(u.bitwiseXOR(v)) <= max_bits) & first)
            .select(u.alias("u"), v.alias("v")))


def embedded(fp):
    """32 counts of two bits, packed: the set bits of each two-bit segment."""
    pairs = F.lit(0x5555555555555555)
    low, high = fp.bitwiseAND(pairs), F.shiftrightunsigned(fp, 1).bitwiseAND(pairs)
    return low.bitwiseXOR(high).bitwiseOR(F.shiftleft(low.bitwiseAND(high), 1))


def coarse(e):
    """The counts of an embedding summed over its eight axis groups, packed in bytes."""
    nibbles = F.lit(0x3333333333333333)
    fours = e.bitwiseAND(nibbles) + F.shiftrightunsigned(e, 2).bitwiseAND(nibbles)
    return (fours + F.shiftrightunsigned(fours, 4)).bitwiseAND(F.lit(0x0F0F0F0F0F0F0F0F))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, max_bits: int = 4,
                    carry: list[str] | None = None, keep_text: bool = False) -> DataFrame:
    """Per row: id, (text,) carry, ``fp``, ``component_id`` and ``component_fp`` (the component's smallest fingerprint)."""
    marked = staged(fingerprints(df, id_col, text_col, shingle, carry, keep_text), "simhash-fingerprints")
    distinct = marked.groupBy("fp").agg(F.min(col(marked, id_col)).alias("rep"))
    member = components(links(distinct, max_bits))  # (node, root), only fingerprints with links
    of = staged(distinct.join(member, distinct["fp"] == member["node"], "left").select("fp", "rep", "root"), "simhash-roots")
    # staged as well, so that the join's exchanges are its own: Spark can split the side of a component that holds a third of all
    linked = of.where("root IS NOT NULL")
    least = staged(linked.groupBy(F.col("root").alias("of")).agg(F.min("rep").alias("component_id")), "simhash-components")
    linked = linked.join(least, linked["root"] == least["of"]).select("fp", "component_id", "root")
    alone = of.where("root IS NULL").select("fp", F.col("rep").alias("component_id"), F.col("fp").alias("root"))
    named = linked.unionByName(alone).select(F.col("fp").alias("named_fp"), "component_id", F.col("root").alias("component_fp"))
    return marked.join(named, marked["fp"] == named["named_fp"]).select(
        *[col(marked, c) for c in marked.columns], "component_id", "component_fp")


def hex_digits(fp):
    """16 lowercase hex digits of a fingerprint."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
