"""Merkle manifest of a table, one tree a group, from concatenated-level strings.

H is the lowercase hex sha256 of its inputs, concatenated; digests go in as hex
text. A leaf is H of its fields, each ``-`` if null, else the number of UTF-8
bytes, ``:`` and the value. The leaves of a group ascend by id; while a group
has several nodes, every ``fanout`` consecutive ones (the last run may be
shorter, even one node) become their H. What is left is the group's subroot (a
lone leaf itself); subroots, by group (null first, bytewise), give the root the
same way.

Method: rows are dealt by ranges of (group, id) and written, so a node's number
in its group is its place in its range plus the rows of the ranges before; a
group that holds most rows is many ranges. Aligned blocks of ``fanout **
depth`` nodes each keep one level as one hex string: fixed-width substrings of
it are hashed to the parents, whose digests concatenated are the next level,
and the substrings that flank a node are its sibling segment. A block ends in
one node of the next round, and the block rows alone go on, until every group
is one node; the subroots are blocks of one more tree. Paths come back down
block by block, so no row is ever joined with more than its own block.

A null id comes first in its group; rows of one group and id are ordered by
their leaf digest, and rows that are equal in every field have equal leaves, so
their order is no matter (each has its own place and proof). An empty table
gives no rows. Texts are hashed whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventflow.llm.common import col, only, shuffle_partitions, staged

FANOUT, DEPTH = 2, 10
#: hex digits of a digest
WIDTH = 64


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def field(value: Column) -> Column:
    """A field of a leaf: ``-`` if null, else its UTF-8 length, a colon, its text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: list[Column]) -> Column:
    return digest(F.concat(*[field(v) for v in values]))


def _levels(n: Column, fanout: int, depth: int) -> Column:
    """How many levels a group of n nodes still has to climb, ``depth`` at most."""
    out = F.lit(depth)
    for k in range(depth - 1, -1, -1):
        out = F.when(n <= fanout ** k, F.lit(k)).otherwise(out)
    return out


def numbered(leaves: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``leaves`` with ``idx`` (from 0, within the group, by ``order``) and ``n`` (the group's rows).

    Places come from ranges of (group, *order) and the counts of a (range,
    group), of which there are as many as ranges and groups together.
    """
    parts = shuffle_partitions(leaves.sparkSession)
    # equal rows may be many: the input's place tells them apart for the deal
    placed = leaves.withColumn("_in", F.monotonically_increasing_id())
    dealt = (placed.repartitionByRange(parts, group, *order, "_in").sortWithinPartitions(group, *order)
             .drop("_in").withColumn("_at", F.monotonically_increasing_id()))
    dealt = staged(dealt, "merkle-leaves")
    part = F.shiftright("_at", 33)
    counts = dealt.groupBy(part.alias("_part"), F.col(group).alias("_group")).agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    before = Window.partitionBy("_group").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("_part", "_group", "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
                           F.sum("_rows").over(Window.partitionBy("_group")).alias("n"))
    return (dealt.join(counts, (part == F.col("_part")) & dealt[group].eqNullSafe(counts["_group"]))
            .withColumn("idx", F.col("_at") - F.col("_first") + F.col("_before")).drop("_at", "_part", "_group", "_first", "_before"))


def _slice(level: Column, first: Column, count) -> Column:
    """The digests first .. first + count of a level, as hex text (binary, so that a substring is found at once)."""
    return F.substring(level, first * WIDTH + 1, F.lit(count * WIDTH) if isinstance(count, int) else count * WIDTH)


def blocks(nodes: DataFrame, fanout: int, depth: int) -> DataFrame:
    """nodes (grp, idx, n, hash, info) -> (grp, block, n, levels, up, top, infos): one row an aligned block.

    ``up`` levels are climbed inside the block, the same number in all blocks of
    a group: ``depth``, or in a group's last round what is left. ``levels`` holds
    the digests of levels 0 to up, one string each; ``infos`` the nodes' own
    values in their order.
    """
    size = fanout ** depth
    got = (nodes.groupBy("grp", F.floor(F.col("idx") / size).cast("long").alias("block"), "n")
           .agg(F.array_sort(F.collect_list(F.struct("idx", "hash", "info"))).alias("members")))
    got = got.withColumn("up", _levels(F.col("n"), fanout, depth))
    level = F.array_join(F.col("members.hash"), "").cast("binary")

    def climb(levels, _):
        here = F.element_at(levels, -1)
        parents = F.ceil(F.length(here) / (WIDTH * fanout)).cast("int")
        hashed = F.transform(F.sequence(F.lit(0), parents - 1), lambda i: digest(_slice(here, i * fanout, fanout)))
        return F.concat(levels, F.array(F.array_join(hashed, "").cast("binary")))

    steps = F.when(F.col("up") > 0, F.sequence(F.lit(1), F.col("up"))).otherwise(F.array().cast("array<int>"))
    got = got.withColumn("levels", F.aggregate(steps, F.array(level), climb))
    return got.select("grp", "block", "n", "levels", "up", F.element_at("levels", -1).cast("string").alias("top"),
                      F.col("members.info").alias("infos"))


def segment(levels: Column, up: Column, i: Column, fanout: int) -> Column:
    """For node i of a block, a (left, right) pair of hex strings a level: the siblings before and behind it in its run."""
    def at(k):
        node = F.floor(i / F.pow(F.lit(fanout), k)).cast("int")
        place = F.pmod(node, F.lit(fanout))
        level = F.element_at(levels, k + 1)
        return F.struct(_slice(level, node - place, place).cast("string").alias("left"),
                        _slice(level, node + 1, F.lit(fanout - 1) - place).cast("string").alias("right"))

    none = F.array().cast("array<struct<left:string,right:string>>")
    return F.when(up > 0, F.transform(F.sequence(F.lit(0), up - 1), at)).otherwise(none)


def _nodes(df: DataFrame, fanout: int) -> DataFrame:
    """Blocks with ``above`` (a struct: the block's own path, the subroot, the root) -> one row a node: grp, block, i, info, above."""
    above = F.col("above")
    each = F.transform("infos", lambda info, i: F.struct(i.alias("i"), info.alias("info"), F.struct(
        F.concat(segment(F.col("levels"), F.col("up"), i, fanout), above["path"]).alias("path"),
        above["subroot"].alias("subroot"), above["root"].alias("root")).alias("above")))
    return df.select("grp", "block", F.inline(each))


def climb_rounds(nodes: DataFrame, fanout: int, depth: int) -> list[DataFrame]:
    """The block rows of every round, the first over ``nodes``; in the last each group is one block."""
    size = fanout ** depth
    rounds = [staged(blocks(nodes, fanout, depth), "merkle-blocks")]
    while (rounds[-1].agg(F.max("n").alias("n")).first()["n"] or 0) > size:
        nodes = rounds[-1].select("grp", F.col("block").alias("idx"), F.ceil(F.col("n") / size).cast("long").alias("n"),
                                  F.col("top").alias("hash"), F.lit(None).cast("string").alias("info"))
        rounds.append(staged(blocks(nodes, fanout, depth), "merkle-blocks"))
    return rounds


def descend(rounds: list[DataFrame], above: DataFrame, fanout: int, depth: int) -> DataFrame:
    """The nodes of the first round (grp, info, above), given ``above`` (grp, above) of every group's root."""
    def under(rows, upper, on):
        return rows.join(upper, rows["grp"].eqNullSafe(upper["_g"]) & on).drop("_g", "_b")

    top = under(rounds[-1], above.select(F.col("grp").alias("_g"), "above"), F.lit(True))
    for rows in rounds[-2::-1]:
        # node i of block b is block b * size + i of the round below
        upper = _nodes(top, fanout).select(F.col("grp").alias("_g"), (F.col("block") * fanout ** depth + F.col("i")).alias("_b"), "above")
        top = under(rows, upper, rows["block"] == upper["_b"])
    return _nodes(top, fanout).select("grp", "info", "above")


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, start, lambda acc, s: digest(F.concat(s["left"], acc, s["right"])))


def proof(path: Column) -> Column:
    """All siblings of a path, bottom up and left to right, concatenated."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")


def _above(path, subroot, root) -> Column:
    return F.struct(path.alias("path"), subroot.alias("subroot"), root.alias("root")).alias("above")


def manifest(df: DataFrame, group: str = "lang", id_col: str = "doc_id",
             fields: list[str] | None = None, tampered: dict[str, Column] | None = None, when: Column | None = None,
             fanout: int = FANOUT, depth: int = DEPTH) -> DataFrame:
    """Per row: id, group, leaf, subroot, root, ``path`` (siblings a level, up to the root), ``checked`` (the leaf that
    is verified), ``folded_root`` and ``verified``.

    ``tampered`` replaces fields (by expressions) in the rows that meet ``when`` before they are verified against
    the untampered manifest: what a reader of changed data would find.
    """
    fields = fields or [id_col, "source", "lang", "n_chars", "text"]
    tampered, when = tampered or {}, F.lit(False) if when is None else when
    df = only(df, [*fields, group, id_col])
    values = {c: col(df, c) for c in fields}
    changed = leaf([tampered.get(c, values[c]) for c in fields])
    rows = df.select(col(df, id_col).alias("id"), col(df, group).cast("string").alias("grp"), leaf(list(values.values())).alias("hash"),
                     F.when(F.coalesce(when, F.lit(False)), changed).alias("other"))
    info = F.struct("id", "hash", "other").alias("info")
    rounds = climb_rounds(numbered(rows, "grp", ["id", "hash"]).select("grp", "idx", "n", "hash", info), fanout, depth)

    # one more tree over the subroots; its root has nothing above it
    subroots = numbered(rounds[-1].select(F.lit(0).alias("all"), F.col("grp").alias("sub"), "top"), "all", ["sub"])
    over = climb_rounds(subroots.select(F.col("all").alias("grp"), "idx", "n", F.col("top").alias("hash"),
                                        F.struct("sub", "top").alias("info")), fanout, depth)
    none = F.array().cast("array<struct<left:string,right:string>>")
    summit = over[-1].select("grp", _above(none, F.lit(None).cast("string"), F.col("top")))
    above = staged(descend(over, summit, fanout, depth).select(
        F.col("info.sub").alias("grp"), _above(F.col("above.path"), F.col("info.top"), F.col("above.root"))), "merkle-subroots")

    got = descend(rounds, above, fanout, depth)
    out = got.select(F.col("info.id").alias(id_col), F.col("grp").alias(group), F.col("info.hash").alias("leaf"), "above.subroot",
                     "above.root", "above.path", F.coalesce("info.other", "info.hash").alias("checked"))
    return (out.withColumn("folded_root", fold(F.col("checked"), F.col("path")))
            .withColumn("verified", F.col("folded_root") == F.col("root")))


def oracle_sql() -> str:
    """The manifest by a recursive query over single nodes, for DuckDB; CRC-32 is spelt out bit by bit."""
    f = lambda c: f"coalesce(octet_length(encode({c}::VARCHAR))::VARCHAR || ':' || {c}::VARCHAR, '-')"
    h = lambda n: "sha256(concat(" + ", ".join(f(c) for c in ("doc_id", "source", "lang", n, "text")) + "))"
    crc = ("xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)), "
           "lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, z: xor(v >> 1, 3988292384 * (v & 1)))))")
    return f"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce('=' || lang, '') AS g, {h('n_chars')} AS leaf,
         CASE WHEN doc_id IS NOT NULL AND {crc} % 7 = 0 THEN {h('(n_chars::HUGEINT + 1)')} ELSE {h('n_chars')} END AS other FROM documents),
l AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY g) AS n FROM d),
t AS (SELECT g, 0 AS lvl, idx, n, leaf AS h FROM l
      UNION ALL
      SELECT g, lvl + 1, idx // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY idx)) FROM t WHERE n > 1 GROUP BY g, lvl, idx // 2, n),
s AS (SELECT g, lvl, h, row_number() OVER (ORDER BY g) - 1 AS idx, count(*) OVER () AS n FROM t WHERE n = 1),
u AS (SELECT 0 AS lvl, idx, n, h FROM s
      UNION ALL
      SELECT lvl + 1, idx // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY idx)) FROM u WHERE n > 1 GROUP BY lvl, idx // 2, n),
p AS (SELECT l.g, l.idx, l.doc_id, t.lvl, (l.idx >> t.lvl) & 1 AS odd, t.h AS sib FROM l JOIN t
        ON l.g = t.g AND t.idx = xor(l.idx >> t.lvl, 1) WHERE t.n > 1
      UNION ALL
      SELECT l.g, l.idx, l.doc_id, s.lvl + u.lvl, (s.idx >> u.lvl) & 1, u.h FROM l JOIN s ON l.g = s.g JOIN u
        ON u.idx = xor(s.idx >> u.lvl, 1) WHERE u.n > 1),
b AS (SELECT l.g, l.idx, s.h AS subroot, r.h AS root, s.lvl + r.lvl AS levels, l.leaf, l.other, l.doc_id
      FROM l JOIN s ON l.g = s.g JOIN u r ON r.n = 1),
q AS (SELECT g, idx, string_agg(sib, '' ORDER BY lvl) AS sibs FROM p GROUP BY g, idx),
w AS (SELECT g, idx, 0 AS lvl, levels, other AS h FROM b
      UNION ALL
      SELECT w.g, w.idx, w.lvl + 1, levels, sha256(CASE WHEN odd = 1 THEN sib || h ELSE h || coalesce(sib, '') END)
      FROM w LEFT JOIN p ON p.g = w.g AND p.idx = w.idx AND p.lvl = w.lvl WHERE w.lvl < levels)
SELECT b.doc_id, b.leaf, b.subroot, b.root, sha256(coalesce(sibs, '')) AS proof_sha256, w.h AS folded_root, w.h = b.root AS verified
FROM b JOIN w ON w.g = b.g AND w.idx = b.idx AND w.lvl = b.levels LEFT JOIN q ON q.g = b.g AND q.idx = b.idx"""
