"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventflow.llm.common import staged


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return r["n"], r["h"]


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step over edges (u, v), u > v: each node's neighbours are hung on the smallest of them.

    Minima are partial aggregates and the hanging is a join, so a node with a
    third of all edges is never one task's group.
    """
    if large:
        near = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        near = edges
    least = near.groupBy(F.col("u").alias("hub")).agg(F.min("v").alias("m")).select("hub", F.least("hub", "m").alias("m"))
    hung = near.join(least, near["u"] == least["hub"])
    if large:
        out = hung.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = hung.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select(F.col("hub").alias("u"), F.col("m").alias("v")))
    return out.where(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected edges (u, v); the root is the component's smallest node.

    Each round is written to the shared scratch folder; the loop ends when a
    round changes nothing, after a number of rounds logarithmic in the longest path.
    """
    now = staged(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "components")
    state = _state(now)
    while state[0]:
        now = staged(_star(_star(now, True), False), "components")
        after = _state(now)
        if after == state:
            break
        state = after
    roots = now.select("v").distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots.select("v", "v"))
