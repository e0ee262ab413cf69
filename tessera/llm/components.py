"""Connected components of an edge table, by contraction towards random priorities.

Every round each node points to the neighbour of least hashed priority (or to itself), edges move to the nodes pointed
to, and loops and repeats go; when no edge is left, every node points to the root of its component. Random priorities shrink any graph, chains included, by a constant share a round. Each
round's tables are written to the shared folder; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import staged


def _ranked(column: str):
    return F.struct(F.xxhash64(column).alias("h"), F.col(column).alias("node"))


def components(edges: DataFrame, rows: int | None = None) -> DataFrame:
    """(node, root) for every node of edges (a, b); nodes of one component share the root, which is one of them.

    rows, if known, bounds the edges.
    """
    edges = staged(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges", rows)
    count = edges.count()
    labels, nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("root")), 2 * count
    first = True
    while count:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        best = both.groupBy("a").agg(F.min(_ranked("b")).alias("best"))
        best = best.select(F.col("a").alias("from"), F.least(_ranked("a"), F.col("best")).getField("node").alias("to"))
        best = staged(best, "pointers", 2 * count)
        if first:
            labels, first = best.select(F.col("from").alias("node"), F.col("to").alias("root")), False
        else:
            moved = labels.join(best, labels["root"] == best["from"], "left")
            labels = staged(moved.select("node", F.coalesce("to", "root").alias("root")), "labels", nodes)
        to_a, to_b = (best.select(F.col("from").alias(f"at_{k}"), F.col("to").alias(f"to_{k}")) for k in "ab")
        moved = edges.join(to_a, F.col("a") == F.col("at_a")).join(to_b, F.col("b") == F.col("at_b")).where("to_a <> to_b")
        edges = staged(moved.select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).distinct(), "edges", count)
        count = edges.count()
    return labels
