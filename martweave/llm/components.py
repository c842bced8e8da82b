"""Connected components of an edge table by repeated contraction.

In each round every node moves to that neighbour (or itself) whose hash of that round is the
smallest, and the edges are rewritten to where their ends moved.  Fresh hashes per round make
chains shrink by a constant factor whatever their ids, so rounds follow the logarithm of the
longest chain.  A node's choice is a minimum with map-side combination and is joined back, so
a node with very many edges is never gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import kept


def _simple(edges: DataFrame) -> DataFrame:
    """Each edge once, the smaller end first, no loops."""
    return edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(`node`, `root`) for every node of `edges` (`a`, `b`); nodes are joined iff roots are equal."""
    edges = kept(_simple(edges), "edges")
    root, turn = None, 0
    while not edges.isEmpty():
        seen = edges.select(F.col("a").alias("node"), F.col("b").alias("to")).unionByName(
            edges.select(F.col("b").alias("node"), F.col("a").alias("to"))
        )

        def rank(name: str, salt: int = turn):
            return F.struct(F.xxhash64(F.col(name), F.lit(salt)), F.col(name).alias("v"))

        moved = kept(
            seen.groupBy("node")
            .agg(F.min(rank("to")).alias("best"))
            .select("node", F.least("best", rank("node")).getField("v").alias("to")),
            "moved",
        )
        at_a = moved.select(F.col("node").alias("a"), F.col("to").alias("to_a"))
        at_b = moved.select(F.col("node").alias("b"), F.col("to").alias("to_b"))
        rewritten = edges.join(at_a, "a").join(at_b, "b").select(F.col("to_a").alias("a"), F.col("to_b").alias("b"))
        edges = kept(_simple(rewritten), "edges")
        if root is None:
            root = moved.select("node", F.col("to").alias("root"))
        else:
            onward = moved.select(F.col("node").alias("root"), "to")
            root = kept(
                root.join(onward, "root", "left").select("node", F.coalesce("to", "root").alias("root")), "roots"
            )
        turn += 1
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")) if root is None else root
