"""Connected components by alternating large-star and small-star steps (Kiveris et al., SoCC 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staymill.functions.session import materialise


def _large(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy(F.col("a").alias("_a")).agg(F.min("b").alias("m"))
    return both.join(low, F.col("a") == F.col("_a")).where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.least("m", "a").alias("b")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy(F.col("a").alias("_a")).agg(F.min("b").alias("m"))
    linked = down.join(low, F.col("a") == F.col("_a")).where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return linked.unionByName(low.select(F.col("_a").alias("a"), F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, label) for every node of the edge list (a, b); the label is the smallest node of its component.

    Each round is written to the shared folder, so the lineage stays short and a lost executor costs one round."""
    current = materialise(edges.where("a != b").distinct(), "edges")
    mark = None
    for _ in range(max_rounds):
        current = materialise(_small(_large(current)), "edges")
        now = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError("components did not settle")
    children = current.select(F.col("a").alias("node"), F.col("b").alias("label"))
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    return children.unionByName(roots)
