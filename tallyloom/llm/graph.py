"""Connected components of an edge table, by star operations over DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.store import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest one."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    larger = both.where("v > u").join(least, "u")
    return larger.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link every smaller neighbour of a node, and the node, to the smallest one."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """(node, root) for every node of an edge; the root is the smallest id of its component.

    Alternates large and small stars, each round written to the shared folder, until
    the edges are stars and no longer change. Only two numbers a round reach the
    driver. A node with very many edges is one key of an aggregate that is combined
    before its shuffle, and of a join that adaptive execution may split.
    """
    pairs = edges.select(F.col(left).alias("a"), F.col(right).alias("b")).where("a <> b")
    now = materialize(
        pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "edges",
    )
    seen = None
    while True:
        sums = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        state = tuple(now.agg(F.count("*"), sums).first())
        if state == seen or not state[0]:
            break
        seen = state
        now = materialize(_small_star(_large_star(now)), "edges")
    roots = now.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
