"""Connected components by alternating star contraction, on tables only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.session import discard, materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each larger neighbour of a node to the smallest of its neighbourhood; edges (a, b) have a > b."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    lower = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return lower.union(least.select("a", F.col("m").alias("b"))).distinct()


def _open_nodes(edges: DataFrame) -> int:
    """Nodes that are not yet the middle or an end of one star."""
    ends = edges.select(F.explode(F.array(
        F.struct(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")),
        F.struct(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")),
    )).alias("e")).select("e.*")
    sums = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return sums.where("up > 1 or (up = 1 and down = 1)").count()


def connected_components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, component) for every node of edges (a, b); component is the smallest node reachable.

    Nodes may be of any ordered type. Rows with a null end and loops are left out; repeated edges do
    no harm; without edges the result is empty. Each round is written to the shared folder, so a lost
    executor costs one round; the number of rounds grows with the logarithm of the longest chain.
    """
    now = edges.where("a is not null and b is not null and a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    while True:
        before, now = now, materialize(_small_star(_large_star(now)), label)
        # the first round reads the caller's edges, which discard leaves alone
        discard(before)
        if not _open_nodes(now):
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
