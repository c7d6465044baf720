"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_hot, stored


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (a, b); component is the
    smallest node reachable. Both columns are bigint.

    Alternating large-star and small-star steps, each over the whole table: a node
    hands its smallest neighbour to its larger (then its smaller) neighbours until
    every link points at its component's root. Each round is written to the shared
    folder; nodes with a large share of the links are joined by broadcast."""
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, before = stored(edges, "edges"), None
    while True:
        n, *state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.sum(F.col("v").cast("decimal(38,0)"))).first()
        if not n or [n, *state] == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        before = [n, *state]
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count(F.lit(1)).alias("n"))
        large = join_hot(both, least, "u", "n", 2 * n).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.distinct(), "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
        small = join_hot(large, least, "u", "n", n).select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        edges = stored(small.where("u <> v").distinct(), "edges")
