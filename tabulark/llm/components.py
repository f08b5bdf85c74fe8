"""Connected components of a link table, by alternating large and small stars.

Each step takes the least neighbour of every node (an aggregate with a map-side
part) and joins it back, so a node with very many links is combined before the
shuffle and its join side may be split.  Every round is a written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import stored


def _both(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    near = _both(edges)
    least = near.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return (near.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .filter("a <> b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = _both(edges).filter("b < a")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a")
    return (moved.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct())


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, label) for every node of ``links`` (columns a, b: bigint); label
    is the least node of its component.  Empty links give an empty result."""
    edges = stored(links.select("a", "b").filter("a <> b").distinct(), name)
    print_of = None
    while True:
        row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("h")).collect()[0]
        if (row["n"], row["h"]) == print_of or row["n"] == 0:
            break  # every component is a star about its least node
        print_of = (row["n"], row["h"])
        edges = stored(_small_star(_large_star(edges)), name)
    return (edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
            .unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("label"))).distinct())
