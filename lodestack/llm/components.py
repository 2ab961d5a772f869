"""Connected components of links by alternating large and small stars, all in DataFrames.

Every round writes its links to the shared folder; their number never grows beyond that of
the links given, and no row leaves the executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import materialize


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").filter("b <> m").select(F.col("m").alias("a"), "b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("b").agg(F.min("a").alias("m"))
    moved = links.join(least, "b").filter("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b"))
    return moved.unionByName(least.select(F.col("m").alias("a"), "b")).distinct()


def connected_components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node of ``links`` (a < b) but the roots; a root is its component's least node."""
    stars = materialize(links.select("a", "b").filter("a < b").distinct(), name)
    seen = None
    while True:
        mark = stars.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if mark["n"] == 0 or mark == seen:
            return stars.select(F.col("b").alias("node"), F.col("a").alias("root"))
        seen = mark
        stars = materialize(_small_star(_large_star(stars)), name)
