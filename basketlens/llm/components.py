"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every id in ``edges`` (a, b bigint); the component is its smallest id.

    Every round hangs neighbours on the smallest id in reach: minima are combined
    before the shuffle and joined back to the edges, so a hub's edges stay spread
    over tasks. Rounds are written to the shared folder; their number grows with
    the logarithm of a component's size. Loops and repeated edges do no harm.
    """
    stars = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while not _is_forest_of_stars(stars):
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = written(large.where("a <> b"), "large_stars")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        stars = written(small.select("e.*").where("a <> b").distinct(), "small_stars")
    return stars.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
        stars.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())


def _is_forest_of_stars(stars: DataFrame) -> bool:
    """Every id hangs on one smaller id, and none hangs on an id that hangs itself."""
    sides = (stars.select(F.col("a").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down"))
             .unionByName(stars.select(F.col("b").alias("id"), F.lit(0).alias("up"), F.lit(1).alias("down"))))
    return sides.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or up = 1 and down = 1").isEmpty()
