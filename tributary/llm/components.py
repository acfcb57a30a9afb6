"""Connected components of a graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, written


def components(edges: DataFrame) -> tuple[DataFrame, str]:
    """``(node, root)`` for every node of an edge ``(a, b)`` of two longs; the root is its component's smallest node.

    Alternating large-star and small-star steps: every node points its neighbours at the smallest node it knows, until
    nothing changes. Each step is a grouped minimum and a join on the node, so a hub is split like any skewed join key.
    Every round is written to the shared folder. Returns the table and its path.
    """
    spark = edges.sparkSession
    now, path = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while (seen := fingerprint(now)) != before:
        before = seen
        both = now.union(now.select("b", "a"))
        least = both.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m")).select("n", F.least("n", "m").alias("m"))
        large = both.where("b > a").join(least, F.col("a") == F.col("n")).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        middle, middle_path = written(large, "large-star")
        least = middle.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
        small = middle.join(least, F.col("a") == F.col("n")).select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        later, later_path = written(small, "small-star")
        discard(spark, path, middle_path)
        now, path = later, later_path
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b").distinct()), path


def fingerprint(edges: DataFrame) -> tuple:
    """Equal for equal edge sets."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.sum(F.hash("a", "b").cast("bigint"))).first())
