"""Connected components by alternating large-star and small-star steps."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.staging import settle


def _least(pairs: DataFrame) -> DataFrame:
    """Every pair (u, v) with the smallest v of its u; sums up before it shuffles, joins back."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    return pairs.join(least, "u")


def _large(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    found = _least(both).withColumn("m", F.least("m", "u")).filter("v > u")
    return found.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u != v")
    found = _least(down)
    moved = found.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(found.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) for every node of an edge table (u, v).

    Each round writes its edges to the shared folder. The edges at the end are
    stars around the smallest nodes. No edges give no rows.
    """
    now = settle(edges.filter("u != v").select("u", "v").distinct(), "edges")
    mark = None
    while True:
        now = settle(_small(_large(now)), "edges")
        sums = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if sums == mark:
            break
        mark = sums
    members = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return members.union(roots)
