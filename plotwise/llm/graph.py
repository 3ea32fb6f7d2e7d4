"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotwise.llm.tables import stage, unstage


def _min_of(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node with an edge to a smaller one; ``component`` is the smallest
    node it reaches. ``edges``: two columns of longs; loops and repeated edges do no harm.

    Each round is staged to the shared folder. Minima are partly aggregated before the shuffle, and
    they are joined back with one row per node, so a node of very many edges is split like any
    skewed join.
    """
    a, b = edges.columns
    now = stage(edges.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    mark = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = _min_of(both).select("u", F.least("m", "u").alias("m"))
        large = both.join(lowest, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = (large.join(_min_of(large), "u")
                 .select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
                 .select("e.u", "e.v").filter("u <> v").distinct())
        last, now = now, stage(small, "edges")
        unstage(last)
        new = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if new == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
        mark = new
