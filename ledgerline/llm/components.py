"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import written


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b); the root is the component's least node.

    Each step replaces edges by edges to a neighbourhood's least node until nothing changes; the
    edges are written in between.  A node with many edges is a hot key of a join without an
    aggregate above it (Spark splits it), its minimum is pre-aggregated.  No edges, no rows.
    """
    spark = edges.sparkSession
    now = written(spark, edges.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(
            F.col("u").alias("w"), F.least("u", "m").alias("m"))
        # large star: every greater neighbour of a node goes to the node's least neighbour
        large = written(spark, both.join(least, F.col("u") == F.col("w")).where("v > u")
                        .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
        # small star: a node and its smaller neighbours go to the least of them
        down = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), "m")
        small = large.join(down, F.col("u") == F.col("w")).select(
            F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                              F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))
            .alias("e")).select("e.*").where("u <> v").distinct()
        new = written(spark, small, "edges")
        if new.exceptAll(now).isEmpty() and now.exceptAll(new).isEmpty():
            break
        now = new
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
