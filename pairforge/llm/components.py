"""Connected components of a stored edge table, without a hot group anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairforge.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each node of an edge reaches.

    ``edges`` has long columns a, b.  Alternates large-star and small-star steps:
    each replaces the edges at a node by edges to its smallest neighbour, found
    by an aggregation and a join, so that no neighbourhood is gathered.  Every
    round is written to the shared folder; the loop ends when a round changes
    nothing.
    """
    now = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    before = None
    while (state := _digest(now)) != before and state[0]:
        before = state
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        now = stored(small.select("e.*").where("u <> v").distinct())
    return now.groupBy("u").agg(F.min("v").alias("component")).unionByName(now.select("v", F.col("v").alias("component")).distinct().toDF("u", "component")).withColumnRenamed("u", "node")


def _digest(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]
