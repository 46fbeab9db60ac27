"""Connected components of a graph given as an edge table, by star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import attach_weighted, written


def _stars(edges: DataFrame) -> DataFrame:
    """Each edge (u, v) with the least vertex `m` that u or any of its neighbours in `edges` is. Hubs are spread."""
    least = written(edges.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")))
    return attach_weighted(edges, least, ["u"], "n").withColumn("m", F.least("m", "u"))


def components(edges: DataFrame) -> DataFrame:
    """`u`, `root`: the smallest vertex of each component for all its other vertices.

    `edges` has columns u and v, no nulls. Every round links the larger
    neighbours of each vertex to its least neighbour, then the smaller ones;
    components become stars in a number of rounds that is logarithmic in practice.
    """
    now = written(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    while True:
        state = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state["n"] == 0 or state == before:
            return now.select("u", F.col("v").alias("root"))
        before = state
        both = written(now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v"))))
        large = written(_stars(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                        .filter("u <> v").distinct())
        small = _stars(large)  # here v < u throughout
        now = written(small.select(F.col("v").alias("u"), F.col("m").alias("v"))
                      .unionByName(small.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
