"""Nearest examples by cosine similarity, against all rows or through an index."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larkspur.plans.vector_index import VectorIndex
from larkspur.plans.tiles import best_by_cosine

DECIMALS = 9


def nn_score(candidates: DataFrame, references: DataFrame, label: str, uid: str, vector: str,
             grid: tuple[int, int] | None = None) -> DataFrame:
    """(uid, label, nn_score, nearest): each candidate's closest same-class example.

    Classes never meet. A candidate without a vector, or whose class has no
    example, keeps a null score. Ids may be of any type.
    """
    partial = best_by_cosine(candidates, references, uid, vector, 1, DECIMALS, label, grid=grid)
    everyone = candidates.select(
        F.col(uid).alias("left_id"), label,
        F.lit(None).cast(references.schema[uid].dataType).alias("right_id"), F.lit(None).cast("double").alias("score"))
    rows_ = everyone.unionByName(partial, allowMissingColumns=True)
    order = F.struct((-F.col("score")).alias("_neg"), "right_id")
    best = F.min(F.when(F.col("score").isNotNull(), order)).alias("_b")
    return (rows_.groupBy("left_id").agg(F.max(label).alias(label), best)
            .select(F.col("left_id").alias(uid), label, (-F.col("_b._neg")).alias("nn_score"),
                    F.col("_b.right_id").alias("nearest")))


def mine_similar(queries: DataFrame, pool: DataFrame, uid: str, vector: str, k: int = 5,
                 grid: tuple[int, int] | None = None) -> DataFrame:
    """(query_id, rank, match_id, score): the k most similar pool rows per query."""
    partial = best_by_cosine(queries, pool, uid, vector, k, DECIMALS, skip_self=True, grid=grid)
    w = Window.partitionBy("left_id").orderBy(F.desc("score"), "right_id")
    return (partial.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select(F.col("left_id").alias("query_id"), "rank",
                    F.col("right_id").alias("match_id"), "score"))


def nn_score_indexed(candidates: DataFrame, index: VectorIndex, recall: float = 0.95, exact: bool = False) -> DataFrame:
    """What `nn_score` tells, through an index over the references that was built with the class as its label."""
    best = index.nearest(candidates, 1, recall, exact, skip_self=False).select(
        F.col("query_id").alias(index.uid), F.col("score").alias("nn_score"), F.col("match_id").alias("nearest"))
    return candidates.select(index.uid, index.label).join(best, index.uid, "left").select(
        index.uid, index.label, "nn_score", "nearest")


def mine_similar_indexed(queries: DataFrame, index: VectorIndex, k: int = 5, recall: float = 0.95, exact: bool = False) -> DataFrame:
    """What `mine_similar` tells, through an index over the pool."""
    return index.nearest(queries, k, recall, exact)
