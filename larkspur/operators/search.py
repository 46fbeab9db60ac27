"""Best attempt per sample, and whether the search bought anything."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.operators.scoring import score_distribution
from larkspur.plans.order_stats import take_top
from larkspur.plans.shared import attach, cut

ORIGINAL = "original"


def distinct_attempts(rows: DataFrame, keys: Sequence[str], score: str,
                      carry: Sequence[str] = ()) -> DataFrame:
    """One row per attempt where its key repeats: the highest score stays."""
    best = F.max(F.struct(score, *carry)).alias("_b")
    return (rows.where(F.col(score).isNotNull() & ~F.isnan(score))
            .groupBy(*keys).agg(best).select(*keys, "_b.*"))


def best_attempt(attempts: DataFrame, sample: str, round_: str, score: str,
                 carry: Sequence[str] = ()) -> DataFrame:
    """The highest-scoring attempt per sample, the earlier one on a tie.

    An aggregate, not a ranking: partial maxima leave one row per sample and
    task before the shuffle, however many attempts one sample has.
    """
    order = F.struct(F.col(score), (-F.col(round_)).alias("_neg"))
    row = F.struct(round_, score, *carry)
    usable = F.col(score).isNotNull() & ~F.isnan(score)
    return (attempts.where(usable).groupBy(sample)
            .agg(F.max_by(row, order).alias("_b")).select(sample, "_b.*"))


def filter_and_topup(attempts: DataFrame, best: DataFrame, quotas: DataFrame, label: str,
                     sample: str, round_: str, score: str, threshold: DataFrame | float) -> DataFrame:
    """Winners at or above the bar, topped up from spare attempts to the quota.

    quotas: (label, quota). Adds `picked` = 'kept' or 'topped_up'. Within a
    class the highest scores are taken; ties go by md5 of (sample, round).
    Both inputs are used several times: pass tables, not long plans.
    """
    uid = F.concat_ws(":", F.col(sample).cast("string"), F.col(round_).cast("string"))
    columns = [label, sample, round_, score]

    bar = threshold
    if not isinstance(threshold, float):
        found = threshold.collect()  # one number
        bar = found[0][0] if found and found[0][0] is not None else 0.0

    def gated(df: DataFrame) -> DataFrame:
        return df.select(*columns).withColumn("_uid", uid).where(F.col(score) >= bar)

    quotas = quotas.select(label, "quota")
    kept = cut(take_top(gated(best), [label], quotas, "quota", score, "_uid"))
    counts = kept.groupBy(label).agg(F.count(F.lit(1)).alias("_kept"))
    owed = (attach(quotas.select(label, "quota"), counts, [label], "left")
            .select(label, F.greatest(
                F.col("quota") - F.coalesce("_kept", F.lit(0)), F.lit(0)).alias("owed"))
            .where(F.col("owed") > 0))
    owed = cut(owed)
    # read several times: the anti join runs once
    spare = cut(gated(attempts).join(best.select(sample, round_), [sample, round_], "left_anti"))
    extra = take_top(spare, [label], owed, "owed", score, "_uid")
    return (kept.withColumn("picked", F.lit("kept"))
            .unionByName(extra.withColumn("picked", F.lit("topped_up"))).drop("_uid"))


def still_owed(picked: DataFrame, quotas: DataFrame, label: str) -> DataFrame:
    """(label, quota, kept, topped_up, shortfall) after filtering and top-up."""
    got = picked.groupBy(label).agg(
        F.count_if(F.col("picked") == "kept").alias("kept"),
        F.count_if(F.col("picked") == "topped_up").alias("topped_up"))
    rows = attach(quotas.select(label, "quota"), got, [label], "left")
    return rows.select(
        label, F.col("quota").cast("bigint").alias("quota"),
        F.coalesce("kept", F.lit(0)).alias("kept"),
        F.coalesce("topped_up", F.lit(0)).alias("topped_up"),
    ).withColumn("shortfall", F.col("quota") - F.col("kept") - F.col("topped_up"))


def setting_table(attempts: DataFrame, settings: Sequence[str], score: str) -> DataFrame:
    """Every parameter setting over its whole batch: free of best-of selection."""
    return score_distribution(attempts, settings, score)


def improvement_table(stages: dict[str, DataFrame], score: str) -> DataFrame:
    """n, min, median, max per stage. Best-of stages rise by selection alone,
    so read this beside `setting_table`."""
    tagged = [df.select(F.lit(name).alias("stage"), F.col(score)) for name, df in stages.items()]
    rows = tagged[0]
    for other in tagged[1:]:
        rows = rows.unionByName(other)
    return score_distribution(rows, ["stage"], score)


def attempt_wins(summary: DataFrame, column: str = "best_round") -> DataFrame:
    """How often each attempt won; an empty cell is the original pass."""
    name = F.coalesce(F.nullif(F.col(column).cast("string"), F.lit("")), F.lit(ORIGINAL))
    return summary.groupBy(name.alias("attempt")).agg(F.count(F.lit(1)).alias("samples"))


def lifted_count(before: DataFrame, final: DataFrame, sample: str, score: str) -> DataFrame:
    """(lifted, samples): finals above the original; no original counts as -1."""
    b = before.select(sample, F.col(score).alias("_before"))
    rows = final.join(b, sample, "left")
    return rows.agg(
        F.count_if(F.col(score) > F.coalesce("_before", F.lit(-1.0))).alias("lifted"),
        F.count(F.lit(1)).alias("samples"))
