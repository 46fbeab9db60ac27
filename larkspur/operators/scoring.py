"""Scores, thresholds, verdicts and the reports about them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.functions.text import basename
from larkspur.functions.verdict import parse_verdict
from larkspur.plans.order_stats import group_medians, group_stats
from larkspur.plans.shared import attach, cut

MIN_CONFIDENCE = 0.6
PANEL_SIZE = 12


def manifest_scores(manifest: DataFrame, scores: DataFrame,
                    path: str = "output_filename") -> DataFrame:
    """Each manifest row with its run's score, null where there is none.

    scores: (run_id, base, nn_score), unique per (run_id, base). A file name
    alone is no key: the same name is another item in another run.
    """
    rows = manifest.withColumn("base", basename(F.col(path)))
    return rows.join(scores, ["run_id", "base"], "left")


def accepts(score: Column, threshold: Column) -> Column:
    """True only for a real number at or above a known threshold."""
    return F.coalesce(~F.isnan(score) & (score >= threshold), F.lit(False))


def default_thresholds(scored: DataFrame, keys: Sequence[str] = ("run_id",),
                       score: str = "nn_score") -> DataFrame:
    """(keys, n, threshold): the exact median of the usable scores."""
    return group_medians(scored, list(keys), score, "threshold")


def mean_threshold(thresholds: DataFrame) -> DataFrame:
    return thresholds.agg(F.avg("threshold").alias("mean_threshold"))


def gate_accept(scored: DataFrame, keys: Sequence[str] = (), score: str = "nn_score",
                threshold: Column | None = None, bars: DataFrame | None = None) -> DataFrame:
    """Add `threshold`, `accepted` and `verdict` (null for unscored rows).

    `threshold` is one bar for all rows, `bars` a table (keys, threshold).
    Without either, each group of `keys` (or the whole batch) is gated at its
    own median, for which `scored` is read twice more.
    """
    if threshold is None:
        if bars is None:
            bars = default_thresholds(scored, keys, score)
        facts = cut(bars.select(*keys, "threshold"))
        rows = attach(scored, facts, list(keys), "left")
    else:
        rows = scored.withColumn("threshold", threshold)
    s = F.col(score).cast("double")
    usable = s.isNotNull() & ~F.isnan(s)
    ok = accepts(s, F.col("threshold"))
    return rows.withColumns({
        "accepted": ok,
        "verdict": F.when(usable, F.when(ok, "accept").otherwise("reject"))})


def score_distribution(scored: DataFrame, keys: Sequence[str] = ("anomaly_type",),
                       score: str = "nn_score") -> DataFrame:
    """(keys, n, min_score, median_score, max_score) over usable scores."""
    return group_stats(scored, list(keys), score).withColumnsRenamed(
        {m: f"{m}_score" for m in ("min", "median", "max")})


def acceptance_by_class(gated: DataFrame, label: str = "anomaly_type") -> DataFrame:
    """(class, accepted, total) per class; the null class is the overall row."""
    rows = gated.where(F.col("verdict").isNotNull()).withColumn(
        label, F.coalesce(F.col(label), F.lit("?")))
    return rows.rollup(label).agg(
        F.count_if("accepted").alias("accepted"), F.count(F.lit(1)).alias("total"))


def publish_counters(gated: DataFrame, published: Column, keys: Sequence[str] = ()) -> DataFrame:
    """published, verified, skipped and pending-review rows per group."""
    ok = F.coalesce(published, F.lit(False))
    return gated.groupBy(*keys).agg(
        F.count_if(ok).alias("published"),
        F.count_if(ok & F.col("accepted")).alias("verified"),
        F.count_if(~ok).alias("skipped"),
        F.count_if(ok & ~F.col("accepted")).alias("pending_review"))


def gate_panels(gated: DataFrame, tie: str, score: str = "nn_score",
                size: int = PANEL_SIZE) -> DataFrame:
    """The best accepted and the worst rejected rows, `size` of each."""
    best = (gated.where(F.col("verdict") == "accept")
            .orderBy(F.desc(score), tie).limit(size))
    worst = (gated.where(F.col("verdict") == "reject")
             .orderBy(F.asc(score), tie).limit(size))
    return best.unionByName(worst)


def score_table(gated: DataFrame, path: str, label: str = "anomaly_type",
                score: str = "nn_score") -> DataFrame:
    """Scored rows, best first, with file name, class, score and verdict."""
    return (gated.where(F.col("verdict").isNotNull())
            .orderBy(F.desc(score), path)
            .select(basename(F.col(path)).alias("image"), label,
                    F.round(score, 4).alias("nn_score"), "verdict"))


def judge_gate(replies: DataFrame, text: str = "text",
               min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Parsed verdict columns plus `accepted`; errors are rejections."""
    rows = replies.withColumn("_v", parse_verdict(F.col(text)))
    v = F.col("_v")
    return rows.withColumns({
        "present": v["present"], "confidence": v["confidence"], "reason": v["reason"],
        "error": v["error"],
        "accepted": ~v["error"] & v["present"] & (v["confidence"] >= min_confidence),
    }).drop("_v")
