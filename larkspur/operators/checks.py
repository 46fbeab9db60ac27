"""Checks that a dataset is what it is believed to be."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larkspur.sources.pairs import EmptyDataset


def dup_frames(frames: DataFrame, keys: Sequence[str] = ("run_id", "basename")) -> DataFrame:
    """Keys that a lineage would count more than once."""
    return (frames.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
            .where(F.col("copies") > 1))


def expected_counts(actual: DataFrame, expected: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, label, expected, actual, matches) over the union of labels."""
    on = [*keys, "label"]
    a = actual.select(*on, F.col("have").cast("bigint").alias("actual"))
    e = expected.select(*on, F.col("have").cast("bigint").alias("expected"))
    return (e.join(a, on, "full").withColumns({
        "expected": F.coalesce("expected", F.lit(0).cast("bigint")),
        "actual": F.coalesce("actual", F.lit(0).cast("bigint"))})
        .withColumn("matches", F.col("expected") == F.col("actual"))
        .select(*on, "expected", "actual", "matches"))


def annotated_share(frames: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, frames, annotated, percent): frames with at least one region."""
    return frames.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("frames"),
        F.count_if(F.size("rois") > 0).alias("annotated")).withColumn(
        "percent", 100.0 * F.col("annotated") / F.col("frames"))


def growth_check(sizes: DataFrame, order: str, size: str, keys: Sequence[str] = ()) -> DataFrame:
    """Add the previous size and whether this one is larger (null on the first)."""
    w = Window.partitionBy(*(list(keys) or [F.lit(0)])).orderBy(order)
    return sizes.withColumn("previous", F.lag(size).over(w)).withColumn(
        "grew", F.col(size) > F.col("previous"))


def round_history(rounds: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Add each round's gain over the previous round and over round 0.

    rounds: (keys, round, accuracy, ...), one row per round.
    """
    w = Window.partitionBy(*(list(keys) or [F.lit(0)])).orderBy("round")
    return rounds.withColumns({
        "gain_over_previous": F.col("accuracy") - F.lag("accuracy").over(w),
        "gain_over_baseline": F.col("accuracy") - F.first("accuracy").over(w)})


#: a training set below this says nothing about a class
LEAST_TRAINING_ITEMS = 10


def require_scores(scores: DataFrame, score: str = "nn_score") -> DataFrame:
    """`scores`, or an error if none of them is a number: a batch without scores must not be gated to nothing."""
    usable = F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double"))
    if scores.where(usable).isEmpty():
        raise EmptyDataset("no usable score")
    return scores


def require_masks(counts: DataFrame, masks: str = "masks") -> DataFrame:
    """Mask counts, or an error if there is no mask at all."""
    if counts.where(F.col(masks) > 0).isEmpty():
        raise EmptyDataset("no masks")
    return counts


def require_training_items(items: DataFrame, least: int = LEAST_TRAINING_ITEMS) -> DataFrame:
    """Training items, or an error if there are fewer than `least`."""
    found = items.limit(least).count()
    if found < least:
        raise EmptyDataset(f"{found} training items, {least} are the least")
    return items
