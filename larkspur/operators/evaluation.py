"""Scores of models and replies, with the resolution they can honestly claim."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larkspur.plans.shared import attach

PERSONA_SAMPLE = 8


def marker_hits(replies: DataFrame, marker: str, text: str = "text") -> DataFrame:
    """Literal, case-sensitive containment; a null reply is a miss."""
    return replies.withColumn("hit", F.coalesce(F.contains(F.col(text), F.lit(marker)), F.lit(False)))


def marker_rate(replies: DataFrame, marker: str, order: Sequence[str] | None = None,
                first: int | None = None, text: str = "text") -> DataFrame:
    """(n, hits, rate): over all replies, or over the `first` ones in `order`."""
    rows = replies if first is None else replies.orderBy(*order).limit(first)
    hits = marker_hits(rows, marker, text)
    return hits.agg(
        F.count(F.lit(1)).alias("n"), F.count_if("hit").alias("hits")).select(
        "n", "hits", F.round(F.col("hits") / F.greatest("n", F.lit(1)), 3).alias("rate"))


def accuracy(predictions: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, n, correct, accuracy)."""
    right = F.coalesce(F.col("label") == F.col("pred"), F.lit(False))
    return predictions.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(right).alias("correct")).withColumn(
        "accuracy", F.try_divide("correct", "n"))


def class_report(predictions: DataFrame) -> DataFrame:
    """(label, precision, recall, f1, support) plus 'macro avg' and 'weighted avg'.

    Built from the confusion counts, so only classes^2 rows are ever shuffled.
    Division by zero gives 0.
    """
    confusion = predictions.groupBy("label", "pred").agg(F.count(F.lit(1)).alias("_n"))
    zero, n = F.lit(0).cast("bigint"), F.col("_n")
    roles = F.array(
        F.struct(F.col("label").alias("label"), n.alias("support"), zero.alias("predicted"),
                 F.when(F.col("label") == F.col("pred"), n).otherwise(zero).alias("tp")),
        F.struct(F.col("pred").alias("label"), zero.alias("support"), n.alias("predicted"),
                 zero.alias("tp")))
    sums = (confusion.select(F.explode(roles).alias("r")).select("r.*")
            .where(F.col("label").isNotNull()).groupBy("label")
            .agg(F.sum("support").alias("support"), F.sum("predicted").alias("predicted"),
                 F.sum("tp").alias("tp")))

    def ratio(a, b):
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))

    per_class = sums.select(
        "label", ratio(F.col("tp"), F.col("predicted")).alias("precision"),
        ratio(F.col("tp"), F.col("support")).alias("recall"),
        ratio(2 * F.col("tp"), F.col("predicted") + F.col("support")).alias("f1"), "support")
    measures = ["precision", "recall", "f1"]
    total = F.sum("support")
    macro = per_class.agg(*[F.avg(m).alias(m) for m in measures], total.alias("support"))
    weighted = per_class.agg(
        *[ratio(F.sum(F.col(m) * F.col("support")), total).alias(m) for m in measures],
        total.alias("support"))
    columns = ["label", *measures, "support"]
    return (per_class.unionByName(macro.withColumn("label", F.lit("macro avg")).select(*columns))
            .unionByName(weighted.withColumn("label", F.lit("weighted avg")).select(*columns)))


def overkill_at_full_recall(predictions: DataFrame, clean: str = "clean",
                            keys: Sequence[str] = ()) -> DataFrame:
    """(keys, threshold, n_clean, overkill, resolution_percent).

    The bar is the lowest defect score (1 - P(clean)), so no defect escapes;
    overkill is the share of clean rows at or above it. Null unless both kinds
    of row exist.
    """
    keys = list(keys)
    is_clean = F.col("label") == clean
    scored = predictions.select(*keys, is_clean.alias("_clean"),
                                (1 - F.col("p_clean")).alias("_s"))
    bars = scored.groupBy(*keys).agg(
        F.min(F.when(~F.col("_clean"), F.col("_s"))).alias("threshold"))
    rows = attach(scored, bars, keys, "left")
    counts = rows.groupBy(*keys).agg(
        F.max("threshold").alias("threshold"), F.count_if("_clean").alias("n_clean"),
        F.count_if(F.col("_clean") & (F.col("_s") >= F.col("threshold"))).alias("_flagged"))
    known = F.col("threshold").isNotNull() & (F.col("n_clean") > 0)
    return counts.select(
        *keys, F.when(known, F.col("threshold")).alias("threshold"), "n_clean",
        F.when(known, F.col("_flagged") / F.col("n_clean")).alias("overkill"),
        F.try_divide(F.lit(100.0), F.col("n_clean")).alias("resolution_percent"))


def metric_resolution(scores: DataFrame, order: str, keys: Sequence[str] = (),
                      value: str = "accuracy", n: str = "n") -> DataFrame:
    """Add the smallest possible step, the change to the previous row, and
    whether that change is no larger than one step (i.e. says nothing)."""
    w = Window.partitionBy(*(list(keys) or [F.lit(0)])).orderBy(order)
    rows = scores.withColumns({
        "step": F.try_divide(F.lit(1.0), F.col(n)),
        "change": F.col(value) - F.lag(value).over(w)})
    # a change of exactly one step must not fail on its last binary digit
    return rows.withColumn("within_one_step", F.abs("change") <= F.col("step") + 1e-12)


def epoch_loss(points: DataFrame, epoch: str, loss: str, n: str,
               keys: Sequence[str] = ()) -> DataFrame:
    """(keys, epoch, samples, mean_loss): mean loss weighted by batch size.

    Losses are summed exactly, to nine decimals, so the order of rows is no matter.
    """
    exact = F.col(loss).cast("decimal(24,9)") * F.col(n).cast("decimal(10,0)")
    return points.groupBy(*keys, epoch).agg(
        F.sum(n).alias("samples"),
        (F.sum(exact).cast("double") / F.greatest(F.sum(n), F.lit(1))).alias("mean_loss"))
