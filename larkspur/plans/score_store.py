"""Scores of many runs, with exact medians over all runs so far that do not read all runs.

When runs are added, their scores are written in order of value, and beside them
a histogram of each group: how many scores fall into each bin, and the least and
greatest of these. Bins depend on a score alone (its binary exponent and eight
bits more), so histograms of any runs add up to that of all of them, and counts
below a bin are exact. A median is then a matter of one or two bins, and only the
scores between their ends are read; parquet statistics prune the rest.

A commit reads its own runs only. Runs become visible by an entry in a log, so
several writers may add runs; a run is added once.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.plans.commit_log import CommitLog, Conflict
from larkspur.plans.order_stats import stats_within
from larkspur.plans.shared import cut

_STEPS = 256
_ZERO = 1 << 20
#: with more groups than this, a scan goes by the join with the groups' bins alone
MOST_RANGES = 200


def score_bin(value: Column) -> Column:
    """The number of a score's bin: it grows with the score, and is 0 for 0. Not for NaN.

    Where a logarithm is rounded across a power of two, the bin comes out the
    same from either side.
    """
    size = F.abs(value)
    exponent = F.floor(F.log2(size))
    place = exponent * _STEPS + F.floor((size / F.pow(F.lit(2.0), exponent) - 1) * _STEPS) + _ZERO
    far = F.when(size == float("inf"), F.lit(2 * _ZERO)).otherwise(place)
    return F.when(value == 0, F.lit(0)).otherwise(F.when(value > 0, far).otherwise(-far)).cast("bigint")


def histogram(rows: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """(keys, bin, n, lo, hi) of the usable values."""
    v = F.col(value).cast("double")
    return (rows.where(v.isNotNull() & ~F.isnan(v)).groupBy(*keys, score_bin(v).alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"), F.min(v).alias("lo"), F.max(v).alias("hi")))


def merged(histograms: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Histograms of finer groups, or of several runs, as those of `keys`."""
    return histograms.groupBy(*keys, "bin").agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))


class ScoreStore:
    """Below `root`: scores/commit=X/run_id=R/, bins/commit=X/ and log/."""

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str] = (), score: str = "nn_score"):
        self.spark, self.root, self.keys, self.score = spark, root.rstrip("/"), list(keys), score
        self.log = CommitLog(spark, f"{self.root}/log", "commit string, runs array<string>")

    def runs(self) -> DataFrame:
        return self.log.entries().select(F.explode("runs").alias("run_id"))

    def add_runs(self, rows: DataFrame) -> list[str]:
        """Add the runs in (run_id, keys, score) that are not there yet; returns these."""
        commit = uuid.uuid4().hex
        at = f"{self.root}/scores/commit={commit}"
        fresh = rows.select("run_id", *self.keys, F.col(self.score).cast("double").alias(self.score)).join(
            self.runs(), "run_id", "left_anti")
        fresh.repartitionByRange("run_id", self.score).sortWithinPartitions("run_id", self.score).write.partitionBy("run_id").parquet(at)
        # run ids as text, so none becomes a number by the name of its folder
        own = self.spark.read.schema(fresh.schema).parquet(at)
        histogram(own, ["run_id", *self.keys], self.score).write.parquet(f"{self.root}/bins/commit={commit}")
        added = sorted(r[0] for r in own.select("run_id").distinct().collect())

        def decide(_: int) -> dict:
            taken = {r[0] for r in self.runs().collect()}
            if taken & set(added):
                raise Conflict(f"another writer has added {', '.join(sorted(taken & set(added))[:3])}")
            return {"commit": commit, "runs": added}

        if added:
            self.log.append(decide)
        return added

    def _visible(self, folder: str, schema: str) -> DataFrame:
        commits = [r[0] for r in self.log.entries().select("commit").collect()]
        if not commits:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/{folder}").parquet(
            *[f"{self.root}/{folder}/commit={c}" for c in commits])

    def _ddl(self) -> str:
        return "".join(f"{k} string, " for k in ["run_id", *self.keys])

    def scores(self) -> DataFrame:
        """(run_id, keys, score) of all runs."""
        return self._visible("scores", f"{self._ddl()}{self.score} double")

    def bins(self) -> DataFrame:
        """(run_id, keys, bin, n, lo, hi) of all runs."""
        return self._visible("bins", f"{self._ddl()}bin bigint, n bigint, lo double, hi double")

    def stats(self, keys: Sequence[str] = ()) -> DataFrame:
        """(keys, n, min, median, max) over all runs so far, exactly; `keys` may name run_id and the store's keys."""
        keys = list(keys)
        bins = cut(merged(self.bins(), keys))
        return stats_within(bins, lambda ranges: self._between(ranges, keys), keys)

    def _between(self, ranges: DataFrame, keys: list[str]) -> DataFrame:
        """Scores from lo to hi of each group, as _v; the scan gets the ranges as filters."""
        rows = self.scores().select(*keys, F.col(self.score).alias("_v"))
        found = ranges.limit(MOST_RANGES + 1).collect()
        if not found:
            return rows.where(F.lit(False))
        if len(found) <= MOST_RANGES:
            # a range a group; the outermost ends come as plain bounds, which a scan can prune by
            low, high = min(r["lo"] for r in found), max(r["hi"] for r in found)
            each = [reduce(Column.__and__, [F.col(k).eqNullSafe(F.lit(r[k])) for k in keys] + [F.col("_v").between(r["lo"], r["hi"])])
                    for r in found]
            return rows.where(F.col("_v").between(low, high)).where(reduce(Column.__or__, each))
        named = ranges.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("lo").alias("_from"), F.col("hi").alias("_to"))
        on = [rows[k].eqNullSafe(named[f"_k_{k}"]) for k in keys] + [F.col("_v").between(F.col("_from"), F.col("_to"))]
        return rows.join(named, on, "left_semi")

    def default_thresholds(self, keys: Sequence[str] = ("run_id",)) -> DataFrame:
        """(keys, n, threshold): the exact median of the usable scores."""
        return self.stats(keys).select(*keys, "n", F.col("median").alias("threshold"))

    def distribution(self, keys: Sequence[str]) -> DataFrame:
        """(keys, n, min_score, median_score, max_score) over all runs so far."""
        return self.stats(keys).withColumnsRenamed({m: f"{m}_score" for m in ("min", "median", "max")})
