"""The enrichment loop: a bounded driver loop over Spark jobs that may be killed at any time.

Each round reads the gap, splits a budget over it, draws candidates, scores one
attempt per sample for every row of a search grid, keeps the best attempt of each
sample, filters at a bar, tops up from spare attempts, draws again what is still
owed, publishes, and measures a probe on the same real holdout.

Every step is a table, and an entry of a log says that it is whole. A loop that
is started again over the same folder reads the steps that are done and goes on
with the first that is not. Allocation, bar and grid are tables as well, so a
policy of any kind is a query. Only per-round summaries reach the driver.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larkspur import schemas
from larkspur.operators.checks import round_history
from larkspur.operators.evaluation import accuracy
from larkspur.operators.gap import DRAW_GRID, allocate_budget, gap_report
from larkspur.operators.scoring import accepts, default_thresholds
from larkspur.operators.search import best_attempt, filter_and_topup, still_owed
from larkspur.operators.similarity import nn_score
from larkspur.operators.training import stratified_split, train_probe
from larkspur.plans.commit_log import CommitLog
from larkspur.plans.order_stats import take_hashed, take_top
from larkspur.plans.shared import cut, scratch_path
from larkspur.plans.versions import PublishError, VersionStore, frame_rows

#: candidates that are drawn for every sample that is still owed after filtering
AGAIN = 2


def measure(real: DataFrame, made: DataFrame | None, max_iter: int) -> dict:
    """Holdout accuracy of a probe on real rows plus accepted made rows.

    real, made: (uri, label, origin, vector). The holdout never contains a made
    row and does not change when `made` does.
    """
    items = real if made is None else real.unionByName(made)
    split = cut(stratified_split(items))
    row = accuracy(train_probe(split, keep=["uri"], max_iter=max_iter)).collect()[0]
    sizes = split.where(F.col("split") == "train").groupBy().agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("origin") == "synthetic").alias("made")).collect()[0]
    return {"accuracy": row["accuracy"], "n": row["n"],
            "training_rows": sizes["n"], "synthetic_rows": sizes["made"]}


class Steps:
    """Named tables under `root`, each computed once, whoever asks and however often."""

    def __init__(self, spark, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.log = CommitLog(spark, f"{self.root}/log", "step string, path string, facts string")
        self.done = {r["step"]: r for r in self.log.entries().orderBy(F.desc("entry")).collect()}  # the first entry of a step holds

    def table(self, step: str, build: Callable[[], DataFrame]) -> DataFrame:
        if step not in self.done:
            path = f"{self.root}/tables/{uuid.uuid4().hex}"
            build().write.parquet(path)
            self._finish(step, path, None)
        return self.spark.read.parquet(self.done[step]["path"])

    def facts(self, step: str, find: Callable[[], dict]) -> dict:
        if step not in self.done:
            self._finish(step, None, json.dumps(find()))
        return json.loads(self.done[step]["facts"])

    def _finish(self, step: str, path: str | None, facts: str | None) -> None:
        self.done[step] = self.log.append(lambda _: {"step": step, "path": path, "facts": facts})


def default_grid(spark, rounds: int) -> DataFrame:
    """(search, guidance, crop_ratio): the fixed grid, cycled over so many search rounds."""
    rows = [(r, *DRAW_GRID[(r - 1) % len(DRAW_GRID)]) for r in range(1, rounds + 1)]
    return spark.createDataFrame(rows, "search int, guidance double, crop_ratio double")


def draw_candidates(pool: DataFrame, allocation: DataFrame, seed: str, attempts: int) -> DataFrame:
    """`attempts` pool rows for every requested sample: each gets a slot and an attempt from 0 on."""
    wanted = allocation.where(F.col("asked") > 0).select(
        "defect_type", "asked", (F.col("asked") * attempts).alias("_draws"))
    rows = pool.withColumn("_uid", F.concat(F.lit(f"{seed}:"), F.col("uri")))
    drawn = take_hashed(rows, ["defect_type"], wanted, "_draws", "_uid")
    # what is drawn of a type is asked x attempts rows, a budget's worth, so ranking it is bounded
    turn = F.row_number().over(Window.partitionBy("defect_type").orderBy(F.md5("_uid"), "_uid")) - 1
    slotted = drawn.join(wanted.select("defect_type", "asked"), "defect_type").withColumn("_turn", turn.cast("bigint"))
    return slotted.withColumns({
        "attempt": F.floor(F.col("_turn") / F.col("asked")).cast("bigint"),
        "slot": F.concat_ws("#", "defect_type", F.pmod("_turn", "asked").cast("string"))}).drop("_uid", "_turn", "asked")


def search_samples(steps: Steps, name: str, real: DataFrame, pool: DataFrame, allocation: DataFrame, seed: str,
                   grid: DataFrame, threshold: DataFrame | None = None, again: int = AGAIN) -> DataFrame:
    """(label, slot, attempt, item_id, uri, defect_type, nn_score, guidance, crop_ratio, verified, picked).

    The best attempt of every slot, and whatever was picked besides: `picked` is
    kept, topped_up or regenerated for rows that fill the allocation, null for the
    best attempt of a slot that did not reach the bar. The bar is the median of
    the first attempts, which have no settings, unless `threshold` has one row.
    grid: (search, guidance, crop_ratio), one search round a row.
    """
    searches = [tuple(r) for r in grid.orderBy("search").select("search", "guidance", "crop_ratio").collect()]
    drawn = steps.table(f"{name}/drawn", lambda: draw_candidates(pool, allocation, seed, len(searches) + 1))

    def scored(rows: DataFrame, guidance=None, crop_ratio=None) -> DataFrame:
        near = nn_score(rows, real, "label", "item_id", "vector").select("item_id", "nn_score")
        return rows.join(near, "item_id").select(
            "label", "slot", "attempt", "item_id", "uri", "defect_type", "nn_score",
            F.lit(guidance).cast("double").alias("guidance"), F.lit(crop_ratio).cast("double").alias("crop_ratio"))

    tries = None
    for k, settings in enumerate([(None, None, None), *searches]):
        one = steps.table(f"{name}/attempt{k}", lambda k=k, s=settings: scored(drawn.where(F.col("attempt") == k), *s[1:]))
        tries = one if tries is None else tries.unionByName(one)
    bars = steps.table(f"{name}/bar", lambda: (
        threshold.select(F.col("threshold").cast("double")) if threshold is not None
        else default_thresholds(tries.where("attempt = 0"), []).select("threshold")))
    bar = bars.collect()
    bar = float(bar[0][0]) if bar and bar[0][0] is not None else 0.0
    best = steps.table(f"{name}/best", lambda: best_attempt(tries, "slot", "attempt", "nn_score", ["label", "item_id"]))
    quotas = allocation.groupBy("label").agg(F.sum("asked").alias("quota"))
    kept = steps.table(f"{name}/kept", lambda: filter_and_topup(
        tries, best, quotas, "label", "slot", "attempt", "nn_score", bar))

    def drawn_again() -> DataFrame:
        owed = cut(still_owed(kept, quotas, "label").where("shortfall > 0").select(
            "label", "shortfall", (F.col("shortfall") * again).alias("_draws")))
        uid = F.concat(F.lit(f"{seed}:again:"), F.col("uri"))
        fresh = cut(take_hashed(pool.join(drawn.select("item_id"), "item_id", "left_anti").withColumn("_uid", uid),
                                ["label"], owed, "_draws", "_uid").drop("_uid"))
        rows = cut(scored(fresh.withColumns({"slot": F.concat_ws("#", F.lit("again"), "label", "uri"), "attempt": F.lit(0).cast("bigint")})))
        return take_top(rows.where(F.col("nn_score") >= bar), ["label"], owed, "shortfall", "nn_score", "uri")

    regenerated = steps.table(f"{name}/again", drawn_again)
    filled = kept.select("slot", "attempt", "picked")
    shown = best.select("slot", "attempt").unionByName(filled.select("slot", "attempt")).distinct()
    rows = tries.join(shown, ["slot", "attempt"]).join(filled, ["slot", "attempt"], "left")
    rows = rows.unionByName(regenerated.withColumn("picked", F.lit("regenerated")))
    return rows.withColumn("verified", F.col("picked").isNotNull() & accepts(F.col("nn_score"), F.lit(float("-inf"))))


def _of_round(policy: DataFrame | None, number: int) -> DataFrame | None:
    """A policy table's rows for this round; one without a column `round` holds for all."""
    return policy.where(F.col("round") == number) if policy is not None and "round" in policy.columns else policy


def run_rounds(store: VersionStore, dataset: str, real: DataFrame, pool: DataFrame,
               rounds: int, budget: int, target: int = schemas.TARGET_PER_CLASS,
               attempts: int = 2, invocation: str = "loop", max_iter: int = 2000,
               allocation: DataFrame | None = None, threshold: DataFrame | None = None,
               grid: DataFrame | None = None, state: str | None = None) -> DataFrame:
    """History (round, version_id, published, verified, short, accuracy, n, gains).

    real: (item_id, uri, label, origin, vector) and already registered as the
    dataset's first version. pool: (item_id, uri, defect_type, label, vector),
    the stand-in for a generator. Stops early when nothing is short or nothing
    was published.

    Policy, each a table for all rounds or with a column `round`: `allocation`
    (defect_type, label, asked) wins over the gap; `threshold` (threshold) over the
    median of the first attempts; `grid` (search, guidance, crop_ratio) over
    `attempts` - 1 search rounds of the fixed grid. `state` names the folder
    that a killed loop goes on from.
    """
    spark = store.spark
    steps = Steps(spark, state or scratch_path(spark, "loop"))
    real, pool = cut(real), cut(pool)
    if store.latest(dataset) is None:
        raise PublishError(f"{dataset} has no published version" if store.known(dataset) else f"there is no dataset {dataset}")
    grid = default_grid(spark, attempts - 1) if grid is None else grid
    items = real.select("uri", "label", "origin", "vector")
    control = steps.facts("round0", lambda: {**measure(items, None, max_iter), "version": store.latest(dataset)["version_id"]})
    history = [(0, control["version"], 0, 0, None, control["accuracy"], control["n"])]
    types = pool.select("defect_type").distinct()
    for number in range(1, rounds + 1):
        run_id = f"{invocation}-round{number}"
        base = steps.facts(f"{run_id}/base", lambda: {"version": store.latest(dataset)["version_id"]})["version"]
        gap = steps.table(f"{run_id}/gap", lambda: gap_report(store.label_counts(base), target))
        short = gap.agg(F.sum("short").alias("s")).collect()[0]["s"] or 0
        given = _of_round(allocation, number)
        if short == 0 and given is None:
            break
        split = steps.table(f"{run_id}/allocation", lambda: (
            allocate_budget(gap, types, budget) if given is None else given.select(
                "defect_type", "label", F.lit(None).cast("bigint").alias("short"), F.col("asked").cast("bigint").alias("asked"))))
        fresh = steps.table(f"{run_id}/pool", lambda: pool.join(
            frame_rows(store.effective(store.versions().where(F.col("version_id") == base).collect()[0])).select("uri"), "uri", "left_anti"))
        found = search_samples(steps, run_id, real, fresh, split, run_id, _of_round(grid, number), _of_round(threshold, number))
        rows = steps.table(f"{run_id}/rows", lambda: found.select(
            "uri", F.when(F.col("verified"), F.col("label")).otherwise(schemas.PENDING).alias("label"),
            F.lit("synthetic").alias("origin"), F.col("label").alias("defect"),
            F.substring_index("defect_type", "+", 1).alias("texture"),
            F.lit("anomaly").alias("kind"), "verified", F.lit(run_id).alias("run_id"), "nn_score"))

        def publish() -> dict:
            counts = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("verified").alias("ok")).collect()[0]
            # a loop that died between publishing and its entry finds the version by its comment
            there = store.versions().where(F.col("published") & (F.col("dataset") == dataset) & (F.col("comment") == run_id)).collect()
            version = there[0]["version_id"] if there else (
                store.publish_run(dataset, rows, "made", ["nn_score"], run_id) if counts["n"] else None)
            return {"version": version, "n": counts["n"], "ok": counts["ok"]}

        published = steps.facts(f"{run_id}/published", publish)
        if published["version"] is None:
            break

        def learn() -> dict:
            accepted = (frame_rows(store.effective(store.versions().where(F.col("version_id") == published["version"]).collect()[0]))
                        .where((F.col("origin") == "synthetic") & F.col("verified"))
                        .select("uri", "label", "origin").join(pool.select("uri", "vector"), "uri"))
            result = measure(items, accepted.select("uri", "label", "origin", "vector"), max_iter)
            bar = steps.table(f"{run_id}/bar", lambda: None).collect()
            if store.models().where(F.col("name") == f"probe-{run_id}").isEmpty():
                store.register_model(f"probe-{run_id}", published["version"], result["training_rows"],
                                     result["synthetic_rows"], bar[0]["threshold"] if bar else None, result["accuracy"])
            return result

        result = steps.facts(f"{run_id}/measured", learn)
        history.append((number, published["version"], published["n"], published["ok"], int(short),
                        result["accuracy"], result["n"]))
    table = spark.createDataFrame(
        history, "round int, version_id string, published bigint, verified bigint, "
                 "short bigint, accuracy double, n bigint")
    return round_history(table)
