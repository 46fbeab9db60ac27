"""Models, tasks, tags and where a model came from."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def newest_by_tag(models: DataFrame) -> DataFrame:
    """(tag, model_id): the newest model carrying each tag."""
    return (models.select(F.explode("tags").alias("tag"), "model_id", "created")
            .groupBy("tag").agg(F.max_by("model_id", F.struct("created", "model_id"))
                                .alias("model_id")))


def resolve_by_tag(instances: DataFrame, models: DataFrame, tag: str = "tag") -> DataFrame:
    """Instances with `model_id` set to the newest model of their tag."""
    newest = newest_by_tag(models).withColumnRenamed("tag", tag)
    return instances.join(newest, tag, "left")


def unresolved_tags(instances: DataFrame, models: DataFrame, tag: str = "tag") -> DataFrame:
    """Instances whose tag no model carries, including instances without a tag."""
    have = models.select(F.explode("tags").alias(tag)).distinct()
    return instances.join(have, tag, "left_anti")


def missing_required(required: DataFrame, have: DataFrame, name: str = "name") -> DataFrame:
    """Required names that the other table lacks."""
    return required.select(name).distinct().join(have.select(name), name, "left_anti")


def latest_task(tasks: DataFrame, pattern: str, project: str | None = None) -> DataFrame:
    """(name, task_id, status): per matching name the newest completed task, else
    the newest of any status (inside `project`, when one is given)."""
    done = F.coalesce(F.col("status") == "completed", F.lit(False))
    eligible = F.lit(True) if project is None else done | (F.col("project") == project)
    return (tasks.where(F.col("name").rlike(pattern) & eligible)
            .groupBy("name").agg(F.max(F.struct(
                done.alias("done"), "last_update", "task_id", "status")).alias("_t"))
            .select("name", "_t.task_id", "_t.status"))


def top_trials(scores: DataFrame, k: int = 3, score: str = "score", trial: str = "task_id",
               minimise: bool = True) -> DataFrame:
    order = F.asc(score) if minimise else F.desc(score)
    return scores.orderBy(order, trial).limit(k)


def champion(entries: DataFrame, models: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, side, task_id, score, model_id, tags): the best side's last model.

    entries: (keys, side, side_order, task_id, score); a tie goes to the lower
    `side_order`. A winner without a model fails the job.
    """
    best = F.max(F.struct("score", (-F.col("side_order")).alias("_neg"), "side", "task_id"))
    won = (entries.groupBy(*keys).agg(best.alias("_b"))
           .select(*keys, "_b.side", "_b.task_id", "_b.score"))
    last = models.groupBy("task_id").agg(F.max_by("model_id", "ordinal").alias("model_id"))
    model = F.coalesce("model_id", F.raise_error(F.lit("the winner registered no model")).cast("string"))
    return won.join(last, "task_id", "left").select(
        *keys, "side", "task_id", "score", model.alias("model_id"),
        F.array(F.lit("champion"), F.concat(F.lit("trained-on-"), F.col("side"))).alias("tags"))


def version_lineage(versions: DataFrame, frames: DataFrame) -> DataFrame:
    """(version_id, origin, run_id, label, frames): what every version holds, its ancestors' frames included.

    Frames are counted per (version, origin, run, label) first and then summed over each version's ancestors.
    """
    counted = frames.groupBy("version_id", "origin", "run_id", "label").agg(
        F.count(F.lit(1)).alias("frames"))
    chain = versions.select("version_id", F.explode("lineage").alias("_ancestor"))
    return (chain.join(counted.withColumnRenamed("version_id", "_ancestor"), "_ancestor")
            .groupBy("version_id", "origin", "run_id", "label")
            .agg(F.sum("frames").alias("frames")))


def lineage(models: DataFrame, versions: DataFrame, frames: DataFrame) -> DataFrame:
    """The same for every model, by the version it was trained on: models meet class-level rows only."""
    return models.select("model_id", "version_id").join(version_lineage(versions, frames), "version_id")



def version_history(versions: DataFrame, models: DataFrame | None = None) -> DataFrame:
    """Published versions, oldest first, with the models trained on them."""
    rows = versions.where("published").select("version_id", "name", "created")
    if models is not None:
        trained = models.select("version_id", "model_id", F.col("name").alias("model_name"))
        rows = rows.join(trained, "version_id", "left")
        return rows.orderBy("created", "name", "model_id")
    return rows.orderBy("created", "name")


def tag_text(tags: Column) -> Column:
    return F.array_join(tags, ",")
