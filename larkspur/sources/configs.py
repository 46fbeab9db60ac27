"""Deployment configs: one row per instance, and back to one document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_config(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("multiLine", True).json(path)


def config_instances(configs: DataFrame, instances: str = "config_per_instance") -> DataFrame:
    """One row per instance with its position; the other columns repeat."""
    others = [c for c in configs.columns if c != instances]
    return configs.select(*others, F.posexplode(instances).alias("position", "instance"))


def nest_instances(rows: DataFrame, keys: list[str],
                   instances: str = "config_per_instance") -> DataFrame:
    """Back to one row per config, instances in their original order."""
    packed = F.array_sort(F.collect_list(F.struct("position", "instance")))
    return rows.groupBy(*keys).agg(
        F.transform(packed, lambda s: s["instance"]).alias(instances))
