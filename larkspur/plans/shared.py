"""Joins to small tables, shared scratch space and lineage cuts."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.session import own_shared_folder

_CONF = "spark.checkpoint.dir"
_scopes: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The shared folder: spark.checkpoint.dir, else the context's checkpoint directory.

    A cluster has to name one of them. Only a session on a local master that names
    none gets a folder of its own.
    """
    found = spark.conf.get(_CONF, None)
    if not found:
        own = spark.sparkContext._jsc.sc().getCheckpointDir()
        found = own.get() if own.isDefined() else None
    if not found:
        found = own_shared_folder(spark)
    return found.rstrip("/")


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh, never reused path below the shared folder."""
    path = f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex}"
    for scope in _scopes[-1:]:
        scope.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Deletes, at its end, what was written to scratch paths inside. Consume results before.

        with scratch_scope(spark):
            take_top(...).write.parquet(target)
    """
    _scopes.append([])
    try:
        yield
    finally:
        jvm = spark.sparkContext._jvm
        for path in _scopes.pop():
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def cut(df: DataFrame) -> DataFrame:
    """Write `df` to shared storage and read it back.

    The result survives the loss of any executor and carries no lineage. A
    table rather than a checkpoint so that statistics and pruning still work.
    """
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def attach(df: DataFrame, facts: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join per-group facts on null-safe keys; without keys `facts` is one row.

    No broadcast hint: the planner goes by the size of `facts`, which is exact
    for a written table, and uses a skew-split sort-merge join when it is large.
    The one-row case is a scalar subquery, so it never becomes a cross join.
    """
    if not keys:
        return df.withColumns({c: facts.select(c).scalar() for c in facts.columns})
    renamed = facts.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        *[c for c in facts.columns if c not in keys])
    on = [df[k].eqNullSafe(renamed[f"_k_{k}"]) for k in keys]
    return df.join(renamed, on, how).drop(*[f"_k_{k}" for k in keys])
