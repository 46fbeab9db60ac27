"""Generation manifests, score tables, search summaries and defect catalogues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur import schemas
from larkspur.functions.text import basename, usable_score
from larkspur.plans.shared import attach, cut

MANIFEST_COLUMNS = [
    "output_filename", "image_filename", "mask_filename", "anomaly_type",
    "guidance", "num_steps", "seed", "PSNR", "guardrail_pass"]
SCORE_COLUMNS = ["path", "anomaly_type", "nn_score", "sample_index", "index"]


def _widest(spark: SparkSession, path: str) -> int:
    """The most columns that the first line of any of the files can have."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("_file"), "value",
                                         F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("_at"))
    heads = lines.groupBy("_file").agg(F.min_by("value", "_at").alias("head"))
    return heads.agg(F.max(F.size(F.split("head", ",")))).collect()[0][0] or 1


def _read_by_header(spark: SparkSession, path: str, names: list[str], absent: dict[str, str]) -> DataFrame:
    """(run_id, _file, ordinal, *names) as text: every file is read by its own header.

    A column that a file lacks gets its value in `absent`, null by default, for
    that file only. A multi-line CSV file is one task, so its rows have
    consecutive ids: the smallest is the header, and the distance to it is the row number.
    """
    cells = [f"_c{i}" for i in range(_widest(spark, path))]
    raw = (spark.read.schema(", ".join(f"{c} string" for c in cells))
           .options(header=False, multiLine=True, escape='"').csv(path))
    rows = raw.select(F.col("_metadata.file_path").alias("_file"), F.monotonically_increasing_id().alias("_id"),
                      F.array(*cells).alias("_cells"))
    # only a number a file is aggregated: the least of rows of cells would sort every file in its task
    firsts = cut(rows.groupBy("_file").agg(F.min("_id").alias("_first")))
    heads = cut(attach(rows, firsts, ["_file"]).where(F.col("_id") == F.col("_first")).select(
        "_file", F.struct("_id", "_cells").alias("_head")))
    joined = attach(rows, heads, ["_file"]).where(F.col("_id") > F.col("_head._id"))
    run = F.get(F.reverse(F.split("_file", "/")), F.lit(1)).alias("run_id")

    def cell(name: str) -> Column:
        at = F.array_position("_head._cells", name).cast("int")
        return F.when(at > 0, F.get("_cells", at - 1)).otherwise(F.lit(absent.get(name)).cast("string")).alias(name)

    return joined.select(run, "_file", (F.col("_id") - F.col("_head._id") - 1).alias("ordinal"), *map(cell, names))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row per generated item; an absent guardrail column counts as passed, file by file."""
    return _read_by_header(spark, path, MANIFEST_COLUMNS, {"guardrail_pass": "1"}).drop("_file", "ordinal")


def score_rows(spark: SparkSession, path: str) -> DataFrame:
    """(run_id, path, base, anomaly_type, key, ordinal, nn_score), nothing dropped."""
    rows = _read_by_header(spark, path, SCORE_COLUMNS, {})
    given = F.coalesce(F.nullif("sample_index", F.lit("")), F.nullif("index", F.lit("")))
    return rows.select(
        "run_id", "path", basename(F.col("path")).alias("base"), "anomaly_type",
        F.coalesce(given.try_cast("bigint"), F.col("ordinal")).alias("key"), "ordinal",
        usable_score(F.col("nn_score")).alias("nn_score"))


def last_per_key(rows: DataFrame, key: str) -> DataFrame:
    """Usable scores with the last duplicate of each (run, key) kept."""
    return (rows.where(F.col("nn_score").isNotNull()).groupBy("run_id", key)
            .agg(F.max_by("nn_score", "ordinal").alias("nn_score")))


def read_scores(spark: SparkSession, path: str, key: str = "key") -> DataFrame:
    """(run_id, key, nn_score); `key="base"` keys on the file name instead."""
    return last_per_key(score_rows(spark, path), key)


def read_search_summary(spark: SparkSession, path: str) -> DataFrame:
    return _read_by_header(spark, path, ["best_round"], {}).drop("_file", "ordinal")


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Distinct defect types with the position of their first appearance."""
    rows = (spark.read.schema(schemas.DEFECT_SPEC).option("mode", "DROPMALFORMED").json(path)
            .select("defect_type", F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"),
                                            F.monotonically_increasing_id()).alias("ord")))
    return catalog(rows)


def catalog(rows: DataFrame) -> DataFrame:
    return (rows.where(F.length("defect_type") > 0).groupBy("defect_type")
            .agg(F.min("ord").alias("ord")).orderBy("ord"))
