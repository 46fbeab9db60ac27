"""Instruction pairs as CSV and JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur import schemas
from larkspur.functions.text import strip_ws


class EmptyDataset(ValueError):
    """A load that must not continue because nothing usable was found."""


def clean_pairs(df: DataFrame) -> DataFrame:
    """Drop rows with an empty side, then trim: a blanks-only cell survives as ''."""
    both = (F.length("instruction") > 0) & (F.length("response") > 0)
    return df.where(both).withColumns(
        {c: strip_ws(F.col(c)) for c in ("instruction", "response")})


def load_pairs_csv(spark: SparkSession, path: str) -> DataFrame:
    raw = (spark.read.schema(schemas.PAIRS).option("header", True)
           .option("enforceSchema", False).option("multiLine", True)
           .option("escape", '"').csv(path))
    return clean_pairs(raw)


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Fail loudly on an empty load; one row is enough to answer."""
    if df.isEmpty():
        raise EmptyDataset(f"{what} has no rows")
    return df


def pairs_as_json(df: DataFrame, *keep: str) -> DataFrame:
    return df.select(*keep, F.to_json(F.struct("instruction", "response")).alias("value"))


def write_pairs_jsonl(df: DataFrame, path: str, dataset: str = "dataset") -> None:
    """One JSON object per line, one folder per dataset name."""
    df.select(dataset, "instruction", "response").write.partitionBy(dataset).json(path)


def read_pairs_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """Strict: a malformed line or a missing key fails the read."""
    rows = spark.read.schema(schemas.PAIRS).option("mode", "FAILFAST").json(path)

    def required(c: str):
        return F.coalesce(F.col(c), F.raise_error(F.lit(f"missing key {c}")).cast("string"))

    return rows.select(*[required(c).alias(c) for c in ("instruction", "response")])


def read_jsonl_lenient(spark: SparkSession, path: str, schema: str,
                       keep_rejects: bool = False) -> DataFrame:
    """Skip malformed lines, or keep them in `_corrupt_record` to be counted."""
    if keep_rejects:
        return (spark.read.schema(f"{schema}, _corrupt_record string")
                .option("mode", "PERMISSIVE").json(path))
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)
