"""Streams over landing folders. Every job runs what is available and stops;
its checkpoint is the mark of what has been seen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from larkspur import schemas
from larkspur.operators.gap import gap_report
from larkspur.operators.telemetry import loop_points, numeric_points, stage_points

POINTS = "seq bigint, iteration bigint, title string, series string, value double"


def read_stream(spark: SparkSession, path: str, schema: str, fmt: str = "json",
                files_per_batch: int = 1000) -> DataFrame:
    """Stream a landing folder; malformed JSON lines arrive as null rows."""
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
            .format(fmt).load(path))


def _run(query: StreamingQuery) -> None:
    query.awaitTermination()


def mirror_log(log: DataFrame, target: str, checkpoint: str) -> DataFrame:
    """Replay loop log rows onto a points table, each `seq` once.

    A repeated file, a repeated line and a retried batch all add nothing: rows
    whose seq the table already has are dropped first. The look-up reads only
    row groups at or above the batch's smallest seq.
    """
    spark = log.sparkSession
    spark.createDataFrame([], POINTS).write.mode("ignore").parquet(target)

    def land(batch: DataFrame, _: int) -> None:
        rows = batch.where(F.col("seq").isNotNull())
        first = rows.groupBy("seq").agg(F.min(F.struct(
            *[c for c in rows.columns if c != "seq"])).alias("_r")).select("seq", "_r.*")
        low = first.agg(F.min("seq").alias("s")).collect()[0]["s"]
        if low is None:
            return
        seen = (spark.read.schema(POINTS).parquet(target)
                .where(F.col("seq") >= low).select("seq").distinct())
        points = loop_points(first.join(seen, "seq", "left_anti"))
        points.write.mode("append").parquet(target)

    _run(log.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    return spark.read.schema(POINTS).parquet(target)


def _append(rows: DataFrame, target: str, checkpoint: str) -> DataFrame:
    _run(rows.writeStream.format("parquet").outputMode("append")
         .option("path", target).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    return rows.sparkSession.read.schema(rows.schema).parquet(target)


def scalar_stream(records: DataFrame, target: str, checkpoint: str) -> DataFrame:
    """Append numeric (task, series, step, value) points; other values are dropped."""
    return _append(numeric_points(records), target, checkpoint)


def stage_report_stream(records: DataFrame, target: str, checkpoint: str,
                        keys=("stage",)) -> DataFrame:
    """Append the points of every finished stage."""
    return _append(stage_points(records, keys), target, checkpoint)


def running_gap(labels: DataFrame, target: str, checkpoint: str,
                per_class: int = schemas.TARGET_PER_CLASS) -> DataFrame:
    """Keep (label, have) up to date; the gap is a projection of the newest table.

    State is one counter per class. Each pass writes its own folder, and the
    reader takes the highest, so a reader never sees a half-written table.
    """
    spark = labels.sparkSession
    counts = labels.groupBy("label").agg(F.count(F.lit(1)).alias("have"))

    def land(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/pass={number:012d}")

    _run(counts.writeStream.outputMode("complete").foreachBatch(land)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    passes = spark.read.parquet(target)
    newest = passes.select(F.max("pass").alias("p")).scalar()
    return gap_report(passes.where(F.col("pass") == newest).select("label", "have"), per_class)
