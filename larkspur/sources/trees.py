"""File listings turned into labelled rows. File contents are never read."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.functions.text import basename
from larkspur.plans.shared import cut

# Folder names that carry the label, in order of precedence.
ANOMALY, CLEAN, MASK = "anomaly_image", "clean_image", "mask"


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, length, modificationTime, parts): `parts` are relative to `root`. The driver lists the folders."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .load(root).select("path", "length", "modificationTime"))
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    whole = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(at).toString().rstrip("/") + "/"
    return files.withColumn("parts", F.split(F.substr("path", F.lit(len(whole) + 1)), "/"))


_LISTED = "path string, rel string, length bigint, modificationTime timestamp, is_folder boolean"


def _children(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What lies in each folder of (path, rel)."""
    from pyarrow import fs as files
    for b in batches:
        for path, rel in zip(b["path"].to_pylist(), b["rel"].to_pylist()):
            store, inside = files.FileSystem.from_uri(path)
            found = store.get_file_info(files.FileSelector(inside, recursive=False))
            scheme = path[:len(path) - len(inside)]
            yield pa.RecordBatch.from_arrays([
                pa.array([scheme + f.path for f in found], pa.string()),
                pa.array([f"{rel}/{f.base_name}" if rel else f.base_name for f in found], pa.string()),
                pa.array([f.size for f in found], pa.int64()),
                pa.array([f.mtime for f in found], pa.timestamp("us", tz="UTC")),
                pa.array([f.type == files.FileType.Directory for f in found], pa.bool_())],
                names=["path", "rel", "length", "modificationTime", "is_folder"])


def list_tree(spark: SparkSession, root: str, folders_a_task: int = 200) -> DataFrame:
    """What `list_files` tells, with folders listed by executors, level by level.

    Each level is a table of folders; its tasks list them and write what they
    find, so neither files nor folders pass through the driver. `root` is a URI,
    or a path of this machine, that pyarrow can open (file, hdfs, s3, gs).
    Hidden files and folders, by a leading dot or underscore, are left out.
    """
    root = root if "://" in root else "file://" + os.path.abspath(root.removeprefix("file:"))
    folders, levels = spark.createDataFrame([(root.rstrip("/"), "")], "path string, rel string"), []
    while True:
        found = cut(folders.mapInArrow(_children, _LISTED).where(~F.col("rel").rlike("(^|/)[._][^/]*$")))
        levels.append(found.where("NOT is_folder"))
        folders = found.where("is_folder").select("path", "rel")
        n = folders.count()
        if n == 0:
            break
        folders = folders.repartition(max(1, -(-n // folders_a_task)), "path")
    every = levels[0]
    for level in levels[1:]:
        every = every.unionByName(level)
    return every.select("path", "length", "modificationTime", F.split("rel", "/").alias("parts"))


def _has_suffix(path: Column, *suffixes: str) -> Column:
    lowered = F.lower(path)
    hit = F.lit(False)
    for s in suffixes:
        hit = hit | lowered.endswith(s)
    return hit


def labeled_tree(files: DataFrame) -> DataFrame:
    """(path, kind, texture, defect, label) from a `list_files` result."""
    dirs = F.slice("parts", 1, F.size("parts") - 1)
    files = files.withColumn("_dirs", dirs)
    kind = (F.when(F.array_contains("_dirs", ANOMALY), "anomaly")
            .when(F.array_contains("_dirs", CLEAN), "clean")
            .when(F.array_contains("_dirs", MASK), "mask"))
    rows = (files.where(_has_suffix(F.col("path"), ".jpg", ".png"))
            .withColumn("kind", kind).where(F.col("kind").isNotNull()))
    defect = F.when(F.col("kind") != "clean", F.element_at("_dirs", -1))
    return rows.select(
        "path", "length", "modificationTime", "kind",
        F.col("_dirs")[0].alias("texture"), defect.alias("defect"),
        F.when(F.col("kind") == "anomaly", defect)
        .otherwise(F.col("kind")).alias("label"))


def list_labeled_tree(spark: SparkSession, root: str) -> DataFrame:
    return labeled_tree(list_tree(spark, root))


def training_tree(files: DataFrame) -> DataFrame:
    """Only `<texture>/anomaly_image/<class>/f` and `<texture>/clean_image/f`."""
    p, n = F.col("parts"), F.size("parts")
    anomaly = (n == 4) & (F.get(p, F.lit(1)) == ANOMALY)
    clean = (n == 3) & (F.get(p, F.lit(1)) == CLEAN)
    label = F.when(anomaly, F.get(p, F.lit(2))).when(clean, "clean")
    return (files.where(_has_suffix(F.col("path"), ".png", ".jpg", ".jpeg"))
            .select(F.col("path").alias("uri"), label.alias("label"),
                    F.lit("real").alias("origin"))
            .where(F.col("label").isNotNull()))


def list_training_tree(spark: SparkSession, root: str) -> DataFrame:
    return training_tree(list_tree(spark, root))


def mask_counts(labeled: DataFrame) -> DataFrame:
    """Masks per (texture, class), per texture and in total, in one pass."""
    return (labeled.where(F.col("kind") == "mask")
            .rollup("texture", "defect").agg(F.count(F.lit(1)).alias("masks")))


def runs(files: DataFrame) -> DataFrame:
    """(run_id, last_modified), oldest first; the run is the top folder."""
    return (files.where(F.size("parts") > 1)
            .groupBy(F.col("parts")[0].alias("run_id"))
            .agg(F.max("modificationTime").alias("last_modified"))
            .orderBy("last_modified", "run_id"))


def latest_run(files: DataFrame) -> DataFrame:
    return files.where(F.size("parts") > 1).agg(
        F.max_by(F.col("parts")[0], F.struct("modificationTime", F.col("parts")[0]))
        .alias("run_id"))


def existing(rows: DataFrame, path_column: str, files: DataFrame) -> DataFrame:
    """Rows whose file is listed, matched on (run, file name)."""
    have = files.where(F.size("parts") > 1).select(
        F.col("parts")[0].alias("run_id"), basename(F.col("path")).alias("_base"))
    return (rows.withColumn("_base", basename(F.col(path_column)))
            .join(have, ["run_id", "_base"], "left_semi").drop("_base"))


def resolve_paths(rows: DataFrame, name_column: str, files: DataFrame) -> DataFrame:
    """Add the listed path of each row's file name; unresolved rows keep null.

    Several listed files may share a name; the first by path answers.
    """
    have = files.groupBy(basename(F.col("path")).alias("_base")).agg(
        F.min("path").alias("resolved_path"))
    return (rows.withColumn("_base", basename(F.col(name_column)))
            .join(have, "_base", "left").drop("_base"))
