"""Frames: where an item is, what is in it, and what is known about it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur import schemas
from larkspur.functions.text import (
    defect_of, guardrail_ok, mime_of, readable_class, texture_of)

CONTRACT = ["origin", "texture", "defect", "kind", "generator", "parent_version", "verified"]


def frame_meta(df: DataFrame, extras: list[str] = (), overrides: str | None = None) -> DataFrame:
    """Add `meta` (the typed contract) and `extra` (free-form, nulls dropped).

    Contract columns that `df` lacks are null; a null origin fails the job.
    `overrides` names a map<string,string> column merged last, so it wins.
    """
    have = set(df.columns)

    def field(name: str) -> Column:
        if name == "origin":
            c = F.col("origin") if name in have else F.lit(None)
            return F.coalesce(c, F.raise_error(F.lit("origin is mandatory")).cast("string"))
        kind = "boolean" if name == "verified" else "string"
        c = F.col(name) if name in have else F.lit(None)
        return c.cast(kind)

    pairs = [x for e in extras for x in (F.lit(e), F.col(e).cast("string"))]
    base = F.create_map(*pairs) if pairs else F.lit(None).cast("map<string,string>")
    base = F.coalesce(base, F.expr("cast(map() as map<string,string>)"))
    if overrides:
        over = F.coalesce(F.col(overrides), F.expr("cast(map() as map<string,string>)"))
        # drop overridden keys first: no dependence on the session's dedup policy
        kept = F.map_filter(base, lambda k, v: ~F.map_contains_key(over, k))
        base = F.map_concat(kept, over)
    return df.withColumns({
        "meta": F.struct(*[field(n).alias(n) for n in CONTRACT]),
        "extra": F.map_filter(base, lambda k, v: v.isNotNull())})


def make_frames(df: DataFrame, labels: str = "labels", width: str | None = None,
                height: str | None = None) -> DataFrame:
    """Nest (uri, labels, meta, extra, run_id) into frame rows.

    The id is a hash of the uri, so a retried task writes the same frame. No
    labels means no region of interest, which keeps the frame out of counts.
    """
    fid = F.substring(F.md5("uri"), 1, 16)

    def size(name: str | None) -> Column:
        return (F.nullif(F.col(name), F.lit(0)) if name else F.lit(None)).cast("int")

    source = F.struct(
        fid.alias("id"), F.col("uri"), mime_of(F.col("uri")).alias("content_type"),
        F.lit(0).cast("bigint").alias("timestamp"),
        size(width).alias("width"), size(height).alias("height"))
    roi = F.struct(
        F.col(labels).alias("label"), F.array(fid).alias("sources"),
        F.create_map(F.lit("kind"), F.lit("whole-image")).alias("meta"))
    empty = F.array().cast(
        "array<struct<label:array<string>,sources:array<string>,meta:map<string,string>>>")
    rois = F.when(F.coalesce(F.size(labels), F.lit(0)) > 0, F.array(roi)).otherwise(empty)
    return df.select(fid.alias("frame_id"), F.array(source).alias("sources"),
                     rois.alias("rois"), "meta", "extra", "run_id")


def split_defect_type(df: DataFrame, column: str = "anomaly_type") -> DataFrame:
    return df.withColumns({"texture": texture_of(F.col(column)),
                           "defect": defect_of(F.col(column))})


def guardrail_filter(df: DataFrame, column: str = "guardrail_pass") -> DataFrame:
    return df.where(guardrail_ok(F.col(column)))


def guardrail_counts(df: DataFrame, keys: list[str], column: str = "guardrail_pass") -> DataFrame:
    ok = guardrail_ok(F.col(column))
    return df.groupBy(*keys).agg(
        F.count_if(ok).alias("passed"), F.count_if(~ok).alias("skipped"))


def earn_label(df: DataFrame, verified: Column) -> DataFrame:
    """The defect is the label only when verified; otherwise review is pending."""
    ok = F.coalesce(verified, F.lit(False))
    return df.withColumns({"verified": ok, "label": F.when(ok, F.col("defect"))
                          .otherwise(schemas.PENDING)})


def version_stats(frames: DataFrame, version: str = "version_id") -> DataFrame:
    """(version_id, dimension, name, count) for labels, frames and content types.

    One explode of (dimension, name) pairs per frame, so the frames are read
    and shuffled once for all three dimensions.
    """
    def pair(dimension: str, name: Column) -> Column:
        return F.struct(F.lit(dimension).alias("dimension"), name.alias("name"))

    labels = F.array_distinct(F.flatten(F.transform("rois", lambda r: r["label"])))
    types = F.array_distinct(F.transform("sources", lambda s: s["content_type"]))
    facts = F.concat(
        F.transform(labels, lambda x: pair("labels", x)),
        F.transform(types, lambda x: pair("content_types", x)),
        F.array(pair("frames", F.lit("total"))))
    return (frames.select(version, F.explode(facts).alias("f"))
            .groupBy(version, "f.dimension", "f.name")
            .agg(F.count(F.lit(1)).alias("count")))


def label_count_any(frames: DataFrame, labels: list[str]) -> DataFrame:
    """Frames with at least one of `labels`, each frame once."""
    wanted = F.array(*[F.lit(x) for x in labels])
    hit = F.exists("rois", lambda r: F.arrays_overlap(r["label"], wanted))
    return frames.where(hit).agg(F.count(F.lit(1)).alias("frames"))


def judge_requests(df: DataFrame, template: str, image: Column | None = None) -> DataFrame:
    """Add `request`: the question about the class, and the image as a data URI."""
    question = F.replace(F.lit(template), F.lit("{label}"), readable_class(F.col("label")))
    parts = [question.alias("question")]
    if image is not None:
        parts.append(F.concat(F.lit("data:"), mime_of(F.col("uri")), F.lit(";base64,"),
                              F.base64(image)).alias("image_url"))
    return df.withColumn("request", F.to_json(F.struct(*parts)))
