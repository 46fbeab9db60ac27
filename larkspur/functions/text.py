"""String, path and JSON column expressions. All of them stay inside codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Results depend on these exact words.
GUARDRAIL_PASS = ["1", "True", "true"]
TRUTHY = ["1", "true", "yes", "on"]
URL_KEYS = ["endpoint", "url", "app_url", "external_url", "address"]
UNKNOWN_DEFECT = "unknown"


def strip_ws(c: Column) -> Column:
    """Trim every kind of Unicode whitespace; Spark's trim knows only spaces."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def texture_of(defect_type: Column) -> Column:
    """`texture+defect` -> texture; an empty half is null."""
    return F.nullif(F.substring_index(defect_type, "+", 1), F.lit(""))


def defect_of(defect_type: Column) -> Column:
    """`texture+defect` -> defect; an empty half is 'unknown'."""
    last = F.substring_index(F.coalesce(defect_type, F.lit("")), "+", -1)
    return F.coalesce(F.nullif(last, F.lit("")), F.lit(UNKNOWN_DEFECT))


def path_segment(uri: Column, from_end: int) -> Column:
    """Percent-decoded path segment counted from the end, 1 = file name."""
    return F.try_url_decode(F.get(F.reverse(F.split(uri, "/")), F.lit(from_end - 1)))


def run_id_of(uri: Column) -> Column:
    return path_segment(uri, 2)


def version_of(uri: Column) -> Column:
    return path_segment(uri, 3)


def truthy(c: Column) -> Column:
    return F.coalesce(F.lower(strip_ws(c)).isin(TRUTHY), F.lit(False))


def guardrail_ok(c: Column) -> Column:
    """A null cell is a failure; an absent column is handled by the reader."""
    return F.coalesce(strip_ws(c).isin(GUARDRAIL_PASS), F.lit(False))


def usable_score(c: Column) -> Column:
    """Text or number -> double, with NaN and unreadable text as null."""
    v = c.try_cast("double")
    return F.when(~F.isnan(v), v)


def mime_of(path: Column) -> Column:
    jpeg = F.lower(path).endswith(".jpg") | F.lower(path).endswith(".jpeg")
    return F.when(jpeg, "image/jpeg").otherwise("image/png")


def readable_class(label: Column) -> Column:
    return F.replace(label, F.lit("_"), F.lit(" "))


def iteration_index(c: Column) -> Column:
    """'baseline' or null -> 0, otherwise all digits joined, none -> 0."""
    digits = F.regexp_replace(c, "[^0-9]", "")
    n = digits.try_cast("bigint")
    return F.when(c == "baseline", F.lit(0).cast("bigint")).otherwise(
        F.coalesce(n, F.lit(0).cast("bigint")))


def first_url(json_text: Column) -> Column:
    """URL in a JSON document: well-known top-level keys first, then any."""
    named = [F.get_json_object(json_text, f"$.{k}") for k in URL_KEYS]
    named = [F.when(v.rlike("^https?://"), v) for v in named]
    anywhere = F.nullif(
        F.regexp_extract(json_text, r'"(https?://[^"\s]+)"(?!\s*:)', 1), F.lit(""))
    return F.coalesce(*named, anywhere)
