"""A judge's free-text reply -> a verdict that defaults to rejection."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from larkspur.functions.text import strip_ws

_SCHEMA = "present boolean, reason string"


def parse_verdict(reply: Column) -> Column:
    """struct<present, confidence, reason, error> from the first { to the last }.

    Anything unreadable is a rejection with `error` set. A `present` that is
    not a JSON boolean reads as null and therefore rejects as well; a
    `confidence` that is no number from 0 to 1 (NaN and infinity included) is
    an error.
    """
    text = F.coalesce(reply, F.lit(""))
    blob = F.regexp_extract(text, r"(?s)\{.*\}", 0)
    v = F.from_json(blob, _SCHEMA)
    # a confidence may be a number or a number in quotes; absent counts as 0
    said = F.get_json_object(blob, "$.confidence")
    confidence = said.try_cast("double")
    # NaN is larger than any number, so the upper bound keeps it out too
    fits = F.coalesce((confidence >= 0) & (confidence <= 1), F.lit(False))
    valid = F.try_parse_json(blob).isNotNull() & (blob != "") & (said.isNull() | fits)
    why = F.when(blob == "", F.concat(
        F.lit("no JSON in reply: "), strip_ws(F.substring(text, 1, 120)))).otherwise(
        F.concat(F.lit("malformed JSON: "), F.substring(blob, 1, 120)))
    return F.struct(
        F.coalesce(valid & v["present"], F.lit(False)).alias("present"),
        F.when(valid, F.coalesce(confidence, F.lit(0.0))).otherwise(0.0).alias("confidence"),
        F.when(valid, F.substring(F.coalesce(v["reason"], F.lit("")), 1, 200))
        .otherwise(why).alias("reason"),
        (~valid).alias("error"))
