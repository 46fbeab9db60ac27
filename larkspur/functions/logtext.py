"""Numbers and markers out of log text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.functions.text import strip_ws

# Which names become metrics, and which of them are headline KPIs.
METRIC_NAMES = [
    "far", "recall", "precision", "threshold", "loss", "final_train_loss",
    "accuracy", "requested", "generated", "mined", "epochs",
]
KPI_NAMES = ["far", "recall", "final_train_loss", "loss"]

# The two shapes a named number takes, and the optional arrow
# whose right-hand side replaces the number. The arrow part holds no letter, so
# consuming it can never swallow the start of the next match.
_NUMBER = r"(-?\d+(?:\.\d+)?)"
_ARROW = r"(?:\s*%?\s*-+>\s*" + _NUMBER + r")?"
NAMED = r"(?U)([A-Za-z][A-Za-z0-9_\-]*)\s*[=:]\s*" + _NUMBER + r"\s*%?" + _ARROW
BARE_PERCENT = r"(?U)\b([A-Za-z][A-Za-z0-9_]*)\s+" + _NUMBER + "%" + _ARROW


def _matches(text: Column, pattern: str) -> Column:
    """array<struct<name, value>> of one pattern, in text order.

    The text is scanned once; the groups are read from the short matches.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.transform(found, lambda m: F.struct(
        F.lower(F.regexp_extract(m, pattern, 1)).alias("name"),
        F.coalesce(F.regexp_extract(m, pattern, 3).try_cast("double"),
                   F.regexp_extract(m, pattern, 2).try_cast("double")).alias("value")))


def metric_list(text: Column) -> Column:
    """All whitelisted (name, value) pairs; bare percentages after the others."""
    both = F.concat(_matches(text, NAMED), _matches(text, BARE_PERCENT))
    return F.filter(both, lambda m: m["name"].isin(METRIC_NAMES))


def metric_map(text: Column) -> Column:
    """map<name, value>; the later match of a name wins.

    Folding over the match list keeps this a projection: no explode, no
    shuffle, one output row per text, and the matches are computed once.
    """
    def put(found: Column, m: Column) -> Column:
        others = F.map_filter(found, lambda k, v: k != m["name"])
        return F.map_concat(others, F.create_map(m["name"], m["value"]))

    empty = F.expr("cast(map() as map<string,double>)")
    return F.aggregate(metric_list(text), empty, put)


def extract_metrics(logs: DataFrame, keys: list[str], text: str) -> DataFrame:
    """One row per (text row, metric)."""
    return logs.select(*keys, F.explode(metric_map(F.col(text))).alias("name", "value"))


def probe_pairs(line: Column) -> Column:
    """array<struct<key, value>> of one console line's PROBE: payload.

    Several pairs are read only when every token looks like one, since a value
    may itself contain spaces.
    """
    # everything after the first marker; substring_index would take the last
    start = F.locate("PROBE:", line)
    payload = strip_ws(F.substr(line, start + F.lit(6)))
    tokens = F.filter(F.split(payload, r"\s+"), lambda t: t != "")
    many = (F.size(tokens) > 1) & F.forall(tokens, lambda t: F.contains(t, F.lit("=")))
    pairs = F.when(many, tokens).otherwise(F.array(payload))
    parsed = F.transform(pairs, lambda p: F.struct(
        strip_ws(F.substring_index(p, "=", 1)).alias("key"),
        F.when(F.contains(p, F.lit("=")),
               strip_ws(F.regexp_replace(p, r"(?s)^[^=]*=", ""))).otherwise("").alias("value")))
    return F.when(start > 0, F.filter(parsed, lambda kv: kv["key"] != ""))
