"""Registry of queries over the given tables, and the tables in operator shape.

Every query pairs a DataFrame builder with the SQL that states the same result.
The stand-ins below map the given tables onto frames, scores, attempts, logs
and models; each has an SQL twin.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.functions.text import basename

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        assert name not in QUERIES, name
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql.strip()
        return fn
    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def write_files(names: DataFrame, root: str) -> int:
    """Put a small file under `root` for every row of (rel), by the executors; returns how many."""
    at = root if "://" in root else "file://" + root.removeprefix("file:")

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs as files
        store, inside = files.FileSystem.from_uri(at)
        for b in batches:
            rels = b["rel"].to_pylist()
            for folder in {r.rpartition("/")[0] for r in rels}:
                store.create_dir(f"{inside}/{folder}")
            for r in rels:
                with store.open_output_stream(f"{inside}/{r}") as out:
                    out.write(r.encode())
            yield pa.RecordBatch.from_arrays([pa.array([len(rels)], pa.int64())], names=["n"])

    return names.select("rel").mapInArrow(put, "n bigint").agg(F.sum("n")).collect()[0][0] or 0


def r6(c):
    return F.round(c, 6)


# ---- frames: documents ------------------------------------------------------

FRAMES = """
frames AS (
  SELECT doc_id, lang AS label, source AS run_id, n_chars,
    CAST(replace(source, 'src', '') AS BIGINT) AS vno,
    'v' || replace(source, 'src', '') AS version_id,
    CASE WHEN CAST(replace(source, 'src', '') AS BIGINT) < 10 THEN 'real' ELSE 'synthetic' END AS origin,
    '/store/v' || replace(source, 'src', '') || '/' || source || '/' || lang || '%2B' || doc_id || '.txt' AS uri,
    lang || '%2B' || doc_id || '.txt' AS base,
    source || '+' || lang AS anomaly_type
  FROM documents)"""


def frames(spark: SparkSession, sf: str, *extra: str) -> DataFrame:
    number = F.replace(F.col("source"), F.lit("src"), F.lit(""))
    rows = table(spark, sf, "documents").select(
        "doc_id", F.col("lang").alias("label"), F.col("source").alias("run_id"), "n_chars",
        number.cast("bigint").alias("vno"), F.concat(F.lit("v"), number).alias("version_id"),
        F.concat(F.lit("/store/v"), number, F.lit("/"), F.col("source"), F.lit("/"),
                 F.col("lang"), F.lit("%2B"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("uri"),
        F.concat("source", F.lit("+"), "lang").alias("anomaly_type"), *extra)
    return rows.withColumns({
        "origin": F.when(F.col("vno") < 10, "real").otherwise("synthetic"),
        "base": basename(F.col("uri"))})


# manifest rows and scores: documents with labels

SCORED = FRAMES + """,
scored AS (
  SELECT f.*, l.quality, l.toxic,
    CASE WHEN l.doc_id IS NOT NULL THEN CAST(f.n_chars AS DOUBLE) END AS nn_score,
    CASE WHEN l.toxic IS NULL THEN 'true' WHEN l.toxic = 0 THEN '1' ELSE '0' END AS guardrail_pass
  FROM frames f LEFT JOIN labels l USING (doc_id)),
bars AS (SELECT run_id, median(nn_score) AS threshold FROM scored WHERE nn_score IS NOT NULL GROUP BY run_id),
gated AS (
  SELECT s.*, b.threshold, coalesce(s.nn_score >= b.threshold, false) AS accepted,
    CASE WHEN s.nn_score IS NULL THEN NULL WHEN s.nn_score >= b.threshold THEN 'accept' ELSE 'reject' END AS verdict
  FROM scored s LEFT JOIN bars b USING (run_id))"""


def manifest(spark: SparkSession, sf: str) -> DataFrame:
    marks = table(spark, sf, "labels")
    rows = frames(spark, sf).drop("base").withColumnRenamed("uri", "output_filename")
    rows = rows.join(marks, "doc_id", "left")
    return rows.withColumn("guardrail_pass", F.when(F.col("toxic").isNull(), "true")
                           .when(F.col("toxic") == 0, "1").otherwise("0"))


def scores(spark: SparkSession, sf: str) -> DataFrame:
    """(run_id, base, nn_score): the labelled documents are the scored ones."""
    marks = table(spark, sf, "labels").select("doc_id")
    return (frames(spark, sf).join(marks, "doc_id")
            .select("run_id", "base", F.col("n_chars").cast("double").alias("nn_score"), "doc_id"))


# ---- attempts: lineitem -----------------------------------------------------

ATTEMPTS = """
attempts AS (
  SELECT l_orderkey AS sample, l_linenumber AS round, max(l_extendedprice) AS score,
    max({'s': l_extendedprice, 'c': l_returnflag}).c AS label
  FROM lineitem GROUP BY 1, 2),
best AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY score DESC, round) AS rn
                 FROM attempts) WHERE rn = 1)"""


def attempts(spark: SparkSession, sf: str) -> DataFrame:
    from larkspur.operators.search import distinct_attempts
    rows = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("sample"), F.col("l_linenumber").alias("round"),
        F.col("l_extendedprice").alias("score"), F.col("l_returnflag").alias("label"))
    return distinct_attempts(rows, ["sample", "round"], "score", ["label"])


# ---- class needs of many datasets: lineitem x part x supplier ----------------

NEEDS = """
base AS (
  SELECT s_nationkey, p_type AS label, l_returnflag AS flag
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey),
have AS (SELECT s_nationkey, label, count(*) AS have FROM base GROUP BY 1, 2),
gap AS (SELECT s_nationkey, label, have, max(have) OVER (PARTITION BY s_nationkey) - have AS short FROM have),
types AS (SELECT s_nationkey, flag || '+' || label AS defect_type, label, count(*) AS rows_
          FROM base GROUP BY 1, 2, 3),
shared AS (SELECT *, count(*) OVER (PARTITION BY s_nationkey, label) AS share FROM types),
weighted AS (
  SELECT s_nationkey, defect_type, label, short, rows_, short / CAST(share AS DOUBLE) AS w, 5 + s_nationkey AS budget
  FROM shared JOIN gap USING (s_nationkey, label) WHERE short > 0),
ranked AS (
  SELECT *, count(*) OVER (PARTITION BY s_nationkey) AS n,
    round(sum(w) OVER (PARTITION BY s_nationkey)) AS total,
    row_number() OVER (PARTITION BY s_nationkey ORDER BY w DESC, defect_type) AS rk FROM weighted),
exact AS (SELECT *, CASE WHEN budget > n THEN (budget - n) * w / total ELSE 0.0 END AS ex FROM ranked),
floored AS (SELECT *, floor(ex) AS fl, ex - floor(ex) AS fr FROM exact),
placed AS (
  SELECT *, (budget - n) - sum(fl) OVER (PARTITION BY s_nationkey) AS left_,
    row_number() OVER (PARTITION BY s_nationkey ORDER BY fr DESC, defect_type) AS ord FROM floored),
alloc AS (
  SELECT s_nationkey, defect_type, label, CAST(short AS BIGINT) AS short, rows_,
    CAST(CASE WHEN budget <= n THEN CASE WHEN rk <= budget THEN 1 ELSE 0 END
         ELSE 1 + fl + CASE WHEN ord <= left_ THEN 1 ELSE 0 END END AS BIGINT) AS asked
  FROM placed)"""


def needs(spark: SparkSession, sf: str) -> DataFrame:
    """(s_nationkey, label, flag, n): pre-aggregated once for counts and types."""
    line = table(spark, sf, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag")
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("label"))
    supplier = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    return (line.join(part, "l_partkey").join(supplier, "l_suppkey")
            .groupBy("s_nationkey", "label", F.col("l_returnflag").alias("flag"))
            .agg(F.count(F.lit(1)).alias("n")))


# ---- telemetry: events ------------------------------------------------------

EVENTS = r"""
ev AS (
  SELECT event_id, ts, user_id, event_type, value,
    CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS BIGINT) AS k,
    CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS vt FROM events),
logs AS (
  SELECT *, CASE event_type
      WHEN 'click' THEN 'pass over, far : ' || vt || '% with Threshold = 0.' || k
      WHEN 'view' THEN 'after tuning Far ' || vt || '% --> ' || k || '.25%, limit below 2%'
      WHEN 'purchase' THEN 'batch closed; requested:' || k || ' granted=9 generated= ' || vt || ' in all'
      WHEN 'error' THEN 'stopped at loss=' || vt || ', far ' || k || '% then far=15% in epochs : ' || k
      ELSE 'Recall ' || k || '% and accuracy=' || vt || ' -> 0.' || k || ' at noise=4, no loss' END AS summary,
    CASE event_type WHEN 'click' THEN 'baseline' WHEN 'view' THEN 'iter' || (k % 7)
      WHEN 'purchase' THEN 'iter1-try' || (k % 3) WHEN 'error' THEN 'final' END AS iter,
    CASE WHEN event_type = 'error' THEN NULL ELSE value END AS duration_sec,
    CASE WHEN event_type <> 'view' THEN CAST(k AS DOUBLE) END AS tok_in,
    CAST(k * 2 AS DOUBLE) AS tok_out
  FROM ev),
-- fixed values: the number patterns and the names below are the language that is read
matches AS (
  SELECT event_id, 0 AS kind, unnest(regexp_extract_all(summary, '([A-Za-z][A-Za-z0-9_\-]*)\s*[=:]\s*(-?[0-9]+(?:\.[0-9]+)?)\s*(%?)(?:\s*%?\s*-+>\s*(-?[0-9]+(?:\.[0-9]+)?))?', 1)) AS nm,
    unnest(regexp_extract_all(summary, '([A-Za-z][A-Za-z0-9_\-]*)\s*[=:]\s*(-?[0-9]+(?:\.[0-9]+)?)\s*(%?)(?:\s*%?\s*-+>\s*(-?[0-9]+(?:\.[0-9]+)?))?', 2)) AS v,
    unnest(regexp_extract_all(summary, '([A-Za-z][A-Za-z0-9_\-]*)\s*[=:]\s*(-?[0-9]+(?:\.[0-9]+)?)\s*(%?)(?:\s*%?\s*-+>\s*(-?[0-9]+(?:\.[0-9]+)?))?', 4)) AS a,
    generate_subscripts(regexp_extract_all(summary, '([A-Za-z][A-Za-z0-9_\-]*)\s*[=:]\s*(-?[0-9]+(?:\.[0-9]+)?)\s*(%?)(?:\s*%?\s*-+>\s*(-?[0-9]+(?:\.[0-9]+)?))?', 1), 1) AS pos
  FROM logs
  UNION ALL
  SELECT event_id, 1, unnest(regexp_extract_all(summary, '\b([A-Za-z][A-Za-z0-9_]*)\s+(-?[0-9]+(?:\.[0-9]+)?)%(?:\s*%?\s*-+>\s*(-?[0-9]+(?:\.[0-9]+)?))?', 1)),
    unnest(regexp_extract_all(summary, '\b([A-Za-z][A-Za-z0-9_]*)\s+(-?[0-9]+(?:\.[0-9]+)?)%(?:\s*%?\s*-+>\s*(-?[0-9]+(?:\.[0-9]+)?))?', 2)),
    unnest(regexp_extract_all(summary, '\b([A-Za-z][A-Za-z0-9_]*)\s+(-?[0-9]+(?:\.[0-9]+)?)%(?:\s*%?\s*-+>\s*(-?[0-9]+(?:\.[0-9]+)?))?', 3)),
    generate_subscripts(regexp_extract_all(summary, '\b([A-Za-z][A-Za-z0-9_]*)\s+(-?[0-9]+(?:\.[0-9]+)?)%(?:\s*%?\s*-+>\s*(-?[0-9]+(?:\.[0-9]+)?))?', 1), 1)
  FROM logs),
metrics AS (
  SELECT event_id, name, arg_max(val, kind * 1000 + pos) AS value FROM (
    SELECT event_id, kind, pos, lower(nm) AS name,
      CAST(CASE WHEN a IS NULL OR a = '' THEN v ELSE a END AS DOUBLE) AS val FROM matches)
  WHERE name IN ('far','recall','precision','threshold','loss','final_train_loss','accuracy','requested','generated','mined','epochs')
  GROUP BY event_id, name),
steps AS (
  SELECT event_id, CASE WHEN iter = 'baseline' THEN 0
    ELSE coalesce(TRY_CAST(regexp_replace(iter, '[^0-9]', '', 'g') AS BIGINT), 0) END AS iteration FROM logs)"""


def events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        "event_id", "ts", "user_id", "event_type", "value",
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        F.col("value").cast("decimal(18,2)").cast("string").alias("vt"))


def logs(ev: DataFrame) -> DataFrame:
    """Loop log shape plus `event_id` and friends; works on streams and tables."""
    k, v, kind = F.col("k").cast("string"), F.col("vt"), F.col("event_type")
    rest = F.format_string("Recall %s%% and accuracy=%s -> 0.%s at noise=4, no loss", k, v, k)
    summary = (
        F.when(kind == "click", F.format_string("pass over, far : %s%% with Threshold = 0.%s", v, k))
        .when(kind == "view", F.format_string("after tuning Far %s%% --> %s.25%%, limit below 2%%", v, k))
        .when(kind == "purchase", F.format_string(
            "batch closed; requested:%s granted=9 generated= %s in all", k, v))
        .when(kind == "error", F.format_string("stopped at loss=%s, far %s%% then far=15%% in epochs : %s", v, k, k))
        .otherwise(rest))
    iteration = (
        F.when(kind == "click", F.lit("baseline"))
        .when(kind == "view", F.concat(F.lit("iter"), (F.col("k") % 7).cast("string")))
        .when(kind == "purchase", F.concat(F.lit("iter1-try"), (F.col("k") % 3).cast("string")))
        .when(kind == "error", F.lit("final")))
    return ev.select(
        "event_id", "ts", "user_id", "event_type", "value", "k",
        F.col("event_id").alias("seq"), iteration.alias("iter"), summary.alias("summary"),
        F.when(kind != "error", F.col("value")).alias("duration_sec"),
        F.struct(F.when(kind != "view", F.col("k").cast("double")).alias("input"),
                 (F.col("k") * 2).cast("double").alias("output"),
                 F.lit(None).cast("double").alias("cache_read"),
                 F.lit(None).cast("double").alias("cache_create")).alias("tokens"))


# ---- instruction pairs: conversations ---------------------------------------

PAIRS = """
turns AS (
  SELECT *, lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS next_role,
    lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS next_text FROM conversations),
pairs AS (
  SELECT conv_id, turn, text AS instruction, next_text AS response FROM turns
  WHERE role = 'user' AND next_role = 'assistant')"""


def pairs(spark: SparkSession, sf: str) -> DataFrame:
    """(conv_id, turn, instruction, response): a user turn and the reply right after.

    A self-join on (conv_id, turn + 1): no window over a conversation.
    """
    turns = table(spark, sf, "conversations")
    asked = turns.where(F.col("role") == "user").select(
        "conv_id", "turn", F.col("text").alias("instruction"))
    replies = turns.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("response"))
    return asked.join(replies, ["conv_id", "turn"])


# ---- vectors: embeddings, their frame tells real from candidate --------------

VECTORS = """
vectors AS (
  SELECT vec_id, embedding, CAST(label AS VARCHAR) AS label,
    CASE WHEN CAST(replace(source, 'src', '') AS BIGINT) < 10 THEN 'real' ELSE 'synthetic' END AS origin
  FROM embeddings LEFT JOIN documents ON vec_id = doc_id)"""


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Every vector, real or candidate by the version its document belongs to."""
    number = F.replace(F.col("source"), F.lit("src"), F.lit("")).cast("bigint")
    docs = table(spark, sf, "documents").select(
        F.col("doc_id").alias("vec_id"), number.alias("_v"))
    return table(spark, sf, "embeddings").join(docs, "vec_id", "left").select(
        "vec_id", "embedding", F.col("label").cast("string").alias("label"),
        F.when(F.col("_v") < 10, "real").otherwise("synthetic").alias("origin"))
