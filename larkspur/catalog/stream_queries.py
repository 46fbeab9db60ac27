"""The streams, fed from the given tables and checked against batch SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspur.catalog.base import EVENTS, logs, query
from larkspur.plans.shared import scratch_path
from larkspur.streaming import jobs

EVENT_SCHEMA = ("event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
                "value double, props string")


def event_stream(spark, sf):
    raw = jobs.read_stream(spark, f"{sf}/events.parquet*", EVENT_SCHEMA, "parquet")
    return raw.select(
        "event_id", "ts", "user_id", "event_type", "value",
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        F.col("value").cast("decimal(18,2)").cast("string").alias("vt"))


POINTS = EVENTS + """,
points AS (
  SELECT event_id AS seq, iteration, 'kpi' AS title, upper(name) AS series, value FROM metrics JOIN steps USING (event_id)
  UNION ALL SELECT event_id, iteration, 'cost', 'gpu_seconds', duration_sec FROM logs JOIN steps USING (event_id) WHERE duration_sec IS NOT NULL
  UNION ALL SELECT event_id, iteration, 'cost', 'agent_tokens', coalesce(tok_in, 0) + tok_out FROM logs JOIN steps USING (event_id)
    WHERE coalesce(tok_in, 0) + tok_out <> 0)"""


@query("mirror_log_stream", f"WITH {POINTS} SELECT seq, iteration, title, series, value FROM points")
def _mirror_log_stream(spark, sf):
    base = scratch_path(spark, "mirror")
    log = logs(event_stream(spark, sf)).select("seq", "iter", "summary", "duration_sec", "tokens")
    jobs.mirror_log(log, f"{base}/points", f"{base}/mark-1")
    # a second replay of the same log, with no memory of the first, adds nothing
    return jobs.mirror_log(log, f"{base}/points", f"{base}/mark-2")


@query("scalar_stream", """
SELECT user_id AS task_id, event_type AS series, event_id AS step, value FROM events WHERE event_type <> 'error'""")
def _scalar_stream(spark, sf):
    base = scratch_path(spark, "scalars")
    records = event_stream(spark, sf).select(
        F.col("user_id").alias("task_id"), F.col("event_type").alias("series"), F.col("event_id").alias("step"),
        F.when(F.col("event_type") == "error", "n/a").otherwise(F.col("value").cast("string")).alias("value"))
    return jobs.scalar_stream(records, f"{base}/points", f"{base}/mark")


@query("stage_report_stream", f"""WITH {EVENTS},
m AS (SELECT event_id, iteration, name, value, event_type = 'error' AS failed FROM metrics JOIN steps USING (event_id) JOIN ev_ USING (event_id))
SELECT event_id, iteration, failed, 'stage' AS title, name AS series, value FROM m
UNION ALL SELECT event_id, iteration, failed, 'kpi', upper(name), value FROM m WHERE name IN ('far', 'recall', 'final_train_loss', 'loss')
UNION ALL SELECT event_id, iteration, event_type = 'error', 'cost', 'gpu_seconds', duration_sec FROM logs JOIN steps USING (event_id)
  WHERE event_id IN (SELECT event_id FROM metrics)
UNION ALL SELECT event_id, iteration, event_type = 'error', 'duration', 'duration_sec', duration_sec FROM logs JOIN steps USING (event_id)
""".replace("JOIN ev_ USING (event_id)", "JOIN (SELECT event_id, event_type FROM ev) USING (event_id)"))
def _stage_report_stream(spark, sf):
    base = scratch_path(spark, "stages")
    records = logs(event_stream(spark, sf)).select(
        "event_id", "iter", F.when(F.col("event_type") == "error", "failed").otherwise("ok").alias("status"),
        "duration_sec", F.col("summary").alias("output"))
    return jobs.stage_report_stream(records, f"{base}/points", f"{base}/mark", ["event_id"])


@query("running_gap", """
SELECT event_type AS label, count(*) AS have, CAST(2000 AS BIGINT) AS target, CAST(greatest(2000 - count(*), 0) AS BIGINT) AS short,
  count(*) >= 2000 AS at_target FROM events GROUP BY 1""")
def _running_gap(spark, sf):
    base = scratch_path(spark, "gap")
    labels = event_stream(spark, sf).select(F.col("event_type").alias("label"))
    return jobs.running_gap(labels, f"{base}/passes", f"{base}/mark", 2000)
