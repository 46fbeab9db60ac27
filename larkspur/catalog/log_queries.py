"""Logs, metrics and task states over `events`; replies over `conversations`."""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspur.catalog.base import EVENTS, PAIRS, events, logs, pairs, query, r6, table
from larkspur.functions.logtext import extract_metrics
from larkspur.functions.text import iteration_index
from larkspur.operators import evaluation, frames, scoring, telemetry, training

QUESTION = "Does this item show a {label} fault? Reply with JSON: present, confidence, reason."


@query("extract_metrics", f"WITH {EVENTS} SELECT event_id, name, value FROM metrics")
def _extract_metrics(spark, sf):
    return extract_metrics(logs(events(spark, sf)), ["event_id"], "summary")


@query("iteration_index", f"WITH {EVENTS} SELECT event_id, iteration FROM steps")
def _iteration_index(spark, sf):
    return logs(events(spark, sf)).select("event_id", iteration_index(F.col("iter")).alias("iteration"))


CONSOLE = EVENTS + """,
console AS (
  SELECT user_id AS task_id, event_id AS line_no, k, vt, event_type, CASE event_type
      WHEN 'click' THEN 'PROBE:uid=' || k || ' gid=' || event_id
      WHEN 'view' THEN 'x PROBE:card=' || CASE WHEN k % 5 = 0 THEN 'NONE (tool missing)' ELSE 'Model ' || k END
      WHEN 'purchase' THEN 'PROBE:ram=' || k || CASE WHEN k % 2 = 0 THEN 'M' ELSE 'G' END
      WHEN 'error' THEN 'PROBE:disk_found=' || CASE WHEN k % 3 = 0 THEN 'no' ELSE 'yes' END || ' disk_open=yes'
      ELSE 'step ' || vt END AS line
  FROM ev),
found AS (
  SELECT task_id, 'uid' AS key, CAST(k AS VARCHAR) AS value, line_no FROM console WHERE event_type = 'click'
  UNION ALL SELECT task_id, 'gid', CAST(line_no AS VARCHAR), line_no FROM console WHERE event_type = 'click'
  UNION ALL SELECT task_id, 'card', substr(line, 14), line_no FROM console WHERE event_type = 'view'
  UNION ALL SELECT task_id, 'ram', substr(line, 11), line_no FROM console WHERE event_type = 'purchase'
  UNION ALL SELECT task_id, 'disk_found', CASE WHEN k % 3 = 0 THEN 'no' ELSE 'yes' END, line_no FROM console WHERE event_type = 'error'
  UNION ALL SELECT task_id, 'disk_open', 'yes', line_no FROM console WHERE event_type = 'error'),
markers AS (SELECT task_id, key, arg_max(value, line_no) AS value FROM found GROUP BY 1, 2)"""


def console(spark, sf):
    k, kind = F.col("k"), F.col("event_type")
    ks = k.cast("string")
    line = (
        F.when(kind == "click", F.concat(F.lit("PROBE:uid="), ks, F.lit(" gid="), F.col("event_id").cast("string")))
        .when(kind == "view", F.concat(F.lit("x PROBE:card="), F.when(
            k % 5 == 0, F.lit("NONE (tool missing)")).otherwise(F.concat(F.lit("Model "), ks))))
        .when(kind == "purchase", F.concat(F.lit("PROBE:ram="), ks, F.when(k % 2 == 0, "M").otherwise("G")))
        .when(kind == "error", F.concat(F.lit("PROBE:disk_found="), F.when(
            k % 3 == 0, "no").otherwise("yes"), F.lit(" disk_open=yes")))
        .otherwise(F.concat(F.lit("step "), F.col("vt"))))
    return events(spark, sf).select(
        F.col("user_id").alias("task_id"), F.col("event_id").alias("line_no"), line.alias("line"))


@query("probe_markers", f"WITH {CONSOLE} SELECT task_id, key, value FROM markers")
def _probe_markers(spark, sf):
    return telemetry.probe_markers(console(spark, sf))


@query("expectation_report", f"""WITH {CONSOLE},
want AS (SELECT unnest(['card', 'disk_found', 'disk_open', 'ram', 'login_known', 'token_known']) AS key),
joined AS (SELECT t.task_id, w.key, m.value FROM (SELECT DISTINCT task_id FROM console) t CROSS JOIN want w
  LEFT JOIN markers m ON m.task_id = t.task_id AND m.key = w.key)
SELECT task_id, key, coalesce(value, '(not reported)') AS got,
  CASE WHEN CASE key WHEN 'card' THEN coalesce(value, '') <> '' AND upper(value) NOT LIKE '%NONE%'
    WHEN 'ram' THEN upper(coalesce(value, '')) LIKE '%G' OR upper(coalesce(value, '')) LIKE '%T'
    ELSE coalesce(value, '') = 'yes' END THEN 'PASS' ELSE 'FAIL' END AS verdict FROM joined""")
def _expectation_report(spark, sf):
    lines = console(spark, sf)
    tasks = lines.select("task_id").distinct()
    rules = {"card": "present", "ram": ">=1G"}
    wanted = [(k, rules.get(k, "yes"), f"see to {k}") for k in (
        "card", "disk_found", "disk_open", "ram", "login_known", "token_known")]
    report = telemetry.expectation_report(telemetry.probe_markers(lines), tasks, wanted)
    return report.select("task_id", "key", "got", "verdict")


@query("console_tail", f"""WITH {CONSOLE}
SELECT task_id, count(*) AS n_lines, string_agg(line, chr(10) ORDER BY line_no) AS tail FROM (
  SELECT *, row_number() OVER (PARTITION BY task_id ORDER BY line_no DESC) AS rn FROM console) WHERE rn <= 80 GROUP BY task_id""")
def _console_tail(spark, sf):
    return telemetry.console_tail(console(spark, sf))


@query("token_cost", f"""WITH {EVENTS}
SELECT iteration, count(*) AS entries, sum(coalesce(tok_in, 0) + tok_out) AS agent_tokens, round(sum(duration_sec), 2) AS gpu_seconds
FROM logs JOIN steps USING (event_id) GROUP BY iteration""")
def _token_cost(spark, sf):
    return telemetry.token_cost(logs(events(spark, sf))).withColumn("gpu_seconds", F.round("gpu_seconds", 2))


@query("last_scalar", """
SELECT user_id AS task_id, coalesce(TRY_CAST(arg_max(CASE WHEN event_id % 10 = 0 THEN 'abc' ELSE CAST(value AS VARCHAR) END, event_id)
  FILTER (event_type = 'purchase') AS DOUBLE), 0.0) AS score FROM events GROUP BY user_id""")
def _last_scalar(spark, sf):
    ev = table(spark, sf, "events")
    points = ev.select(
        F.col("user_id").alias("task_id"), F.lit("train").alias("title"), F.col("event_type").alias("series"),
        F.col("event_id").alias("iteration"),
        F.when(F.col("event_id") % 10 == 0, "abc").otherwise(F.col("value").cast("string")).alias("value"))
    return telemetry.last_scalar(points, ev.select(F.col("user_id").alias("task_id")).distinct(), "purchase")


@query("kpi_vs_target", f"""WITH {EVENTS},
kpi AS (SELECT name AS series, iteration, arg_max(value, event_id) AS value FROM metrics JOIN steps USING (event_id) GROUP BY 1, 2)
SELECT series, iteration, value, target, CASE WHEN low THEN value <= target ELSE value >= target END AS reached
FROM kpi JOIN (VALUES ('far', 20.0::DOUBLE, true), ('recall', 50.0::DOUBLE, false), ('loss', 5.0::DOUBLE, true)) t(series, target, low) USING (series)""")
def _kpi_vs_target(spark, sf):
    log = logs(events(spark, sf)).withColumn("iteration", iteration_index(F.col("iter")))
    points = extract_metrics(log, ["seq", "iteration"], "summary").withColumnRenamed("name", "series")
    targets = spark.createDataFrame(
        [("far", 20.0, True), ("recall", 50.0, False), ("loss", 5.0, True)],
        "series string, target double, lower_is_better boolean")
    return telemetry.kpi_vs_target(points, targets)


@query("epoch_loss", f"""WITH {EVENTS}
SELECT user_id, CAST(dayofmonth(ts) AS INTEGER) AS epoch, CAST(sum(k) AS BIGINT) AS samples,
  round(CAST(sum(CAST(value AS DECIMAL(24, 9)) * CAST(k AS DECIMAL(10, 0))) AS DOUBLE) / greatest(sum(k), 1), 6) AS mean_loss FROM ev GROUP BY 1, 2""")
def _epoch_loss(spark, sf):
    rows = events(spark, sf).withColumn("epoch", F.dayofmonth("ts"))
    return evaluation.epoch_loss(rows, "epoch", "value", "k", ["user_id"]).withColumn("mean_loss", r6("mean_loss"))


STATUS = """
st AS (
  SELECT user_id AS task_id, event_id, ts, CASE event_type WHEN 'click' THEN 'queued' WHEN 'view' THEN 'running'
    WHEN 'signup' THEN CASE WHEN event_id % 3 = 0 THEN NULL ELSE 'running' END WHEN 'purchase' THEN 'completed' ELSE 'failed' END AS status FROM events)"""


def states(spark, sf):
    e = F.col("event_type")
    status = (F.when(e == "click", "queued").when((e == "signup") & (F.col("event_id") % 3 == 0), F.lit(None))
              .when(e.isin("view", "signup"), "running")
              .when(e == "purchase", "completed").otherwise("failed"))
    return table(spark, sf, "events").select(
        F.col("user_id").alias("task_id"), "event_id", "ts", status.alias("status"))


@query("status_transitions", f"""WITH {STATUS},
p AS (SELECT *, lag(status) OVER (PARTITION BY task_id ORDER BY ts, event_id) AS previous_status FROM st)
SELECT *, status IN ('completed', 'failed') AS terminal, status = 'failed' AS failure FROM p
WHERE status IS DISTINCT FROM previous_status""")
def _status_transitions(spark, sf):
    return telemetry.status_transitions(states(spark, sf), ["ts", "event_id"], F.to_date("ts"))


@query("terminal_report", f"""WITH {STATUS}, {CONSOLE.strip()},
e AS (SELECT task_id, min(ts) AS started, min(ts) FILTER (status IN ('completed', 'failed')) AS ended,
  arg_min(status, ts) FILTER (status IN ('completed', 'failed')) AS status FROM st GROUP BY task_id),
tails AS (SELECT task_id, string_agg(line, chr(10) ORDER BY line_no) AS tail FROM (
  SELECT *, row_number() OVER (PARTITION BY task_id ORDER BY line_no DESC) AS rn FROM console) WHERE rn <= 40 GROUP BY task_id)
SELECT task_id, status, ended, CAST(floor((epoch_us(ended) - epoch_us(started)) / 1000000) AS BIGINT) AS seconds,
  status <> 'completed' AS failure, CASE WHEN status <> 'completed' THEN tail END AS tail
FROM e LEFT JOIN tails USING (task_id) WHERE status IS NOT NULL""")
def _terminal_report(spark, sf):
    tails = telemetry.console_tail(console(spark, sf), 40)
    return telemetry.terminal_report(states(spark, sf), "ts", tails)


# ---- replies and chats ------------------------------------------------------


VERDICTS = PAIRS + """,
replies AS (
  SELECT conv_id, turn, length(response) AS n, CASE length(response) % 5
    WHEN 0 THEN 'ok: {"present": true, "confidence": 0.' || (length(response) % 10) || ', "reason": "seen"} bye'
    WHEN 1 THEN CASE WHEN length(response) % 2 = 0 THEN '{"present": true, "confidence": "0.7"}' ELSE '{"present": true, "confidence": "high"}' END
    WHEN 2 THEN CASE length(response) % 4 WHEN 0 THEN '{"present": true, "confidence": "NaN"}'
      WHEN 1 THEN '{"present": true, "confidence": 1.5}' ELSE '{"present": "false", "confidence": 0.9}' END
    WHEN 3 THEN response ELSE '{"present": true, "confidence": ' END AS text
  FROM pairs)"""


def replies(spark, sf):
    n = F.char_length("response")
    text = (
        F.when(n % 5 == 0, F.concat(F.lit('ok: {"present": true, "confidence": 0.'), (n % 10).cast("string"),
                                    F.lit(', "reason": "seen"} bye')))
        .when((n % 5 == 1) & (n % 2 == 0), '{"present": true, "confidence": "0.7"}')
        .when(n % 5 == 1, '{"present": true, "confidence": "high"}')
        .when((n % 5 == 2) & (n % 4 == 0), '{"present": true, "confidence": "NaN"}')
        .when((n % 5 == 2) & (n % 4 == 1), '{"present": true, "confidence": 1.5}')
        .when(n % 5 == 2, '{"present": "false", "confidence": 0.9}')
        .when(n % 5 == 3, F.col("response")).otherwise('{"present": true, "confidence": '))
    return pairs(spark, sf).select("conv_id", "turn", text.alias("text"))


@query("judge_gate", f"""WITH {VERDICTS}
SELECT conv_id, turn, n % 5 = 0 OR n % 10 = 6 AS present, n % 5 IN (3, 4) OR n % 10 = 1 OR (n % 5 = 2 AND n % 4 < 2) AS error, (n % 5 = 0 AND n % 10 >= 6) OR n % 10 = 6 AS accepted FROM replies""")
def _judge_gate(spark, sf):
    return scoring.judge_gate(replies(spark, sf)).select("conv_id", "turn", "present", "error", "accepted")


@query("parse_verdict", f"""WITH {VERDICTS}
SELECT conv_id, turn, CASE n % 5 WHEN 0 THEN CAST('0.' || (n % 10) AS DOUBLE) WHEN 1 THEN CASE WHEN n % 2 = 0 THEN 0.7::DOUBLE ELSE 0.0::DOUBLE END WHEN 2 THEN CASE WHEN n % 4 < 2 THEN 0.0 ELSE 0.9 END::DOUBLE ELSE 0.0::DOUBLE END AS confidence,
  CASE n % 5 WHEN 0 THEN 'seen' WHEN 1 THEN CASE WHEN n % 2 = 0 THEN '' ELSE 'malformed JSON: ' || text END WHEN 3 THEN 'no JSON in reply: ' || trim(substr(text, 1, 120), E' \\t\\n')
    WHEN 2 THEN CASE WHEN n % 4 < 2 THEN 'malformed JSON: ' || text ELSE '' END
    WHEN 4 THEN 'no JSON in reply: ' || trim(text, ' ') ELSE '' END AS reason FROM replies""")
def _parse_verdict(spark, sf):
    return scoring.judge_gate(replies(spark, sf)).select("conv_id", "turn", "confidence", "reason")


@query("judge_requests", f"""WITH {PAIRS}
SELECT conv_id, turn, '{{"question":"Does this item show a lang fr fault? Reply with JSON: present, confidence, reason.","image_url":"data:image/jpeg;base64,'
  || to_base64(encode(instruction)) || '"}}' AS request FROM pairs""")
def _judge_requests(spark, sf):
    rows = pairs(spark, sf).withColumns({"label": F.lit("lang_fr"), "uri": F.lit("a/b.jpg")})
    image = F.replace(F.base64(F.encode("instruction", "utf-8")), F.lit("\r\n"), F.lit(""))
    return frames.judge_requests(rows, QUESTION, F.unbase64(image)).select(
        "conv_id", "turn", F.replace("request", F.lit("\\r\\n"), F.lit("")).alias("request"))


@query("marker_hits", f"WITH {PAIRS} SELECT conv_id, turn, contains(response, 'en') AS hit FROM pairs")
def _marker_hits(spark, sf):
    return evaluation.marker_hits(pairs(spark, sf), "en", "response").select("conv_id", "turn", "hit")


@query("marker_rate", f"""WITH {PAIRS}
SELECT count(*) AS n, count(*) FILTER (contains(response, 'ion')) AS hits,
  round(count(*) FILTER (contains(response, 'ion')) / greatest(count(*), 1), 3) AS rate FROM pairs""")
def _marker_rate(spark, sf):
    return evaluation.marker_rate(pairs(spark, sf), "ion", text="response")


@query("marker_rate_first", f"""WITH {PAIRS}, f AS (SELECT * FROM pairs ORDER BY conv_id, turn LIMIT 8)
SELECT count(*) AS n, count(*) FILTER (contains(response, 'ion')) AS hits,
  round(count(*) FILTER (contains(response, 'ion')) / greatest(count(*), 1), 3) AS rate FROM f""")
def _marker_rate_first(spark, sf):
    return evaluation.marker_rate(pairs(spark, sf), "ion", ["conv_id", "turn"],
                                  evaluation.PERSONA_SAMPLE, "response")


@query("render_chat", """
SELECT conv_id, string_agg('<|' || role || '|>' || chr(10) || text || chr(10), '' ORDER BY turn) || '<|assistant|>' AS text
FROM conversations GROUP BY conv_id""")
def _render_chat(spark, sf):
    return training.render_chat(table(spark, sf, "conversations"), ["conv_id"], generation_prompt="<|assistant|>")


@query("truncate_tokens", r"""
WITH t AS (SELECT doc_id, text, list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '') AS w FROM documents)
SELECT doc_id, len(w) AS n_tokens, len(w) > 512 AS truncated,
  md5(CASE WHEN len(w) > 512 THEN regexp_extract(text, '^\s*(?:\S+\s+){511}\S+') ELSE text END) AS text_md5 FROM t""")
def _truncate_tokens(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return training.truncate_tokens(docs, 512).select(
        "doc_id", "n_tokens", "truncated", F.md5("text").alias("text_md5"))


@query("repeat_examples", f"WITH {PAIRS} SELECT conv_id, turn, r AS repeat FROM pairs, (SELECT unnest([1, 2, 3]) AS r)")
def _repeat_examples(spark, sf):
    return training.repeat_examples(pairs(spark, sf), 3).select("conv_id", "turn", "repeat")


@query("step_plan", f"""WITH {PAIRS}
SELECT conv_id, count(*) AS rows, CAST(ceil(ceil(count(*) / 4.0) * 10) AS BIGINT) AS steps FROM pairs GROUP BY conv_id""")
def _step_plan(spark, sf):
    sizes = pairs(spark, sf).groupBy("conv_id").agg(F.count(F.lit(1)).alias("rows"))
    return training.step_plan(sizes, 10, 1, 4)
