"""Similarity and probes over `embeddings`; registry questions over `orders`."""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspur.catalog.base import VECTORS, query, r6, table, vectors
from larkspur.operators import evaluation, registry, similarity, telemetry, training
from larkspur.operators.gap import allocate_budget, gap_report
from larkspur.plans import rounds as loop
from larkspur.plans.shared import cut, scratch_path
from larkspur.plans.vector_index import VectorIndex, recall_of
from larkspur.plans.versions import VersionStore

# ---- similarity -------------------------------------------------------------

NEAR = VECTORS + """,
c AS (SELECT vec_id, label, origin, embedding::DOUBLE[] AS e FROM vectors),
sims AS (SELECT a.vec_id, b.vec_id AS ref, a.label, b.label AS ref_label, b.origin AS ref_origin, a.origin,
    round(list_cosine_similarity(a.e, b.e), 9) AS s FROM c a JOIN c b ON a.vec_id <> b.vec_id)"""


def parts(spark, sf):
    v = vectors(spark, sf)
    return v.where(F.col("origin") == "synthetic"), v.where(F.col("origin") == "real")


def scored(spark, sf):
    made, real = parts(spark, sf)
    return similarity.nn_score(made, real, "label", "vec_id", "embedding")


@query("nn_score", f"""WITH {NEAR},
best AS (SELECT vec_id, max(s) AS s, arg_max(ref, s * 1000000000 - ref / 1000000000.0) AS r FROM sims
  WHERE origin = 'synthetic' AND ref_origin = 'real' AND label = ref_label GROUP BY vec_id)
SELECT v.vec_id, v.label, round(s, 6) AS nn_score FROM vectors v LEFT JOIN best USING (vec_id) WHERE v.origin = 'synthetic'""")
def _nn_score(spark, sf):
    return scored(spark, sf).select("vec_id", "label", r6("nn_score").alias("nn_score"))


@query("mine_similar", f"""WITH {NEAR}
SELECT vec_id AS query_id, CAST(rn AS INTEGER) AS rank, ref AS match_id, round(s, 6) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, ref) AS rn FROM sims
  WHERE origin = 'synthetic' AND ref_origin = 'real') WHERE rn <= 5""")
def _mine_similar(spark, sf):
    made, real = parts(spark, sf)
    return similarity.mine_similar(made, real, "vec_id", "embedding", 5).withColumn("score", r6("score"))


@query("nn_score_indexed", f"""WITH {NEAR},
best AS (SELECT vec_id, max(s) AS s FROM sims WHERE origin = 'synthetic' AND ref_origin = 'real' AND label = ref_label GROUP BY vec_id)
SELECT v.vec_id, v.label, round(s, 6) AS nn_score FROM vectors v LEFT JOIN best USING (vec_id) WHERE v.origin = 'synthetic'""")
def _nn_score_indexed(spark, sf):
    """Cells first, then every cell that the angles do not rule out: the exact scores."""
    made, real = parts(spark, sf)
    index = VectorIndex.build(real, "vec_id", "embedding", "label")
    return similarity.nn_score_indexed(made, index, exact=True).select("vec_id", "label", r6("nn_score").alias("nn_score"))


def every_fiftieth(spark, sf):
    """The stated query set: vectors whose id is divisible by 50, against all rows."""
    rows = table(spark, sf, "embeddings").select("vec_id", "embedding")
    return rows.where(F.col("vec_id") % 50 == 0), rows


FIFTIETH = """
e AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
sims AS (SELECT a.vec_id, b.vec_id AS ref, round(list_cosine_similarity(a.e, b.e), 9) AS s
  FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0)"""


@query("mine_similar_indexed", f"""WITH {FIFTIETH}
SELECT vec_id AS query_id, CAST(rn AS INTEGER) AS rank, ref AS match_id, round(s, 6) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, ref) AS rn FROM sims) WHERE rn <= 5""")
def _mine_similar_indexed(spark, sf):
    asking, rows = every_fiftieth(spark, sf)
    index = VectorIndex.build(rows, "vec_id", "embedding")
    return similarity.mine_similar_indexed(asking, index, 5, exact=True).withColumn("score", r6("score"))


@query("vector_index_recall", """SELECT count(*) AS queries, 5 * count(*) AS links, true AS nine_in_ten FROM embeddings WHERE vec_id % 50 = 0""")
def _vector_index_recall(spark, sf):
    """How many of the five nearest the index finds without its exact end, measured against all rows."""
    asking, rows = every_fiftieth(spark, sf)
    index = VectorIndex.build(rows, "vec_id", "embedding")
    found = similarity.mine_similar_indexed(asking, index, 5)
    measured = recall_of(found, similarity.mine_similar(asking, rows, "vec_id", "embedding", 5))
    return measured.select("queries", "links", (F.col("recall") >= 0.9).alias("nine_in_ten"))


# ---- predictions: the label of the nearest real vector of any class ----------

PRED = NEAR + """,
preds AS (
  SELECT vec_id, label, ref_label AS pred, s FROM (
    SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, ref) AS rn FROM sims
    WHERE origin = 'synthetic' AND ref_origin = 'real') WHERE rn = 1)"""


def predictions(spark, sf):
    made, real = parts(spark, sf)
    near = similarity.mine_similar(made, real, "vec_id", "embedding", 1)
    known = vectors(spark, sf).select("vec_id", "label")
    return (near.join(known.select(F.col("vec_id").alias("query_id"), "label"), "query_id")
            .join(known.select(F.col("vec_id").alias("match_id"), F.col("label").alias("pred")), "match_id")
            .select(F.col("query_id").alias("vec_id"), "label", "pred", "score"))


@query("accuracy", f"""WITH {PRED}
SELECT label, count(*) AS n, count(*) FILTER (label = pred) AS correct,
  round(count(*) FILTER (label = pred) / count(*), 6) AS accuracy FROM preds GROUP BY label""")
def _accuracy(spark, sf):
    return evaluation.accuracy(predictions(spark, sf), ["label"]).withColumn("accuracy", r6("accuracy"))


@query("class_report", f"""WITH {PRED},
labels_ AS (SELECT label FROM preds UNION SELECT pred FROM preds),
k AS (SELECT l.label, (SELECT count(*) FROM preds p WHERE p.label = l.label AND p.pred = l.label) AS tp,
  (SELECT count(*) FROM preds p WHERE p.pred = l.label) AS predicted,
  (SELECT count(*) FROM preds p WHERE p.label = l.label) AS support FROM labels_ l),
r AS (SELECT label, coalesce(tp / nullif(predicted, 0), 0) AS precision, coalesce(tp / nullif(support, 0), 0) AS recall,
  coalesce(2.0 * tp / nullif(predicted + support, 0), 0) AS f1, support FROM k),
u AS (SELECT * FROM r UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM r
  UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
    sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM r)
SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM u""")
def _class_report(spark, sf):
    out = evaluation.class_report(predictions(spark, sf))
    return out.withColumns({c: r6(c) for c in ("precision", "recall", "f1")})


@query("overkill_at_full_recall", f"""WITH {PRED},
d AS (SELECT label = '0' AS clean, 1 - CASE WHEN pred = '0' THEN s ELSE -s END AS ds FROM preds),
t AS (SELECT min(ds) FILTER (NOT clean) AS threshold FROM d)
SELECT round(threshold, 6) AS threshold, count(*) FILTER (clean) AS n_clean,
  round(count(*) FILTER (clean AND ds >= threshold) / count(*) FILTER (clean), 6) AS overkill,
  round(100.0 / count(*) FILTER (clean), 6) AS resolution_percent FROM d, t GROUP BY threshold""")
def _overkill(spark, sf):
    p = predictions(spark, sf).withColumn("p_clean", F.when(
        F.col("pred") == "0", F.col("score")).otherwise(-F.col("score")))
    out = evaluation.overkill_at_full_recall(p, "0")
    return out.withColumns({c: r6(c) for c in ("threshold", "overkill", "resolution_percent")})


@query("metric_resolution", f"""WITH {PRED},
a AS (SELECT label, count(*) AS n, count(*) FILTER (label = pred) / count(*) AS accuracy FROM preds GROUP BY label),
w AS (SELECT *, 1.0 / n AS step, accuracy - lag(accuracy) OVER (ORDER BY label) AS change FROM a)
SELECT label, n, round(accuracy, 6) AS accuracy, round(step, 6) AS step, round(change, 6) AS change,
  abs(change) <= step + 1e-12 AS within_one_step FROM w""")
def _metric_resolution(spark, sf):
    acc = evaluation.accuracy(predictions(spark, sf), ["label"])
    out = evaluation.metric_resolution(acc, "label").drop("correct")
    return out.withColumns({c: r6(c) for c in ("accuracy", "step", "change")})


@query("train_probe")
def _train_probe(spark, sf):
    rows = vectors(spark, sf).withColumn("uri", F.col("vec_id").cast("string"))
    split = cut(training.stratified_split(rows))
    preds = training.train_probe(split, "embedding", keep=["vec_id"], clean="0")
    return preds.select("vec_id", "label", "pred", r6("p_clean").alias("p_clean"))


def loop_tables(spark, sf):
    """Vectors of real documents start the dataset; the others are the pool."""
    v = vectors(spark, sf).select(
        F.col("vec_id").alias("item_id"), "label", "origin",
        F.concat(F.lit("/vec/"), F.col("vec_id").cast("string")).alias("uri"),
        F.col("embedding").alias("vector"))
    real = v.where(F.col("origin") == "real")
    pool = v.where(F.col("origin") == "synthetic").withColumn(
        "defect_type", F.concat(F.lit("t+"), "label")).drop("origin")
    return real, pool


@query("enrichment_round")
def _enrichment_round(spark, sf):
    real, pool = loop_tables(spark, sf)
    from larkspur.operators.frames import frame_meta, make_frames
    store = VersionStore(spark, scratch_path(spark, "rounds"))
    first = real.withColumns({"labels": F.array("label"), "run_id": F.lit(None).cast("string")})
    store.publish("vectors", "v1-real", make_frames(frame_meta(first)))
    top = store.label_counts(store.latest("vectors")["version_id"]).agg(F.max("have")).collect()[0][0]
    history = loop.run_rounds(store, "vectors", real, pool, 2, 40, int(top) + 5)
    return history.drop("version_id")


SEARCH = NEAR + """,
have AS (SELECT label, count(*) AS have FROM vectors WHERE origin = 'real' GROUP BY 1),
weighted AS (SELECT label, 't+' || label AS defect_type, max(have) OVER () + 5 - have AS w FROM have
  WHERE label IN (SELECT label FROM vectors WHERE origin = 'synthetic')),
ranked AS (SELECT *, count(*) OVER () AS n, sum(w) OVER () AS total, row_number() OVER (ORDER BY w DESC, defect_type) AS rk FROM weighted),
exact AS (SELECT *, CASE WHEN 40 > n THEN (40 - n) * w / CAST(total AS DOUBLE) ELSE 0.0 END AS ex FROM ranked),
placed AS (SELECT *, floor(ex) AS fl, (40 - n) - sum(floor(ex)) OVER () AS left_,
  row_number() OVER (ORDER BY ex - floor(ex) DESC, defect_type) AS ord FROM exact),
alloc AS (SELECT defect_type, label, CAST(CASE WHEN 40 <= n THEN CASE WHEN rk <= 40 THEN 1 ELSE 0 END
  ELSE 1 + fl + CASE WHEN ord <= left_ THEN 1 ELSE 0 END END AS BIGINT) AS asked FROM placed),
pool AS (SELECT vec_id, label, 't+' || label AS defect_type, '/vec/' || vec_id AS uri,
  (SELECT max(s) FROM sims WHERE sims.vec_id = v.vec_id AND ref_origin = 'real' AND ref_label = v.label) AS score
  FROM vectors v WHERE origin = 'synthetic'),
turns AS (SELECT pool.*, asked, row_number() OVER (PARTITION BY defect_type ORDER BY md5('s-1:' || uri), 's-1:' || uri) - 1 AS turn
  FROM pool JOIN alloc USING (defect_type, label)),
tries AS (SELECT *, turn // asked AS attempt, defect_type || '#' || (turn % asked) AS slot FROM turns WHERE turn < 3 * asked),
bar AS (SELECT coalesce(median(score), 0) AS thr FROM tries WHERE attempt = 0),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY slot ORDER BY score DESC, attempt) AS rn FROM tries WHERE score IS NOT NULL) WHERE rn = 1),
quotas AS (SELECT label, sum(asked) AS quota FROM alloc GROUP BY 1),
kept AS (SELECT * FROM (SELECT b.* EXCLUDE (rn), row_number() OVER (PARTITION BY label ORDER BY score DESC, md5(slot || ':' || attempt)) AS pos
  FROM best b, bar WHERE score >= thr) JOIN quotas USING (label) WHERE pos <= quota),
owed AS (SELECT q.label, q.quota - count(k.slot) AS owed FROM quotas q LEFT JOIN kept k USING (label) GROUP BY q.label, q.quota),
extra AS (SELECT * FROM (SELECT t.*, row_number() OVER (PARTITION BY label ORDER BY score DESC, md5(slot || ':' || attempt)) AS pos
  FROM tries t, bar WHERE score >= thr AND (slot, attempt) NOT IN (SELECT (slot, attempt) FROM best)) JOIN owed USING (label) WHERE pos <= owed),
filled AS (SELECT label, slot, attempt, vec_id, score, 'kept' AS picked FROM kept
  UNION ALL SELECT label, slot, attempt, vec_id, score, 'topped_up' FROM extra),
still AS (SELECT q.label, q.quota - count(f.slot) AS owed FROM quotas q LEFT JOIN filled f USING (label) GROUP BY q.label, q.quota),
fresh AS (SELECT * FROM (SELECT p.*, row_number() OVER (PARTITION BY label ORDER BY md5('s-1:again:' || uri), uri) AS turn
  FROM pool p WHERE vec_id NOT IN (SELECT vec_id FROM tries)) JOIN still USING (label) WHERE turn <= 2 * owed),
regen AS (SELECT * FROM (SELECT f.*, row_number() OVER (PARTITION BY label ORDER BY score DESC, md5(uri), uri) AS pos FROM fresh f, bar WHERE score >= thr)
  WHERE pos <= owed)"""


@query("search_round", f"""WITH {SEARCH},
shown AS (SELECT * FROM filled
  UNION ALL SELECT label, slot, attempt, vec_id, score, NULL FROM best WHERE (slot, attempt) NOT IN (SELECT (slot, attempt) FROM filled)
  UNION ALL SELECT label, 'again#' || label || '#' || uri, 0, vec_id, score, 'regenerated' FROM regen)
SELECT label, slot, attempt, vec_id AS item_id, round(score, 6) AS nn_score, picked,
  CASE WHEN slot LIKE 'again%' OR attempt = 0 THEN NULL WHEN attempt = 1 THEN 4.0 ELSE 10.0 END::DOUBLE AS guidance FROM shown""")
def _search_round(spark, sf):
    """One round's search with two grid rounds: best attempts, filter, top-up and what is drawn again."""
    real, pool = (cut(t) for t in loop_tables(spark, sf))
    have = real.groupBy("label").agg(F.count(F.lit(1)).alias("have"))
    target = have.agg(F.max("have") + 5).collect()[0][0]
    split = cut(allocate_budget(gap_report(have, int(target)), pool.select("defect_type").distinct(), 40))
    steps = loop.Steps(spark, scratch_path(spark, "search"))
    found = loop.search_samples(steps, "s-1", real, pool, split, "s-1", loop.default_grid(spark, 2))
    return found.select("label", "slot", "attempt", "item_id", r6("nn_score").alias("nn_score"), "picked", "guidance")


# ---- registry: orders -------------------------------------------------------

MODELS = """
models AS (SELECT 'm' || o_orderkey AS model_id, o_orderpriority AS name, o_orderstatus AS tag,
  o_orderdate AS created, o_custkey AS task_id, o_orderkey AS ordinal FROM orders)"""


def models(spark, sf):
    return table(spark, sf, "orders").select(
        F.concat(F.lit("m"), F.col("o_orderkey").cast("string")).alias("model_id"),
        F.col("o_orderpriority").alias("name"), F.array("o_orderstatus", "o_orderpriority").alias("tags"),
        F.col("o_orderdate").alias("created"), F.col("o_custkey").alias("task_id"),
        F.col("o_orderkey").alias("ordinal"))


TAGGED = MODELS + """,
tags AS (SELECT tag, model_id, created FROM models UNION ALL SELECT name, model_id, created FROM models),
newest AS (SELECT tag, arg_max(model_id, (epoch_us(created), model_id)) AS model_id FROM tags GROUP BY tag),
inst AS (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'F' WHEN 1 THEN '1-URGENT' WHEN 2 THEN c_mktsegment END AS tag FROM customer)"""


def instances(spark, sf):
    k = F.col("c_custkey") % 4
    tag = F.when(k == 0, "F").when(k == 1, "1-URGENT").when(k == 2, F.col("c_mktsegment"))
    return table(spark, sf, "customer").select("c_custkey", tag.alias("tag"))


@query("resolve_by_tag", f"WITH {TAGGED} SELECT c_custkey, tag, model_id FROM inst LEFT JOIN newest USING (tag)")
def _resolve_by_tag(spark, sf):
    return registry.resolve_by_tag(instances(spark, sf), models(spark, sf)).select("c_custkey", "tag", "model_id")


@query("unresolved_tags", f"WITH {TAGGED} SELECT c_custkey, tag FROM inst WHERE tag IS NULL OR tag NOT IN (SELECT tag FROM tags)")
def _unresolved_tags(spark, sf):
    return registry.unresolved_tags(instances(spark, sf), models(spark, sf)).select("c_custkey", "tag")


@query("missing_required", "SELECT c_name AS name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def _missing_required(spark, sf):
    c = table(spark, sf, "customer")
    have = c.join(table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_semi")
    return registry.missing_required(c.select(F.col("c_name").alias("name")), have.select(F.col("c_name").alias("name")))


@query("queue_activity", """
WITH recent AS (SELECT * FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1000),
n AS (SELECT c_nationkey, count(*) AS recent_tasks FROM recent JOIN customer ON o_custkey = c_custkey GROUP BY 1)
SELECT n_nationkey AS queue_id, n_name AS name, coalesce(recent_tasks, 0) AS recent_tasks, coalesce(recent_tasks, 0) > 0 AS active
FROM nation LEFT JOIN n ON n_nationkey = c_nationkey""")
def _queue_activity(spark, sf):
    owners = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("queue_id"))
    tasks = table(spark, sf, "orders").join(owners, "o_custkey").select(
        F.col("o_orderkey").alias("task_id"), F.col("o_orderdate").alias("last_update"), "queue_id")
    queues = table(spark, sf, "nation").select(F.col("n_nationkey").alias("queue_id"), F.col("n_name").alias("name"))
    return telemetry.queue_activity(tasks, queues)


@query("latest_task", """
SELECT name, arg_max(task_id, (done, ts, task_id)) AS task_id, arg_max(status, (done, ts, task_id)) AS status FROM (
  SELECT c_name AS name, o_orderkey AS task_id, epoch_us(o_orderdate) AS ts,
    CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'running' ELSE 'queued' END AS status,
    CASE o_orderstatus WHEN 'F' THEN 1 ELSE 0 END AS done
  FROM orders JOIN customer ON o_custkey = c_custkey) GROUP BY name""")
def _latest_task(spark, sf):
    owners = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("name"))
    s = F.col("o_orderstatus")
    tasks = table(spark, sf, "orders").join(owners, "o_custkey").select(
        "name", F.col("o_orderkey").alias("task_id"), F.col("o_orderdate").alias("last_update"),
        F.when(s == "F", "completed").when(s == "O", "running").otherwise("queued").alias("status"))
    return registry.latest_task(tasks, "^Customer#[0-9]+$")


@query("top_trials", """
SELECT user_id AS task_id, round(arg_max(value, event_id), 6) AS score FROM events WHERE event_type = 'view' GROUP BY 1
ORDER BY arg_max(value, event_id), 1 LIMIT 3""")
def _top_trials(spark, sf):
    ev = table(spark, sf, "events").where(F.col("event_type") == "view")
    points = ev.select(F.col("user_id").alias("task_id"), F.lit("train").alias("title"), F.lit("loss").alias("series"),
                       F.col("event_id").alias("iteration"), "value")
    tasks = points.select("task_id").distinct()
    return registry.top_trials(telemetry.last_scalar(points, tasks, "loss")).withColumn("score", r6("score"))


@query("champion", f"""WITH {MODELS},
s AS (SELECT c_nationkey, o_custkey AS task_id, max(o_totalprice) AS score, CASE WHEN c_mktsegment < 'C' THEN 0 ELSE 1 END AS side_order
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 4),
w AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY score DESC, side_order, task_id DESC) AS rn FROM s) WHERE rn = 1)
SELECT c_nationkey, CASE side_order WHEN 0 THEN 'east' ELSE 'west' END AS side, w.task_id, score, arg_max(model_id, ordinal) AS model_id,
  'champion,trained-on-' || CASE side_order WHEN 0 THEN 'east' ELSE 'west' END AS tags
FROM w JOIN models USING (task_id) GROUP BY ALL""")
def _champion(spark, sf):
    side = F.when(F.col("c_mktsegment") < "C", 0).otherwise(1)
    owners = table(spark, sf, "customer").select(F.col("c_custkey").alias("task_id"), "c_nationkey", side.alias("side_order"))
    tops = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("task_id")).agg(F.max("o_totalprice").alias("score"))
    entries = tops.join(owners, "task_id").withColumn(
        "side", F.when(F.col("side_order") == 0, "east").otherwise("west"))
    out = registry.champion(entries, models(spark, sf), ["c_nationkey"])
    return out.withColumn("tags", registry.tag_text(F.col("tags")))


