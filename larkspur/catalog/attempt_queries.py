"""Attempts over `lineitem`; budgets over `lineitem` x `part` x `supplier`."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from larkspur.catalog.base import ATTEMPTS, NEEDS, attempts, needs, query, r6, table
from larkspur.operators import gap, search
from larkspur.operators.checks import round_history
from larkspur.plans.order_stats import group_medians, take_hashed
from larkspur.plans.shared import cut

PROMPT = "close-up photograph of a part with a {label} fault"
SPACE = {"rank": [4, 12, 24], "rate": [0.002, 0.005, 0.01]}


def best(spark, sf):
    return search.best_attempt(attempts(spark, sf), "sample", "round", "score", ["label"])


@query("best_attempt", f"WITH {ATTEMPTS} SELECT sample, round, score, label FROM best")
def _best_attempt(spark, sf):
    return best(spark, sf)


TOPUP = ATTEMPTS + """,
bar AS (SELECT median(score) AS thr FROM attempts WHERE round = 1),
quotas AS (SELECT label, count(DISTINCT sample) AS quota FROM attempts GROUP BY label),
kept AS (
  SELECT * FROM (SELECT b.*, row_number() OVER (PARTITION BY label ORDER BY score DESC,
      md5(sample || ':' || round), sample || ':' || round) AS pos FROM best b, bar WHERE score >= thr)
  JOIN quotas USING (label) WHERE pos <= quota),
owed AS (SELECT q.label, q.quota - count(k.sample) AS owed FROM quotas q LEFT JOIN kept k USING (label) GROUP BY q.label, q.quota),
spare AS (SELECT a.* FROM attempts a, bar WHERE score >= thr
  AND NOT EXISTS (SELECT 1 FROM best b WHERE b.sample = a.sample AND b.round = a.round)),
extra AS (
  SELECT * FROM (SELECT s.*, row_number() OVER (PARTITION BY label ORDER BY score DESC,
      md5(sample || ':' || round), sample || ':' || round) AS pos FROM spare s)
  JOIN owed USING (label) WHERE pos <= owed),
picked AS (SELECT label, sample, round, score, 'kept' AS picked FROM kept
  UNION ALL SELECT label, sample, round, score, 'topped_up' FROM extra)"""


def _quotas(tries):
    return tries.groupBy("label").agg(F.count_distinct("sample").alias("quota"))


def _picked(spark, sf):
    tries = cut(attempts(spark, sf))
    winners = cut(search.best_attempt(tries, "sample", "round", "score", ["label"]))
    bar = group_medians(tries.where(F.col("round") == 1), [], "score", "threshold").select("threshold")
    quotas = cut(_quotas(tries))
    return search.filter_and_topup(tries, winners, quotas, "label",
                                   "sample", "round", "score", bar), quotas


@query("filter_and_topup", f"WITH {TOPUP} SELECT label, sample, round, score, picked FROM picked")
def _filter_and_topup(spark, sf):
    return _picked(spark, sf)[0]


@query("topup_shortfall", f"""WITH {TOPUP}
SELECT label, quota, count(*) FILTER (picked = 'kept') AS kept, count(*) FILTER (picked = 'topped_up') AS topped_up,
  quota - count(picked) AS shortfall FROM quotas LEFT JOIN picked USING (label) GROUP BY label, quota""")
def _topup_shortfall(spark, sf):
    return search.still_owed(*_picked(spark, sf), "label")


@query("quota_sample", """
WITH a AS (
  SELECT l_returnflag AS label, l_orderkey || ':' || l_linenumber AS uid, count(*) AS n
  FROM lineitem GROUP BY 1, 2),
q AS (SELECT label, CAST(floor(count(*) * 0.4) AS BIGINT) AS quota FROM a GROUP BY label)
SELECT label, uid FROM (SELECT a.*, row_number() OVER (PARTITION BY label ORDER BY md5(uid), uid) AS rn FROM a)
JOIN q USING (label) WHERE rn <= quota""")
def _quota_sample(spark, sf):
    uid = F.concat_ws(":", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    rows = cut(table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("label"), uid.alias("uid")).distinct())
    quotas = rows.groupBy("label").agg(F.floor(F.count(F.lit(1)) * 0.4).cast("bigint").alias("quota"))
    return take_hashed(rows, ["label"], quotas, "quota", "uid")


@query("setting_table", f"""WITH {ATTEMPTS},
s AS (SELECT *, CASE WHEN (round - 1) % 2 = 0 THEN 4.0 ELSE 10.0 END::DOUBLE AS guidance,
  CASE WHEN (round - 1) % 2 = 0 THEN 1.5 ELSE 3.0 END::DOUBLE AS crop_ratio FROM attempts)
SELECT round, guidance, crop_ratio, count(*) AS n, min(score) AS min_score, round(median(score), 6) AS median_score, max(score) AS max_score
FROM s GROUP BY 1, 2, 3""")
def _setting_table(spark, sf):
    tries = gap.draw_grid(cut(attempts(spark, sf)), "round")
    return search.setting_table(tries, ["round", "guidance", "crop_ratio"], "score").withColumn(
        "median_score", r6("median_score"))


@query("draw_grid", f"""WITH {ATTEMPTS}
SELECT sample, round, CASE WHEN (round - 1) % 2 = 0 THEN 4.0 ELSE 10.0 END::DOUBLE AS guidance,
  CASE WHEN (round - 1) % 2 = 0 THEN 1.5 ELSE 3.0 END::DOUBLE AS crop_ratio FROM attempts""")
def _draw_grid(spark, sf):
    return gap.draw_grid(attempts(spark, sf), "round").select("sample", "round", "guidance", "crop_ratio")


@query("improvement_table", f"""WITH {ATTEMPTS},
st AS (
  SELECT 'original' AS stage, sample, score FROM attempts WHERE round = 1
  UNION ALL SELECT 'after search', sample, max(score) FROM attempts WHERE round <= 4 GROUP BY sample
  UNION ALL SELECT 'final', sample, score FROM best)
SELECT stage, count(*) AS n, min(score) AS min_score, round(median(score), 6) AS median_score, max(score) AS max_score FROM st GROUP BY stage""")
def _improvement_table(spark, sf):
    tries = cut(attempts(spark, sf))
    searched = search.best_attempt(tries.where(F.col("round") <= 4), "sample", "round", "score")
    return search.improvement_table({
        "original": tries.where(F.col("round") == 1), "after search": searched,
        "final": search.best_attempt(tries, "sample", "round", "score")}, "score").withColumn("median_score", r6("median_score"))


@query("attempt_wins", f"""WITH {ATTEMPTS}
SELECT CASE WHEN round = 1 THEN 'original' ELSE 'round ' || round END AS attempt, count(*) AS samples FROM best GROUP BY 1""")
def _attempt_wins(spark, sf):
    name = F.when(F.col("round") == 1, "").otherwise(F.concat(F.lit("round "), F.col("round").cast("string")))
    return search.attempt_wins(best(spark, sf).select(name.alias("best_round")))


@query("lifted_count", f"""WITH {ATTEMPTS}
SELECT count(*) FILTER (b.score > coalesce(o.score, -1)) AS lifted, count(*) AS samples
FROM best b LEFT JOIN (SELECT * FROM attempts WHERE round = 1) o USING (sample)""")
def _lifted_count(spark, sf):
    before = attempts(spark, sf).where(F.col("round") == 1)
    return search.lifted_count(before, best(spark, sf), "sample", "score")


# ---- budgets ----------------------------------------------------------------


def nation_gap(rows):
    """Short of the best-filled class of the same nation."""
    counts = rows.groupBy("s_nationkey", "label").agg(F.sum("n").alias("have"))
    top = F.max("have").over(Window.partitionBy("s_nationkey"))
    return gap.gap_report(counts.withColumn("_t", top), F.col("_t"), ["s_nationkey"])


def nation_allocation(spark, sf):
    rows = needs(spark, sf)
    types = rows.select("s_nationkey", F.concat("flag", F.lit("+"), "label").alias("defect_type"))
    return gap.allocate_budget(nation_gap(rows), types, 5 + F.col("s_nationkey"), ["s_nationkey"])


@query("allocate_budget", f"WITH {NEEDS} SELECT s_nationkey, defect_type, label, short, asked FROM alloc")
def _allocate_budget(spark, sf):
    return nation_allocation(spark, sf)


@query("asked_vs_got", f"""WITH {NEEDS},
got AS (SELECT s_nationkey, flag || '+' || label AS defect_type, count(*) AS got FROM base WHERE flag = 'N' GROUP BY 1, 2)
SELECT s_nationkey, defect_type, short, asked, coalesce(got, 0) AS got, coalesce(got, 0) < asked AS is_short
FROM alloc LEFT JOIN got USING (s_nationkey, defect_type)""")
def _asked_vs_got(spark, sf):
    line = table(spark, sf, "lineitem").where(F.col("l_returnflag") == "N").select("l_partkey", "l_suppkey")
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    supplier = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    made = line.join(part, "l_partkey").join(supplier, "l_suppkey").select(
        "s_nationkey", F.concat(F.lit("N+"), "p_type").alias("defect_type"))
    return gap.asked_vs_got(nation_allocation(spark, sf), made, ["s_nationkey"])


@query("work_orders", f"""WITH {NEEDS}
SELECT s_nationkey, defect_type, label, ordinal, 7 + ordinal AS seed,
  'close-up photograph of a part with a ' || replace(label, '_', ' ') || ' fault' AS prompt
FROM alloc, LATERAL (SELECT unnest(range(asked)) AS ordinal)""")
def _work_orders(spark, sf):
    return gap.work_orders(nation_allocation(spark, sf), PROMPT, 7, ["s_nationkey"])


@query("budget_map", f"""WITH {NEEDS} SELECT s_nationkey, label, short AS count FROM gap WHERE short > 0""")
def _budget_map(spark, sf):
    short = nation_gap(needs(spark, sf)).where(F.col("short") > 0)
    entry = F.concat("label", F.lit(" : "), F.col("short").cast("string"))
    text = short.groupBy("s_nationkey").agg(F.array_join(F.collect_list(entry), " , ").alias("gap"))
    return gap.budget_map(text, "gap", ["s_nationkey"]).drop("text")


@query("hpo_grid", """
WITH v AS (SELECT r.rank, t.rate, (r.i - 1) * 3 + t.i - 1 AS trial FROM
  (SELECT unnest([4, 12, 24]) AS rank, unnest([1, 2, 3]) AS i) r, (SELECT unnest([0.002, 0.005, 0.01]::DOUBLE[]) AS rate, unnest([1, 2, 3]) AS i) t)
SELECT c_custkey, CAST(trial AS INTEGER) AS trial, rank, rate FROM customer, v WHERE trial < c_custkey % 11""")
def _hpo_grid(spark, sf):
    studies = table(spark, sf, "customer").select("c_custkey")
    return gap.hpo_grid(studies, SPACE, F.col("c_custkey") % 11)


@query("round_history", """
WITH r AS (
  SELECT s_nationkey, l_linenumber - 1 AS round, count(*) AS published,
    count(*) FILTER (l_returnflag = 'N') AS verified,
    count(*) FILTER (l_linestatus = 'O') / CAST(count(*) AS DOUBLE) AS accuracy
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2)
SELECT s_nationkey, round, published, verified, round(accuracy, 6) AS accuracy,
  round(accuracy - lag(accuracy) OVER w, 6) AS gain_over_previous,
  round(accuracy - first_value(accuracy) OVER w, 6) AS gain_over_baseline
FROM r WINDOW w AS (PARTITION BY s_nationkey ORDER BY round)""")
def _round_history(spark, sf):
    line = table(spark, sf, "lineitem").select("l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus")
    supplier = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    n = F.count(F.lit(1))
    rows = line.join(supplier, "l_suppkey").groupBy(
        "s_nationkey", (F.col("l_linenumber") - 1).alias("round")).agg(
        n.alias("published"), F.count_if(F.col("l_returnflag") == "N").alias("verified"),
        (F.count_if(F.col("l_linestatus") == "O") / n).alias("accuracy"))
    out = round_history(rows, ["s_nationkey"])
    return out.withColumns({c: r6(c) for c in ("accuracy", "gain_over_previous", "gain_over_baseline")})
