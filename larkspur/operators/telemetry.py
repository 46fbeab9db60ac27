"""Logs, metrics, costs and task states as tables.

The point-building functions serve the batch queries and the streams alike.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.functions.logtext import KPI_NAMES, metric_map, probe_pairs
from larkspur.functions.text import iteration_index
from larkspur.plans.order_stats import previous_value

# Which states end a task.
TERMINAL = ["completed", "failed", "stopped", "closed"]


def _point(title: Column | str, series: Column, value: Column) -> Column:
    t = F.lit(title) if isinstance(title, str) else title
    return F.struct(t.alias("title"), series.alias("series"), value.alias("value"))


def _kpi_points(metrics: Column, title: str) -> Column:
    return F.transform(F.map_entries(metrics), lambda e: _point(
        title, F.upper(e["key"]), e["value"]))


def token_total(tokens: Column) -> Column:
    parts = [F.coalesce(tokens[k], F.lit(0.0)) for k in
             ("input", "output", "cache_read", "cache_create")]
    return parts[0] + parts[1] + parts[2] + parts[3]


def loop_points(log: DataFrame) -> DataFrame:
    """Loop log rows -> (seq, iteration, title, series, value) points.

    A projection and an explode: usable on a stream and a table.
    """
    tokens = token_total(F.col("tokens"))
    empty = F.expr("cast(array() as array<struct<title:string,series:string,value:double>>)")
    gpu = F.when(F.col("duration_sec").isNotNull(), F.array(
        _point("cost", F.lit("gpu_seconds"), F.col("duration_sec")))).otherwise(empty)
    spent = F.when(tokens != 0, F.array(
        _point("cost", F.lit("agent_tokens"), tokens))).otherwise(empty)
    kpi = _kpi_points(F.col("_m"), "kpi")
    log = log.where(F.col("seq").isNotNull()).withColumn(
        "_m", metric_map(F.coalesce("summary", F.lit(""))))
    return log.select(
        "seq", iteration_index(F.col("iter")).alias("iteration"),
        F.explode(F.concat(kpi, gpu, spent)).alias("p")).select("seq", "iteration", "p.*")


def stage_points(records: DataFrame, keys: Sequence[str] = ("stage",)) -> DataFrame:
    """Finished stages -> metric, duration and headline KPI points with a failed flag."""
    metrics = F.col("_m")
    stage = F.transform(F.map_entries(metrics), lambda e: _point("stage", e["key"], e["value"]))
    headline = F.map_filter(metrics, lambda k, v: k.isin(KPI_NAMES))
    duration = F.array(_point("duration", F.lit("duration_sec"), F.col("duration_sec")))
    gpu = F.when(F.size(metrics) > 0, F.array(
        _point("cost", F.lit("gpu_seconds"), F.col("duration_sec")))).otherwise(
        F.expr("cast(array() as array<struct<title:string,series:string,value:double>>)"))
    points = F.concat(stage, _kpi_points(headline, "kpi"), gpu, duration)
    return records.withColumn("_m", metric_map(F.coalesce("output", F.lit("")))).select(
        *keys, iteration_index(F.col("iter")).alias("iteration"),
        (~F.coalesce(F.col("status") == "ok", F.lit(False))).alias("failed"),
        F.explode(points).alias("p")).select(*keys, "iteration", "failed", "p.*")


def numeric_points(records: DataFrame, value: str = "value") -> DataFrame:
    """Keep records whose value is a number; text that is none is dropped."""
    v = F.col(value).try_cast("double")
    return records.withColumn(value, v).where(F.col(value).isNotNull())


def token_cost(log: DataFrame, keys: Sequence[str] = ("iteration",)) -> DataFrame:
    """(keys, entries, agent_tokens, gpu_seconds)."""
    rows = log.withColumns({"iteration": iteration_index(F.col("iter")),
                            "_tokens": token_total(F.col("tokens"))})
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("entries"), F.sum("_tokens").alias("agent_tokens"),
        F.sum("duration_sec").alias("gpu_seconds"))


def last_scalar(points: DataFrame, tasks: DataFrame, metric: str) -> DataFrame:
    """(task_id, score): the last value of a metric, matched by title or series.

    A task without the metric, or whose last value is no number, scores 0.0.
    """
    named = points.where((F.col("title") == metric) | (F.col("series") == metric))
    last = named.groupBy("task_id").agg(
        F.max_by(F.col("value").cast("string"), "iteration").alias("_v"))
    return tasks.select("task_id").join(last, "task_id", "left").select(
        "task_id", F.coalesce(F.col("_v").try_cast("double"), F.lit(0.0)).alias("score"))


def kpi_vs_target(points: DataFrame, targets: DataFrame, order: str = "seq",
                  keys: Sequence[str] = ()) -> DataFrame:
    """(keys, series, iteration, value, target, reached): last value per iteration.

    targets: (series, target, lower_is_better).
    """
    last = points.groupBy(*keys, "series", "iteration").agg(
        F.max_by("value", order).alias("value"))
    reached = F.when(F.col("lower_is_better"), F.col("value") <= F.col("target")).otherwise(
        F.col("value") >= F.col("target"))
    return last.join(targets, "series").select(
        *keys, "series", "iteration", "value", "target", reached.alias("reached"))


def console_tail(lines: DataFrame, n: int = 80, task: str = "task_id") -> DataFrame:
    """(task, n_lines, tail): the last `n` lines of every task, in order.

    The constant bound lets Spark prune each task's lines before the shuffle.
    """
    w = Window.partitionBy(task).orderBy(F.desc("line_no"))
    kept = (lines.select(task, "line_no", "line")
            .withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n))
    ordered = F.array_sort(F.collect_list(F.struct("line_no", "line")))
    return kept.groupBy(task).agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.array_join(F.transform(ordered, lambda s: s["line"]), "\n").alias("tail"))


def status_transitions(records: DataFrame, order: Sequence[str], bucket: Column,
                       task: str = "task_id", status: str = "status") -> DataFrame:
    """Rows where a task's status differs from the one before, with flags.

    `bucket` is an order-preserving slice of the order columns, such as the
    day; it splits the history of one busy task over many tasks.
    """
    seen = previous_value(records, task, list(order), status, bucket, "previous_status")
    changed = seen.where(~F.col(status).eqNullSafe(F.col("previous_status")))
    terminal = F.col(status).isin(TERMINAL)
    return changed.withColumns({
        "terminal": terminal, "failure": terminal & (F.col(status) != "completed")})


def terminal_report(records: DataFrame, started: str, tails: DataFrame | None = None,
                    terminal: Sequence[str] = TERMINAL, task: str = "task_id",
                    status: str = "status") -> DataFrame:
    """(task, status, ended, seconds, failure, tail): the first terminal state.

    `started` is the time column; the console tail is kept for failures only.
    """
    is_end = F.col(status).isin(list(terminal))
    ends = records.groupBy(task).agg(
        F.min(started).alias("_start"),
        F.min(F.when(is_end, F.struct(started, status))).alias("_e"))
    rows = ends.where(F.col("_e").isNotNull()).select(
        task, F.col(f"_e.{status}").alias(status), F.col(f"_e.{started}").alias("ended"),
        F.timestamp_diff("SECOND", F.col("_start"), F.col(f"_e.{started}")).alias("seconds"))
    rows = rows.withColumn("failure", F.col(status) != "completed")
    if tails is None:
        return rows
    return rows.join(tails.select(task, "tail"), task, "left").withColumn(
        "tail", F.when(F.col("failure"), F.col("tail")))


def probe_markers(lines: DataFrame, task: str = "task_id") -> DataFrame:
    """(task, key, value): markers found on the console; the last of a key wins."""
    pairs = (lines.where(F.contains("line", F.lit("PROBE:")))
             .select(task, "line_no", F.posexplode(probe_pairs(F.col("line"))).alias("pos", "kv")))
    return pairs.groupBy(task, F.col("kv.key").alias("key")).agg(
        F.max_by("kv.value", F.struct("line_no", "pos")).alias("value"))


def meets_expectation(want: Column, value: Column) -> Column:
    """Whether a marker's value is as wanted; a marker that was never reported fails.

    Rules: `present` (a value that does not say NONE), `>=1G` (a size in G or
    T), `yes` (that word); anything else has to be met literally.
    """
    text = F.trim(F.coalesce(value, F.lit("")))
    got = F.upper(text)
    return (F.when(want == "present", (got != "") & ~F.contains(got, F.lit("NONE")))
            .when(want == ">=1G", got.endswith("G") | got.endswith("T"))
            .otherwise(text == want))


def expectation_report(found: DataFrame, tasks: DataFrame, expectations: Sequence[tuple[str, str, str]],
                       task: str = "task_id") -> DataFrame:
    """(task, key, want, got, verdict, fix): one row per task and expectation.

    `expectations` are the caller's (marker key, rule, what to do if it fails).
    """
    wanted = F.array(*[F.struct(F.lit(k).alias("key"), F.lit(w).alias("want"),
                                F.lit(f).alias("fix")) for k, w, f in expectations])
    rows = tasks.select(task, F.explode(wanted).alias("e")).select(task, "e.*")
    joined = rows.join(found, [task, "key"], "left")
    ok = meets_expectation(F.col("want"), F.col("value"))
    return joined.select(
        task, "key", "want", F.coalesce("value", F.lit("(not reported)")).alias("got"),
        F.when(ok, "PASS").otherwise("FAIL").alias("verdict"),
        F.when(~ok, F.col("fix")).alias("fix"))


def queue_activity(tasks: DataFrame, queues: DataFrame, latest: int = 1000,
                   order: Sequence[str] = ("last_update", "task_id")) -> DataFrame:
    """Every queue with its share of the `latest` tasks; idle queues stay at 0."""
    recent = (tasks.orderBy(*[F.desc(c) for c in order]).limit(latest)
              .where(F.col("queue_id").isNotNull())
              .groupBy("queue_id").agg(F.count(F.lit(1)).alias("recent_tasks")))
    return (queues.join(recent, "queue_id", "left")
            .withColumn("recent_tasks", F.coalesce("recent_tasks", F.lit(0)))
            .withColumn("active", F.col("recent_tasks") > 0)
            .orderBy(F.desc("recent_tasks"), "name", "queue_id"))
