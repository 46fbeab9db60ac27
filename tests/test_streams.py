import json

from comparing import rows
from larkspur import schemas
from larkspur.operators.telemetry import (
    kpi_vs_target, loop_points, status_transitions, terminal_report, token_cost)
from larkspur.streaming import jobs
from pyspark.sql import functions as F


def entry(seq, **kw):
    return json.dumps({"seq": seq, **kw})


def land(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def test_log_is_mirrored_once(spark, tmp_path):
    inbox, out = tmp_path / "in", str(tmp_path / "points")
    land(inbox, "a.jsonl", entry(1, iter="baseline", summary="FAR=52%", duration_sec=3),
         entry(2, iter="iter1", summary="none", tokens={"input": 5, "output": 2}), "broken",
         entry(3, iter="iter1", duration_sec=1.5))

    def run(mark):
        log = jobs.read_stream(spark, str(inbox), schemas.LOOP_LOG)
        return rows(jobs.mirror_log(log, out, str(tmp_path / mark)))

    first = run("m")
    assert first == [(1, 0, "cost", "gpu_seconds", 3.0), (1, 0, "kpi", "FAR", 52.0),
                     (2, 1, "cost", "agent_tokens", 7.0), (3, 1, "cost", "gpu_seconds", 1.5)]
    assert run("m") == first
    land(inbox, "b.jsonl", entry(2, iter="iter1", duration_sec=9), entry(3, iter="iter9", duration_sec=9),
         entry(4, iter="iter2", summary="recall 5%"), entry(4, iter="iter2", summary="recall 5%"))
    grown = first + [(4, 2, "kpi", "RECALL", 5.0)]
    assert run("m") == grown
    assert run("another mark") == grown


def test_scalars_keep_numbers_only(spark, tmp_path):
    inbox = tmp_path / "in"
    land(inbox, "a.json", *(json.dumps({"task_id": "t", "series": "loss", "step": i, "value": v})
                            for i, v in enumerate(["0.5", "text", "1e3"])))
    got = jobs.scalar_stream(jobs.read_stream(spark, str(inbox), schemas.SCALAR_RECORD),
                             str(tmp_path / "out"), str(tmp_path / "m"))
    assert rows(got, "step", "value") == [(0, 0.5), (2, 1000.0)]


def test_stage_reports(spark, tmp_path):
    inbox = tmp_path / "in"
    land(inbox, "a.json",
         json.dumps({"stage": "train", "iter": "iter2", "status": "ok", "duration_sec": 4, "output": "loss=1\nloss=0.5 epochs=3"}),
         json.dumps({"stage": "eval", "iter": "iter2", "status": "error", "duration_sec": 1, "output": "crash"}))
    got = jobs.stage_report_stream(jobs.read_stream(spark, str(inbox), schemas.STAGE_RECORD),
                                   str(tmp_path / "out"), str(tmp_path / "m"))
    assert rows(got, "stage", "failed", "title", "series", "value") == [
        ("eval", True, "duration", "duration_sec", 1.0),
        ("train", False, "cost", "gpu_seconds", 4.0), ("train", False, "duration", "duration_sec", 4.0),
        ("train", False, "kpi", "LOSS", 0.5), ("train", False, "stage", "epochs", 3.0), ("train", False, "stage", "loss", 0.5)]


def test_gap_follows_the_stream(spark, tmp_path):
    inbox = tmp_path / "in"

    def run():
        labels = jobs.read_stream(spark, str(inbox), "label string")
        return rows(jobs.running_gap(labels, str(tmp_path / "out"), str(tmp_path / "m"), 3), "label", "have", "short")

    land(inbox, "a.json", '{"label":"x"}', '{"label":"y"}', '{"label":"clean"}')
    assert run() == [("x", 1, 2), ("y", 1, 2)]
    land(inbox, "b.json", '{"label":"x"}', '{"label":"x"}')
    assert run() == [("x", 3, 0), ("y", 1, 2)]


def test_costs_and_targets(spark):
    log = spark.read.schema(schemas.LOOP_LOG).json(spark.sparkContext.parallelize([
        entry(1, iter="iter1", summary="FAR 9%", duration_sec=2, tokens={"input": 1}),
        entry(2, iter="iter1", summary="FAR 4%", tokens={"cache_read": 3}),
        entry(3, iter="iter2", summary="FAR 2%")]))
    assert rows(token_cost(log)) == [(1, 2, 4.0, 2.0), (2, 1, 0.0, None)]
    targets = spark.createDataFrame([("FAR", 3.0, True)], "series string, target double, lower_is_better boolean")
    got = kpi_vs_target(loop_points(log).where("title = 'kpi'"), targets)
    assert rows(got, "iteration", "value", "reached") == [(1, 4.0, False), (2, 2.0, True)]


def test_states(spark):
    data = [("t", 1, "queued"), ("t", 2, "queued"), ("t", 70, "running"), ("t", 130, "failed"), ("t", 140, "failed"),
            ("u", 5, "completed"), ("v", 5, "running")]
    df = spark.createDataFrame(data, "task_id string, s int, status string").withColumn("ts", F.timestamp_seconds("s"))
    got = status_transitions(df, ["ts"], F.expr("s div 60"))
    assert rows(got, "task_id", "s", "failure") == [
        ("t", 1, False), ("t", 130, True), ("t", 70, False), ("u", 5, False), ("v", 5, False)]
    tails = spark.createDataFrame([("t", "log"), ("u", "log")], "task_id string, tail string")
    assert rows(terminal_report(df, "ts", tails), "task_id", "status", "seconds", "tail") == [
        ("t", "failed", 129, "log"), ("u", "completed", 0, None)]
