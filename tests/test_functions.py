from pyspark.sql import functions as F

from comparing import rows
from larkspur.functions import text as t
from larkspur.functions.logtext import extract_metrics, metric_map
from larkspur.operators.scoring import judge_gate
from larkspur.operators.telemetry import expectation_report, probe_markers


def texts(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c string")


def col(spark, fn, *values):
    return [r[0] for r in texts(spark, *values).orderBy("i").select(fn(F.col("c"))).collect()]


def test_strip_removes_every_kind_of_blank(spark):
    assert col(spark, t.strip_ws, "  a b\t\n", "  ", "x") == ["a b", "", "x"]


def test_defect_and_texture(spark):
    values = ["IC+bridge", "bridge", "", "IC+", None]
    assert col(spark, t.texture_of, *values) == ["IC", "bridge", None, "IC", None]
    assert col(spark, t.defect_of, *values) == ["bridge", "bridge", "unknown", "unknown", "unknown"]


def test_guardrail(spark):
    assert col(spark, t.guardrail_ok, "1", "True", " true ", "0", "TRUE", None) == [
        True, True, True, False, False, False]


def test_truthy(spark):
    assert col(spark, t.truthy, " Yes", "ON", "1", "2", "", None) == [
        True, True, True, False, False, False]


def test_usable_score(spark):
    assert col(spark, t.usable_score, "1.5", "nan", "x", "", None, "inf") == [
        1.5, None, None, None, None, float("inf")]


def test_iteration_index(spark):
    assert col(spark, t.iteration_index, "baseline", "iter3", "iter1-try2", "final", None) == [
        0, 3, 12, 0, 0]


def test_uri_parts(spark):
    uri = "/s/v2-made/ab12-round1/IC%2Bbridge_0.png"
    assert col(spark, t.run_id_of, uri, "f.png") == ["ab12-round1", None]
    assert col(spark, t.version_of, uri) == ["v2-made"]
    assert col(spark, lambda c: t.path_segment(c, 1), uri) == ["IC+bridge_0.png"]
    assert col(spark, t.basename, "a/b/c.png", "c.png") == ["c.png", "c.png"]


def test_first_url(spark):
    assert col(spark, t.first_url,
               '{"zz": "http://z", "endpoint": "no", "url": "https://u/x"}',
               '{"info": [{"link": "http://deep/1"}]}', '{"a": 1}', "not json") == [
        "https://u/x", "http://deep/1", None, None]


def test_metrics(spark):
    cases = {
        "pass over, far : 41.5% with Threshold = 0.27": {"far": 41.5, "threshold": 0.27},
        "after tuning Far 9.5% --> 4.25%, limit below 2%": {"far": 4.25},
        "batch closed; requested:30 granted=9 generated= 12 in all": {"requested": 30, "generated": 12},
        "loss=0.5 far 10% far=12%": {"loss": 0.5, "far": 10},
        "loss: 2 -> 1 loss=4": {"loss": 4},
        "loss=7->3recall=9": {"loss": 3, "recall": 9},
        "accuracy = -0.5": {"accuracy": -0.5},
        "nothing here": {},
    }
    got = texts(spark, *cases).orderBy("i").select(metric_map(F.col("c"))).collect()
    assert [r[0] for r in got] == [{k: float(v) for k, v in m.items()} for m in cases.values()]


def test_extract_metrics_one_row_per_metric(spark):
    got = extract_metrics(texts(spark, "far=1 loss=2", ""), ["i"], "c")
    assert rows(got) == [(0, "far", 1.0), (0, "loss", 2.0)]


def test_probe_markers(spark):
    lines = spark.createDataFrame([
        ("a", 1, "PROBE:uid=10000 gid=10000"), ("a", 2, "x PROBE:card=Model A10 x"),
        ("a", 3, "PROBE:ram=64M"), ("a", 4, "PROBE:ram=16G"), ("a", 5, "PROBE:odd"),
        ("a", 6, "no marker"), ("a", 7, "PROBE:=x"), ("a", 8, "PROBE:k=a=b"),
        ("a", 9, "PROBE:p=1 PROBE:q=2")],
        "task_id string, line_no int, line string")
    got = dict((k, v) for _, k, v in rows(probe_markers(lines)))
    assert got == {"uid": "10000", "gid": "10000", "card": "Model A10 x", "ram": "16G", "odd": "",
                   "k": "a=b", "p": "1", "PROBE:q": "2"}


EXPECTATIONS = [("card", "present", "a"), ("disk_found", "yes", "b"), ("disk_open", "yes", "c"),
                ("ram", ">=1G", "d"), ("login_known", "yes", "e"), ("token_known", "yes", "f")]


def test_expectations(spark):
    found = spark.createDataFrame([
        ("a", "ram", "64M"), ("a", "card", "NONE (missing)"), ("a", "disk_found", "yes"),
        ("b", "ram", "16g"), ("b", "card", "Model 1")], "task_id string, key string, value string")
    tasks = found.select("task_id").distinct()
    got = {(r["task_id"], r["key"]): r["verdict"] for r in expectation_report(found, tasks, EXPECTATIONS).collect()}
    assert len(got) == 2 * len(EXPECTATIONS)
    assert got["a", "ram"] == "FAIL" and got["b", "ram"] == "PASS"
    assert got["a", "card"] == "FAIL" and got["b", "card"] == "PASS"
    assert got["a", "disk_found"] == "PASS"
    assert got["b", "login_known"] == "FAIL"  # never reported


def test_verdicts(spark):
    replies = texts(
        spark, 'ok: {"present": true, "confidence": 0.8} bye', "no",
        '{"present": true, "confidence": 0.5}', '{"present":"false","confidence":0.9}',
        '{"present": true, "confidence": ', None, '{broken} {"present": true}',
        '{"present": true, "confidence": 0.9, "reason": "%s"}' % ("x" * 300))
    got = judge_gate(replies, "c").orderBy("i").collect()
    assert [r["accepted"] for r in got] == [True, False, False, False, False, False, False, True]
    assert [r["error"] for r in got] == [False, True, False, False, True, True, True, False]
    assert got[1]["reason"] == "no JSON in reply: no"
    assert len(got[7]["reason"]) == 200
