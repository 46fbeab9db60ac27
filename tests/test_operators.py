import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from comparing import rows
from larkspur.operators import (
    checks, evaluation, frames, registry, scoring, search, similarity, telemetry, training)


def scored(spark, *values):
    return spark.createDataFrame([(i, "r", v) for i, v in enumerate(values)],
                                 "i int, run_id string, nn_score double")


# ---- gates ------------------------------------------------------------------

def test_gate_uses_the_median_and_ignores_nan(spark):
    df = scored(spark, 1.0, 2.0, 3.0, 10.0, float("nan"), None)
    for keys in ([], ["run_id"]):
        got = scoring.gate_accept(df, keys).orderBy("i").collect()
        assert [r["threshold"] for r in got] == [2.5] * 6
        assert [r["accepted"] for r in got] == [False, False, True, True, False, False]
        assert [r["verdict"] for r in got] == ["reject", "reject", "accept", "accept", None, None]


def test_runs_are_gated_on_their_own(spark):
    df = spark.createDataFrame([("a", "f", 1.0), ("a", "g", 3.0), ("b", "f", 10.0), ("b", "g", 30.0)],
                               "run_id string, base string, nn_score double")
    real = spark.createDataFrame([("/r/1.png", "clean", "real")], "uri string, label string, origin string")
    manifest = df.select("run_id", F.concat(F.lit("x/"), "base").alias("output_filename"),
                         F.lit("IC+b").alias("anomaly_type"))
    got = training.collect_training_items(real, manifest, df)
    assert rows(got, "uri", "run_id", "label") == sorted(
        [("/r/1.png", None, "clean"), ("x/g", "a", "b"), ("x/g", "b", "b")], key=repr)
    assert training.collect_training_items(real, manifest, df, use_synthetic=False).count() == 1
    assert training.collect_training_items(real, manifest, df, accepted_only=False).count() == 5
    assert training.collect_training_items(real, manifest, df, threshold=2.0).count() == 4


def test_distribution_acceptance_panels(spark):
    df = spark.createDataFrame([("a", f"p/{i}.png", float(i)) for i in range(30)] + [(None, "p/x.png", 100.0)],
                               "anomaly_type string, path string, nn_score double")
    dist = {r[0]: tuple(r)[1:] for r in scoring.score_distribution(df).collect()}
    assert dist["a"] == (30, 0.0, 14.5, 29.0) and dist[None] == (1, 100.0, 100.0, 100.0)
    gated = scoring.gate_accept(df)
    assert rows(scoring.acceptance_by_class(gated)) == sorted(
        [("?", 1, 1), ("a", 15, 30), (None, 16, 31)], key=repr)
    panels = scoring.gate_panels(gated, "path").collect()
    assert [r["nn_score"] for r in panels] == [100.0] + [float(i) for i in range(29, 18, -1)] + [
        float(i) for i in range(12)]
    table = scoring.score_table(gated, "path").collect()
    assert table[0]["image"] == "x.png" and len(table) == 31
    assert rows(scoring.mean_threshold(scoring.default_thresholds(df.withColumn("run_id", F.col("anomaly_type"))))
                ) == [((14.5 + 100) / 2,)]


# ---- frames -----------------------------------------------------------------

def test_frames(spark):
    df = spark.createDataFrame(
        [("a/1.jpg", ["x", "x", "y"], "real", "t", None, 640, {"k": "over", "gone": None}),
         ("a/2.png", [], "synthetic", None, "3", 0, None)],
        "uri string, labels array<string>, origin string, texture string, k string, w int, o map<string,string>")
    meta = frames.frame_meta(df.withColumn("run_id", F.lit("r")), ["k"], "o")
    out = {r["sources"][0]["uri"]: r for r in frames.make_frames(meta, width="w").collect()}
    one, two = out["a/1.jpg"], out["a/2.png"]
    assert one["sources"][0]["content_type"] == "image/jpeg" and one["sources"][0]["width"] == 640
    assert one["extra"] == {"k": "over"} and two["extra"] == {"k": "3"}
    assert two["rois"] == [] and two["sources"][0]["width"] is None
    assert one["rois"][0]["sources"] == [one["frame_id"]]
    f = frames.make_frames(meta).withColumn("version_id", F.lit("v"))
    assert rows(frames.version_stats(f)) == [
        ("v", "content_types", "image/jpeg", 1), ("v", "content_types", "image/png", 1),
        ("v", "frames", "total", 2), ("v", "labels", "x", 1), ("v", "labels", "y", 1)]
    assert rows(frames.label_count_any(f, ["x", "y"])) == [(1,)]


def test_origin_is_mandatory(spark):
    df = spark.createDataFrame([("u", None)], "uri string, origin string")
    with pytest.raises(Exception, match="origin is mandatory"):
        frames.frame_meta(df).select("meta").collect()


def test_earned_label(spark):
    df = spark.createDataFrame([("b", True), ("b", False), ("b", None)], "defect string, ok boolean")
    assert rows(frames.earn_label(df, F.col("ok")), "label", "verified") == [
        ("b", True), ("pending-review", False), ("pending-review", False)]


# ---- search -----------------------------------------------------------------

def test_search(spark):
    tries = spark.createDataFrame(
        [(0, 0, 0.5, "a"), (0, 1, 0.6, "a"), (1, 0, 0.7, "a"), (1, 1, 0.7, "a"), (2, 1, 0.1, "b"),
         (2, 2, float("nan"), "b")], "sample int, round int, score double, label string")
    best = search.best_attempt(tries, "sample", "round", "score", ["label"])
    assert rows(best) == [(0, 1, 0.6, "a"), (1, 0, 0.7, "a"), (2, 1, 0.1, "b")]
    before = tries.where("round = 0")
    assert rows(search.lifted_count(before, best, "sample", "score")) == [(2, 3)]
    quotas = spark.createDataFrame([("a", 3), ("b", 2)], "label string, quota int")
    picked = search.filter_and_topup(tries, best, quotas, "label", "sample", "round", "score", 0.5)
    assert rows(picked, "sample", "round", "picked") == [
        (0, 1, "kept"), (1, 0, "kept"), (1, 1, "topped_up")]
    assert rows(search.still_owed(picked, quotas, "label")) == [("a", 3, 2, 1, 0), ("b", 2, 0, 0, 2)]
    assert rows(search.setting_table(tries, ["round"], "score"), "round", "n", "median_score") == [
        (0, 2, 0.6), (1, 3, 0.6)]


# ---- similarity -------------------------------------------------------------

@pytest.mark.parametrize("grid", [(1, 1), (3, 2)])
def test_nearest_by_cosine_matches_brute_force(spark, grid):
    rng = np.random.default_rng(0)
    def make(n, start):
        label = ["hot" if rng.random() < 0.7 else str(rng.integers(3)) for _ in range(n)]
        return [(start + i, label[i], rng.normal(size=8).tolist()) for i in range(n)]
    cand = make(300, 0) + [(999, "lonely", [1.0] * 8)]
    refs = make(200, 1000) + [(5000, "hot", cand[0][2]), (5001, "hot", cand[0][2])]
    ddl = "uid bigint, label string, v array<float>"
    c = spark.createDataFrame(cand, ddl).repartition(4)
    r = spark.createDataFrame(refs, ddl).repartition(3)
    unit = lambda v: np.asarray(v, dtype=np.float32).astype(float) / np.linalg.norm(np.asarray(v, dtype=np.float32).astype(float))
    got = {x["uid"]: x for x in similarity.nn_score(c, r, "label", "uid", "v", grid).collect()}
    assert len(got) == len(cand) and got[999]["nn_score"] is None
    for uid, label, v in cand[:-1]:
        sims = [(round(float(unit(v) @ unit(w)), 9), -rid) for rid, lab, w in refs if lab == label]
        best = max(sims)
        assert got[uid]["nn_score"] == pytest.approx(best[0], abs=2e-9)
    near = similarity.mine_similar(c, r, "uid", "v", 4, grid).where("query_id = 7").orderBy("rank").collect()
    v = cand[7][2]
    want = sorted(((-round(float(unit(v) @ unit(w)), 9), rid) for rid, _, w in refs))[:4]
    assert [x["match_id"] for x in near] == [rid for _, rid in want]


def test_mining_leaves_out_the_row_itself(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.1]), (3, [0.0, 1.0])], "uid bigint, v array<float>")
    got = similarity.mine_similar(df, df, "uid", "v", 2)
    assert rows(got, "query_id", "match_id")[:2] == [(1, 2), (1, 3)]


# ---- training sets ----------------------------------------------------------

def items(spark, n=200):
    data = [(f"/r/{i}", "hot" if i % 3 else "cold", "real") for i in range(n)]
    data += [("/r/solo", "solo", "real")] + [(f"/s/{i}", "hot", "synthetic") for i in range(50)]
    return spark.createDataFrame(data, "uri string, label string, origin string")


def test_split_is_fixed_stratified_and_real_only(spark):
    df = items(spark)
    a = rows(training.stratified_split(df).where("split = 'holdout'"), "uri")
    b = rows(training.stratified_split(df.where("origin = 'real'").repartition(9))
             .where("split = 'holdout'"), "uri")
    assert a == b and all(u.startswith("/r/") for u, in a)
    n = {r["label"]: r["n"] for r in df.where("origin = 'real'").groupBy("label").agg(F.count("*").alias("n")).collect()}
    held = training.stratified_split(df).where("split = 'holdout'").groupBy("label").count().collect()
    assert {r[0]: r[1] for r in held} == {k: round(v * 0.3) for k, v in n.items() if v > 1}
    assert training.stratified_split(df).count() == df.count()


def test_leakage(spark):
    df = spark.createDataFrame(
        [("a", "h1", "train"), ("b", "h1", "holdout"), ("c", "h2", "train"), ("c", "h3", "holdout"), ("d", None, "train")],
        "uri string, content_hash string, split string")
    assert rows(training.leakage_check(df)) == [("content", "h1", 1, 1), ("uri", "c", 1, 1)]


def test_weights_labels_and_shards(spark):
    df = items(spark)
    w = {r["label"]: r for r in training.class_weights(df).collect()}
    total = df.count()
    assert w["solo"]["weight"] == pytest.approx(total / (3 * 1))
    assert rows(training.label_index(df)) == [("cold", 0), ("hot", 1), ("solo", 2)]
    one = training.shuffle_shards(df, 1, 4)
    assert one.rdd.getNumPartitions() == 4 and one.count() == total
    assert rows(one, "uri", "shard") != rows(training.shuffle_shards(df, 2, 4), "uri", "shard")


def test_chat_tokens_repeats_steps(spark):
    turns = spark.createDataFrame([(1, 1, "assistant", "b {role} $1"), (1, 0, "user", "a")],
                                  "conv int, turn int, role string, text string")
    text = training.render_chat(turns, ["conv"], message="[{role}]{text};", generation_prompt="[go]")
    assert rows(text) == [(1, "[user]a;[assistant]b {role} $1;[go]")]
    df = spark.createDataFrame([("a b  c",), ("a b",), (" x ",)], "text string")
    assert rows(training.truncate_tokens(df, 2)) == [
        (" x ", 1, False), ("a b", 2, False), ("a b", 3, True)]
    assert training.repeat_examples(df, 3).count() == 9
    sizes = spark.createDataFrame([(12,), (13,)], "rows int")
    assert rows(training.step_plan(sizes, 10, 1, 1)) == [(12, 120), (13, 130)]


def test_probe_separates_two_classes(spark):
    rng = np.random.default_rng(1)
    data = [(f"/r/{i}", "clean" if i % 2 else "bad", "real",
             (rng.normal(size=4) + (3 if i % 2 else -3)).tolist()) for i in range(80)]
    df = spark.createDataFrame(data, "uri string, label string, origin string, vector array<double>")
    pred = training.train_probe(training.stratified_split(df), keep=["uri"])
    assert rows(evaluation.accuracy(pred), "n", "accuracy") == [(24, 1.0)]
    kpi = evaluation.overkill_at_full_recall(pred).collect()[0]
    assert kpi["overkill"] == 0.0 and kpi["n_clean"] == 12


# ---- evaluation -------------------------------------------------------------

def test_class_report_and_accuracy(spark):
    pairs = [("a", "a")] * 3 + [("a", "b")] + [("b", "b")] * 2 + [("c", "a")]
    df = spark.createDataFrame(pairs, "label string, pred string")
    got = {r["label"]: r for r in evaluation.class_report(df).collect()}
    assert (got["a"]["precision"], got["a"]["recall"], got["a"]["support"]) == (0.75, 0.75, 4)
    assert (got["c"]["precision"], got["c"]["recall"], got["c"]["f1"]) == (0.0, 0.0, 0.0)
    assert got["macro avg"]["recall"] == pytest.approx((0.75 + 1 + 0) / 3)
    assert got["weighted avg"]["precision"] == pytest.approx((0.75 * 4 + 2 / 3 * 2) / 7)
    assert rows(evaluation.accuracy(df), "n", "correct") == [(7, 5)]


def test_overkill(spark):
    df = spark.createDataFrame([("bridge", 0.1), ("missing", 0.4), ("clean", 0.9), ("clean", 0.3)],
                               "label string, p_clean double")
    r = evaluation.overkill_at_full_recall(df).collect()[0]
    assert (r["threshold"], r["overkill"], r["resolution_percent"]) == (0.6, 0.5, 50.0)
    only = evaluation.overkill_at_full_recall(df.where("label = 'clean'")).collect()[0]
    assert only["threshold"] is None and only["overkill"] is None


def test_resolution_flags_a_one_image_change(spark):
    df = spark.createDataFrame([(0, 27 / 28, 28), (1, 26 / 28, 28), (2, 20 / 28, 28)],
                               "round int, accuracy double, n int")
    got = evaluation.metric_resolution(df, "round").orderBy("round").collect()
    assert [r["within_one_step"] for r in got] == [None, True, False]


def test_markers(spark):
    df = spark.createDataFrame([(i, "Bot: x" if i < 3 else "bot: y") for i in range(8)] + [(8, None)],
                               "i int, text string")
    assert rows(evaluation.marker_rate(df.where("i < 8"), "Bot:")) == [(8, 3, 0.375)]
    assert rows(evaluation.marker_rate(df, "Bot:", ["i"], 2)) == [(2, 2, 1.0)]
    assert rows(evaluation.marker_rate(df.where("i > 99"), "Bot:")) == [(0, 0, 0.0)]


# ---- telemetry and registry -------------------------------------------------

def test_last_scalar(spark):
    points = spark.createDataFrame(
        [("a", "voice", "x", 1, "0.2"), ("a", "voice", "x", 2, "0.9"), ("b", "t", "voice", 1, "abc"), ("c", "t", "x", 1, "5")],
        "task_id string, title string, series string, iteration int, value string")
    tasks = points.select("task_id").distinct()
    assert rows(telemetry.last_scalar(points, tasks, "voice")) == [("a", 0.9), ("b", 0.0), ("c", 0.0)]


def test_console_tail(spark):
    df = spark.createDataFrame([("a", i, str(i)) for i in range(10)], "task_id string, line_no int, line string")
    assert rows(telemetry.console_tail(df, 3)) == [("a", 3, "7\n8\n9")]


def test_queue_activity_keeps_idle_queues(spark):
    tasks = spark.createDataFrame([(i, i, "q1" if i > 2 else "q2") for i in range(6)],
                                  "task_id int, last_update int, queue_id string")
    queues = spark.createDataFrame([("q1", "one"), ("q2", "two"), ("q3", "three")], "queue_id string, name string")
    got = [(r["name"], r["recent_tasks"], r["active"]) for r in telemetry.queue_activity(tasks, queues, 3).collect()]
    assert got == [("one", 3, True), ("three", 0, False), ("two", 0, False)]


def test_champion(spark):
    entries = spark.createDataFrame([("east", 0, "t1", 0.9), ("west", 1, "t2", 0.9)],
                                    "side string, side_order int, task_id string, score double")
    models = spark.createDataFrame([("t1", "m1", 0), ("t1", "m2", 1), ("t2", "m3", 0)],
                                   "task_id string, model_id string, ordinal int")
    assert rows(registry.champion(entries, models)) == [
        ("east", "t1", 0.9, "m2", ["champion", "trained-on-east"])]
    with pytest.raises(Exception, match="no model"):
        registry.champion(entries, models.where("task_id = 't2'")).collect()


def test_tags_tasks_and_names(spark):
    models = spark.createDataFrame([("m1", ["A", "B"], 1), ("m2", ["A"], 2)], "model_id string, tags array<string>, created int")
    inst = spark.createDataFrame([(0, "A"), (1, "B"), (2, "C"), (3, None)], "i int, tag string")
    assert rows(registry.resolve_by_tag(inst, models), "i", "model_id") == [(0, "m2"), (1, "m1"), (2, None), (3, None)]
    assert rows(registry.unresolved_tags(inst, models), "i") == [(2,), (3,)]
    tasks = spark.createDataFrame(
        [("n", 1, "completed", 5, "other"), ("n", 2, "queued", 9, "mine"), ("m", 3, "queued", 1, "mine"), ("k", 4, "queued", 1, "other")],
        "name string, task_id int, status string, last_update int, project string")
    assert rows(registry.latest_task(tasks, "^[nmk]$", "mine"), "name", "task_id") == [("m", 3), ("n", 1)]


def test_checks(spark):
    sizes = spark.createDataFrame([(1, 103), (2, 103), (3, 120)], "round int, size int")
    assert rows(checks.growth_check(sizes, "round", "size"), "round", "grew") == [(1, None), (2, False), (3, True)]
    a = spark.createDataFrame([("x", 2), ("y", 1)], "label string, have int")
    e = spark.createDataFrame([("x", 2), ("z", 1)], "label string, have int")
    assert rows(checks.expected_counts(a, e)) == [("x", 2, 2, True), ("y", 0, 1, False), ("z", 1, 0, False)]
    r = spark.createDataFrame([(0, 0.5), (1, 0.75), (2, 0.5)], "round int, accuracy double")
    assert rows(checks.round_history(r), "round", "gain_over_previous", "gain_over_baseline") == [
        (0, None, 0.0), (1, 0.25, 0.25), (2, -0.25, 0.0)]
    assert statistics.median([1, 2]) == 1.5


def test_guards(spark):
    from larkspur.operators import checks
    from larkspur.sources.pairs import EmptyDataset
    scores = spark.createDataFrame([("a", float("nan")), ("b", None)], "uri string, nn_score double")
    masks = spark.createDataFrame([("t", 0)], "texture string, masks bigint")
    with pytest.raises(EmptyDataset, match="score"):
        checks.require_scores(scores)
    with pytest.raises(EmptyDataset, match="masks"):
        checks.require_masks(masks)
    with pytest.raises(EmptyDataset, match="9 training items"):
        checks.require_training_items(spark.range(9))
    assert checks.require_training_items(spark.range(10)).count() == 10
    assert checks.require_scores(scores.unionByName(spark.createDataFrame([("c", 0.1)], scores.schema))).count() == 3
