import pytest
from pyspark.sql import functions as F

from comparing import rows
from larkspur.operators.frames import frame_meta, make_frames
from larkspur.operators.gap import gap_report
from larkspur.operators.registry import lineage, version_history
from larkspur.plans import versions as vs
from larkspur.plans.rounds import run_rounds


def gated(spark, run, *labels, verified=True):
    data = [(f"/s/v/{run}/{i}.png", x, "synthetic", "IC", x, "anomaly", verified, run) for i, x in enumerate(labels)]
    return spark.createDataFrame(
        data, "uri string, label string, origin string, texture string, defect string, kind string, verified boolean, run_id string")


@pytest.fixture
def store(spark, tmp_path):
    s = vs.VersionStore(spark, str(tmp_path / "store"))
    first = gated(spark, "real", "a", "a", "b").withColumns(
        {"origin": F.lit("real"), "labels": F.array("label"), "run_id": F.lit(None).cast("string")})
    s.publish("d", "v1-real", make_frames(frame_meta(first)))
    return s


def labels(store, version):
    return rows(store.label_counts(version), "label", "have")


def test_publishing_builds_on_the_parent(spark, store):
    v2 = store.publish_run("d", gated(spark, "r1", "a", "c"), "made")
    assert store.latest("d")["name"] == "v2-made"
    assert labels(store, v2) == [("a", 3), ("b", 1), ("c", 1)]
    # stats at commit agree with the frames themselves
    from larkspur.operators.frames import version_stats
    frames = store.effective(store.latest("d")).withColumn("version_id", F.lit(v2))
    direct = version_stats(frames).where("dimension = 'labels'")
    assert rows(direct, "name", "count") == labels(store, v2)
    assert rows(gap_report(store.label_counts(v2), 2), "label", "short") == [("a", 0), ("b", 1), ("c", 1)]


def test_a_run_is_published_once(spark, store):
    v2 = store.publish_run("d", gated(spark, "r1", "a"), "made")
    assert store.publish_run("d", gated(spark, "r1", "a"), "made") is None
    assert store.latest("d")["version_id"] == v2
    both = gated(spark, "r1", "a").unionByName(gated(spark, "r2", "a"))
    v3 = store.publish_run("d", both, "made")
    assert labels(store, v3) == [("a", 4), ("b", 1)]
    assert store.latest("d")["lineage"][0] == v3 and len(store.latest("d")["lineage"]) == 3


def test_a_failed_publish_stays_invisible(spark, store):
    bad = gated(spark, "r9", "a").withColumn("label", F.raise_error(F.lit("boom")).cast("string"))
    with pytest.raises(Exception, match="boom"):
        store.publish_run("d", bad, "made")
    assert store.latest("d")["name"] == "v1-real"
    with pytest.raises(vs.PublishError):
        store.publish("d", "v1-real", spark.range(1).select(F.lit("x").alias("uri")), framed=False)


def test_drafts_count_for_names_but_not_for_readers(spark, store):
    store.publish("d", "v7-draft", make_frames(frame_meta(
        gated(spark, "r1", "a").withColumn("labels", F.array("label")))), published=False)
    assert store.next_name("d") == "v8" and store.next_name("none") == "v1"
    assert store.latest("d")["name"] == "v1-real"
    assert rows(vs.next_version_name(store.versions()), "next_name") == [("v8",)]
    assert rows(vs.latest_published(store.versions()), "name") == [("v1-real",)]
    assert vs.find_dataset(store.versions(), "D").count() == 0


def test_names_that_are_no_versions(spark):
    df = spark.createDataFrame([("d", n) for n in ("v1-real", "v2-a", "v10-x", "draft", "xv99")], "dataset_id string, name string")
    assert rows(vs.next_version_name(df)) == [("d", "v11")]
    assert rows(vs.next_version_name(df.where("name = 'draft'"))) == [("d", "v1")]


def test_ancestry_of_a_long_chain(spark):
    n = 150
    df = spark.createDataFrame([(f"v{i}", f"v{i - 1}" if i else None) for i in range(n)] + [("w", None)],
                               "version_id string, parent_id string")
    got = vs.ancestry(df)
    assert got.count() == n * (n + 1) // 2 + 1
    last = got.where(f"version_id = 'v{n - 1}'")
    assert rows(last.where("depth in (0, 100)"), "ancestor", "depth") == [("v149", 0), ("v49", 100)]
    full = vs.with_lineage(df).where("version_id = 'v2'").collect()[0]
    assert full["lineage"] == ["v2", "v1", "v0"]


def test_real_data_is_registered_once(spark, tmp_path):
    for rel in ("IC/anomaly_image/bridge/1.png", "IC/clean_image/2.jpg", "IC/mask/bridge/3.png"):
        p = tmp_path / "tree" / rel
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text("x")
    s = vs.VersionStore(spark, str(tmp_path / "s"))
    first, counts = s.register_real("d", "v1-real", str(tmp_path / "tree"))
    again, counts2 = s.register_real("d", "v1-real", str(tmp_path / "tree"))
    assert first == again and s.versions().count() == 1
    assert rows(counts) == rows(counts2) == [("bridge", 1), ("clean", 1), ("mask", 1)]


def test_lineage_and_history(spark, store):
    v2 = store.publish_run("d", gated(spark, "r1", "a", "c"), "made")
    store.register_model("m", v2, 5, 2, 0.5, 0.9, ["champion"])
    seen = lineage(store.models(), store.versions(), vs.frame_rows(store.effective(store.latest("d"))))
    assert rows(seen, "origin", "run_id", "label", "frames") == sorted([
        ("real", None, "a", 2), ("real", None, "b", 1), ("synthetic", "r1", "a", 1), ("synthetic", "r1", "c", 1)], key=repr)
    model = store.models().collect()[0]
    assert model["label_counts"] == {"a": 3, "b": 1, "c": 1} and model["training_rows"] == 5
    history = version_history(store.versions(), store.models()).collect()
    assert [(r["name"], r["model_name"]) for r in history] == [("v1-real", None), ("v2-made", "m")]


def test_label_changes(spark):
    b = spark.createDataFrame([("x",), ("y",)], "label string")
    a = spark.createDataFrame([("y",), ("z",), ("z",)], "label string")
    assert rows(vs.label_changes(b, a)) == [("x", "removed"), ("z", "added")]


def test_rounds_stop_and_improve_nothing_they_did_not_publish(spark, tmp_path):
    def vec(label, i):
        return [(3.0 if label == "a" else -3.0) + (i % 7) / 10, float(i % 5) / 10]

    real = spark.createDataFrame(
        [(i, f"/r/{i}", lab, "real", vec(lab, i)) for i, lab in enumerate(["a"] * 20 + ["b"] * 8)],
        "item_id bigint, uri string, label string, origin string, vector array<double>")
    pool = spark.createDataFrame(
        [(1000 + i, f"/p/{i}", "t+b", "b", vec("b", i)) for i in range(60)],
        "item_id bigint, uri string, defect_type string, label string, vector array<double>")
    s = vs.VersionStore(spark, str(tmp_path / "rounds"))
    first = real.withColumns({"labels": F.array("label"), "run_id": F.lit(None).cast("string")})
    s.publish("d", "v1-real", make_frames(frame_meta(first)))
    h = run_rounds(s, "d", real, pool, rounds=4, budget=8, target=16, max_iter=50).orderBy("round").collect()
    assert h[0]["round"] == 0 and h[0]["accuracy"] == 1.0
    n = h[0]["n"]
    assert all(r["n"] == n for r in h)  # the same exam every round
    have = dict(labels(s, s.latest("d")["version_id"]))
    assert have["b"] == 8 + sum(r["verified"] for r in h)
    assert have["a"] == 20
    assert s.models().count() == len(h) - 1
    frames = vs.frame_rows(s.effective(s.latest("d")))
    assert frames.groupBy("uri").count().where("count > 1").count() == 0
