"""The enrichment loop: its policy tables, and being killed at any step."""

import pytest
from pyspark.sql import functions as F

from comparing import rows
from larkspur.operators.frames import frame_meta, make_frames
from larkspur.plans import rounds as loop
from larkspur.plans import versions as vs
from larkspur.plans.commit_log import CommitLog


def vec(label, i):
    return [(3.0 if label == "a" else -3.0) + (i % 7) / 10, float(i % 5) / 10]


@pytest.fixture
def tables(spark):
    real = spark.createDataFrame(
        [(i, f"/r/{i}", lab, "real", vec(lab, i)) for i, lab in enumerate(["a"] * 20 + ["b"] * 8)],
        "item_id bigint, uri string, label string, origin string, vector array<double>")
    pool = spark.createDataFrame(
        [(1000 + i, f"/p/{i}", f"t+{x}", x, vec(x, i)) for x in "ab" for i in range(60) if i % 2 == (x == "a")],
        "item_id bigint, uri string, defect_type string, label string, vector array<double>")
    return real, pool


def start(spark, root, real):
    store = vs.VersionStore(spark, str(root))
    store.publish("d", "v1-real", make_frames(frame_meta(
        real.withColumns({"labels": F.array("label"), "run_id": F.lit(None).cast("string")}))))
    return store


def outcome(history):
    return rows(history, "round", "published", "verified", "short", "accuracy", "n")


class Killed(BaseException):
    pass


def counted(real, made, max_iter):
    """In place of a probe: what it would be given."""
    n = 0 if made is None else made.count()
    return {"accuracy": n / 100, "n": real.count(), "training_rows": n, "synthetic_rows": n}


@pytest.mark.parametrize("after", [6, 13])
def test_a_killed_loop_goes_on(spark, tmp_path, tables, monkeypatch, after):
    real, pool = tables
    monkeypatch.setattr(loop, "measure", counted)
    kwargs = dict(rounds=1, budget=6, target=14)
    want = outcome(loop.run_rounds(start(spark, tmp_path / "whole", real), "d", real, pool, **kwargs))
    store = start(spark, tmp_path / "killed", real)
    append, steps = CommitLog.append, []

    def dying(self, decide, attempts=100):
        if self.ddl.startswith("step"):
            if len(steps) == after:
                raise Killed
            steps.append(1)
        return append(self, decide, attempts)

    monkeypatch.setattr(CommitLog, "append", dying)
    with pytest.raises(Killed):
        loop.run_rounds(store, "d", real, pool, state=str(tmp_path / "state"), **kwargs)
    monkeypatch.setattr(CommitLog, "append", append)
    done = {p.name for p in (tmp_path / "state" / "tables").iterdir()}
    assert outcome(loop.run_rounds(store, "d", real, pool, state=str(tmp_path / "state"), **kwargs)) == want
    log = CommitLog(spark, str(tmp_path / "state" / "log"), "step string, path string, facts string").entries()
    assert log.count() == log.select("step").distinct().count() and log.count() > after
    kept = {r["path"].rsplit("/", 1)[1] for r in log.where("path IS NOT NULL").collect()}
    assert len(done - kept) <= 1  # what was whole when it died is used, not written again
    # published and registered once, whenever it died
    assert store.versions().where("published").count() == len(want) and store.models().count() == len(want) - 1


def test_policies_are_tables(spark, tmp_path, tables, monkeypatch):
    real, pool = tables
    monkeypatch.setattr(loop, "measure", counted)
    store = start(spark, tmp_path / "s", real)
    allocation = spark.createDataFrame([(1, "t+a", "a", 2), (1, "t+b", "b", 3), (2, "t+a", "a", 1)],
                                       "round int, defect_type string, label string, asked int")
    threshold = spark.createDataFrame([(1, -2.0), (2, 2.0)], "round int, threshold double")
    grid = spark.createDataFrame([(1, 7.0, 2.0), (2, 9.0, 1.0), (3, 5.0, 1.0)], "search int, guidance double, crop_ratio double")
    state = str(tmp_path / "state")
    got = loop.run_rounds(store, "d", real, pool, 2, 99, 1, allocation=allocation, threshold=threshold,
                          grid=grid, state=state)
    # nothing is short of 1, yet the allocation asks; no score reaches a bar of 2, so the second round verifies nothing
    assert [r[1:3] for r in outcome(got)] == [(0, 0), (5, 5), (1, 0)]
    steps = loop.Steps(spark, state)
    tried = [steps.table(f"loop-round1/attempt{k}", lambda: None) for k in range(4)]
    assert [t.count() for t in tried] == [5] * 4
    assert [rows(t.select("guidance", "crop_ratio").distinct())[0] for t in tried] == [
        (None, None), (7.0, 2.0), (9.0, 1.0), (5.0, 1.0)]
    assert dict(rows(store.label_counts(store.latest("d")["version_id"]), "label", "have"))["pending-review"] == 1


def test_what_is_owed_is_drawn_again(spark, tmp_path, tables):
    """Samples whose attempts all miss the bar are replaced by other rows that reach it."""
    real, pool = tables
    far = spark.createDataFrame([(5000 + i, f"/f/{i}", "t+b", "b", [3.0, -3.0]) for i in range(6)], pool.schema)
    good = pool.where("label = 'b'").limit(12)
    split = spark.createDataFrame([("t+b", "b", 4)], "defect_type string, label string, asked bigint")
    bar = spark.createDataFrame([(0.9,)], "threshold double")
    mixed = far.unionByName(good)
    found = loop.search_samples(loop.Steps(spark, str(tmp_path / "x")), "x", real, mixed, split, "seed",
                                loop.default_grid(spark, 1), bar)
    picked = found.where("picked IS NOT NULL")
    assert picked.count() == 4 and picked.where("nn_score < 0.9").count() == 0
    assert picked.select("item_id").distinct().count() == 4


def test_no_dataset_and_no_version_differ(spark, tmp_path, tables):
    store = vs.VersionStore(spark, str(tmp_path / "s"))
    with pytest.raises(vs.PublishError, match="there is no dataset"):
        loop.run_rounds(store, "d", *tables, 1, 5)
    store.draft("d", "v1")
    with pytest.raises(vs.PublishError, match="no published version"):
        loop.run_rounds(store, "d", *tables, 1, 5)
