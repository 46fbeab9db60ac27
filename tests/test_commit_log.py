"""Several writers: one order of entries, one order of versions, nothing lost."""

import threading

import pytest
from pyspark.sql import functions as F

from comparing import rows
from larkspur.operators.frames import frame_meta, make_frames, version_stats
from larkspur.plans import versions as vs
from larkspur.plans.commit_log import CommitLog, Conflict, put_if_absent
from test_store import gated, labels, store  # noqa: F401


def together(*work):
    """Run all at once; returns what they raised."""
    failed = []

    def run(fn):
        try:
            fn()
        except Exception as e:  # noqa: BLE001
            failed.append(e)

    threads = [threading.Thread(target=run, args=(fn,)) for fn in work]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    return failed


def framed(df):
    return make_frames(frame_meta(df.withColumn("labels", F.array("label"))))


def test_one_writer_gets_a_name(spark, tmp_path):
    won = []
    assert not together(*[lambda k=k: won.append((put_if_absent(spark, str(tmp_path / "x"), b"%d" % k), k)) for k in range(8)])
    assert sorted(w for w, _ in won) == [False] * 7 + [True]
    assert (tmp_path / "x").read_text() == str(next(k for w, k in won if w))
    assert [p.name for p in tmp_path.iterdir() if not p.name.endswith(".crc")] == ["x"]


def test_entries_have_one_order(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "log"), "who int, seen bigint")
    assert log.size() == 0 and log.entries().count() == 0

    def write(who):
        own = CommitLog(spark, str(tmp_path / "log"), "who int, seen bigint")
        for _ in range(5):
            own.append(lambda last: {"who": who, "seen": last})

    assert not together(*[lambda w=w: write(w) for w in range(4)])
    got = sorted(rows(log.entries(), "entry", "seen"))
    assert got == [(n, n - 1) for n in range(1, 21)]
    assert rows(log.entries().groupBy("who").count()) == [(w, 5) for w in range(4)]


def test_two_writers_lose_nothing(spark, store):  # noqa: F811
    def write(who):
        own = vs.VersionStore(spark, store.root)
        for k in range(2):
            own.publish_run("d", gated(spark, f"{who}{k}", who, "z"), who)

    assert not together(lambda: write("a"), lambda: write("b"))
    last = store.latest("d")
    assert len(last["lineage"]) == 5 and dict(labels(store, last["version_id"])) == {"a": 4, "b": 3, "z": 4}
    chain = rows(store.versions().where("published"), "name", "lineage")
    assert sorted(len(x) for _, x in chain) == [1, 2, 3, 4, 5] and len({n for n, _ in chain}) == 5
    by_length = sorted((x for _, x in chain), key=len)
    assert all(b[1:] == a for a, b in zip(by_length, by_length[1:]))  # each on top of the one before
    frames = store.effective(last)
    assert frames.count() == 3 + 8 and rows(store.runs(last["version_id"])) == [("a0",), ("a1",), ("b0",), ("b1",)]
    stats = version_stats(frames.withColumn("version_id", F.lit(last["version_id"])))
    assert rows(stats.where("dimension = 'labels'"), "name", "count") == labels(store, last["version_id"])


def test_the_same_run_from_two_writers_is_published_once(spark, store):  # noqa: F811
    parent = store.latest("d")
    first = store.draft("d", "v2-x", parent)
    second = store.draft("d", "v3-y", parent)
    first.add(framed(gated(spark, "r1", "a")))
    second.add(framed(gated(spark, "r1", "a")))
    first.publish()
    with pytest.raises(Conflict, match="r1"):
        second.publish()
    second.abort()
    assert store.publish_run("d", gated(spark, "r1", "a"), "again") is None
    assert labels(store, store.latest("d")["version_id"]) == [("a", 3), ("b", 1)]


def test_a_draft_that_lost_its_place_moves_on_top(spark, store):  # noqa: F811
    late = store.draft("d", "v2-late", store.latest("d"))
    assert late.add(framed(gated(spark, "r1", "a"))) == 1 and late.add(framed(gated(spark, "r1", "c", "c"))) == 2
    between = store.publish_run("d", gated(spark, "r2", "b"), "between")
    assert store.latest("d")["version_id"] == between
    late.publish()
    last = store.latest("d")
    assert last["name"] == "v2-late" and last["parent_id"] == between
    assert labels(store, last["version_id"]) == [("a", 3), ("b", 2), ("c", 2)]
    with pytest.raises(vs.PublishError):
        late.add(framed(gated(spark, "r3", "a")))


def test_an_aborted_draft_leaves_nothing(spark, store, tmp_path):  # noqa: F811
    draft = store.draft("d", "v2-x", store.latest("d"))
    draft.add(framed(gated(spark, "r1", "a")))
    with pytest.raises(vs.PublishError):  # the name is taken while the draft is there
        store.publish("d", "v2-x", framed(gated(spark, "r2", "a")))
    draft.abort()
    assert not list(tmp_path.glob(f"**/*{draft.version_id}*"))
    store.publish("d", "v2-x", framed(gated(spark, "r2", "a")), store.latest("d"))
    assert rows(store.versions(), "name") == [("v1-real",), ("v2-x",)]


def test_nothing_published_is_not_the_same_as_unknown(spark, store):  # noqa: F811
    store.draft("e", "v1")
    assert store.latest("e") is None and store.known("e")
    assert store.latest("f") is None and not store.known("f")


def test_models_of_two_writers(spark, store):  # noqa: F811
    v = store.latest("d")["version_id"]
    assert not together(*[lambda k=k: store.register_model(f"m{k}", v, k, 0, None, None) for k in range(4)])
    assert rows(store.models(), "name", "training_rows") == [(f"m{k}", k) for k in range(4)]
    assert store.models().collect()[0]["label_counts"] == {"a": 2, "b": 1}
