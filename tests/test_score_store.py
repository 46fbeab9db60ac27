"""Medians over accumulated runs against plain Python, and what is read for them."""

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from comparing import rows
from larkspur.plans.commit_log import Conflict
from larkspur.plans.order_stats import stats_within
from larkspur.plans.score_store import ScoreStore, histogram, merged, score_bin

SCHEMA = "run_id string, kind string, nn_score double"


def test_bins_grow_with_scores(spark):
    rnd = random.Random(1)
    near = [x for k in range(-1074, 1024) for x in (2.0 ** k, math.nextafter(2.0 ** k, 0), math.nextafter(2.0 ** k, math.inf))]
    values = sorted({*near, *[rnd.uniform(-1, 1) * 10 ** rnd.randrange(-300, 300) for _ in range(3000)], 0.0, -0.0, 1.0,
                     float("inf"), float("-inf"), *[-x for x in near]})
    got = spark.createDataFrame([(v,) for v in values], "v double").select("v", score_bin(F.col("v")).alias("b")).collect()
    got = sorted((r["v"], r["b"]) for r in got)
    assert all(a[1] <= b[1] for a, b in zip(got, got[1:]))
    assert dict(got)[0.0] == 0


def sample(seed, n=400):
    rnd = random.Random(seed)
    return [(f"r{rnd.randrange(6)}" if rnd.random() < 0.7 else "r0", rnd.choice(["a", "b", None]),
             rnd.choice([0.5, 0.5, rnd.gauss(0, 3), rnd.random(), -0.0, None, float("nan")])) for _ in range(n)]


def plain(items, key):
    groups = {}
    for x in items:
        if x[2] is not None and x[2] == x[2]:
            groups.setdefault(key(x), []).append(x[2])
    return {k: (len(v), min(v), statistics.median(v), max(v)) for k, v in groups.items()}


@pytest.mark.parametrize("seed", [1, 2])
def test_stats_over_all_runs(spark, tmp_path, seed):
    items = sample(seed)
    store = ScoreStore(spark, str(tmp_path / "s"), ["kind"])
    df = spark.createDataFrame(items, SCHEMA)
    assert store.stats().count() == 0
    assert store.add_runs(df.where("run_id < 'r3'")) == ["r0", "r1", "r2"]
    assert store.add_runs(df) == ["r3", "r4", "r5"] and store.add_runs(df) == []
    for keys, key in ((["run_id"], lambda x: (x[0],)), (["kind"], lambda x: (x[1],)), ([], lambda x: ()),
                      (["run_id", "kind"], lambda x: (x[0], x[1]))):
        got = {tuple(r[k] for k in keys): (r["n"], r["min"], r["median"], r["max"]) for r in store.stats(keys).collect()}
        want = plain(items, key)
        assert got.keys() == want.keys()
        assert all(got[k] == pytest.approx(want[k], abs=1e-15) for k in want)


def test_crowded_bins(spark):
    """Bins of more values than are ranked at once are cut further."""
    rnd = random.Random(3)
    items = [("r", "a", 1 + rnd.random() / 300) for _ in range(3000)] + [("r", "b", 2.0)] * 50
    df = spark.createDataFrame(items, SCHEMA).select("kind", F.col("nn_score").alias("_v"))
    bins = merged(histogram(df, ["kind"], "_v"), ["kind"])
    got = stats_within(bins, lambda r: df.join(r.select("kind"), "kind", "left_semi"), ["kind"], bracket_rows=100)
    want = plain(items, lambda x: x[1])
    assert {r["kind"]: (r["n"], r["min"], r["median"], r["max"]) for r in got.collect()} == want


def test_only_the_middle_is_read(spark, tmp_path):
    """A commit reads its own run; a median over all runs reads the scores of one or two bins."""
    store = ScoreStore(spark, str(tmp_path / "s"))
    for run in range(4):
        store.add_runs(spark.range(5000).select(F.lit(f"r{run}").alias("run_id"), ((F.col("id") * 4 + run) / 10.0).alias("nn_score")))
    asked = []
    between = store._between

    def counted(ranges, keys):
        out = between(ranges, keys)
        asked.append((out.count(), out._jdf.queryExecution().executedPlan().toString()))
        return out

    store._between = counted
    assert rows(store.stats()) == [(20000, 0.0, 999.95, 1999.9)]
    assert len(asked) == 1 and 0 < asked[0][0] <= 20000 / 256 * 2  # 1000 lies in a bin of width 2 of 2000
    assert "PushedFilters: [IsNotNull(nn_score), GreaterThanOrEqual(nn_score," in asked[0][1]


def test_a_run_is_added_once_by_several_writers(spark, tmp_path):
    one = ScoreStore(spark, str(tmp_path / "s"))
    two = ScoreStore(spark, str(tmp_path / "s"))
    df = spark.createDataFrame([("r", "a", 1.0)], SCHEMA)
    real, none = two.runs, two.runs().where("false")
    calls = iter([none])
    two.runs = lambda: next(calls, real())  # looks before the other writer is done, and again at its own entry
    one.add_runs(df)
    with pytest.raises(Conflict, match="r"):
        two.add_runs(df)
    assert rows(one.stats()) == [(1, 1.0, 1.0, 1.0)]
