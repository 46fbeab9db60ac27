"""Distributed order statistics against plain Python, with a hot group and ties."""

import hashlib
import random
import statistics

import pytest
from pyspark.sql import functions as F

from comparing import rows
from larkspur.plans import order_stats as o


def data(seed, hot=3000, ties=True):
    rnd = random.Random(seed)
    out = []
    for g, n in (("hot", hot), ("mid", 200), ("two", 2), ("one", 1), (None, 30)):
        for i in range(n):
            v = rnd.choice([1.0, 1.0, 5.0]) if ties and rnd.random() < 0.5 else rnd.random() * 9
            out.append((g, f"{g}-{i}", v))
    out += [("hot", "nan", float("nan")), ("hot", "null", None)]
    return out


def by_group(items):
    groups = {}
    for g, uid, v in items:
        groups.setdefault(g, []).append((uid, v))
    return groups


def real(pairs):
    return [(u, v) for u, v in pairs if v is not None and v == v]


def md5(s):
    return hashlib.md5(s.encode()).hexdigest()


@pytest.mark.parametrize("seed", [1, 2])
def test_group_medians(spark, seed):
    items = data(seed)
    df = spark.createDataFrame(items, "g string, uid string, v double").repartition(7)
    want = sorted(((g, len(real(p)), statistics.median(v for _, v in real(p)))
                   for g, p in by_group(items).items()), key=repr)
    assert rows(o.group_medians(df, ["g"], "v")) == want
    total = [v for _, _, v in items if v is not None and v == v]
    assert rows(o.group_medians(df, [], "v")) == [(len(total), statistics.median(total))]


def test_median_of_nothing_is_no_row(spark):
    df = spark.createDataFrame([("a", float("nan"))], "g string, v double")
    assert rows(o.group_medians(df, ["g"], "v")) == []
    assert rows(o.group_medians(df, [], "v")) == []


def test_take_hashed(spark):
    items = data(3)
    df = spark.createDataFrame(items, "g string, uid string, v double").repartition(5)
    quotas = {"hot": 1234, "mid": 0, "two": 9, None: 10}
    q = spark.createDataFrame(list(quotas.items()), "g string, quota int")
    got = rows(o.take_hashed(df, ["g"], q, "quota", "uid"), "g", "uid")
    want = []
    for g, pairs in by_group(items).items():
        chosen = sorted((u for u, _ in pairs), key=lambda u: (md5(u), u))
        want += [(g, u) for u in chosen[:quotas.get(g, 0)]]
    assert got == sorted(want, key=repr)
    # groups without a quota are kept by the marking form, untaken
    marked = o.mark_hashed(df, ["g"], q, "quota", "uid")
    assert marked.count() == len(items)
    assert marked.where("g = 'one' and taken").count() == 0


@pytest.mark.parametrize("bracket_rows", [5, 10**6])
@pytest.mark.parametrize("quota", [0, 1, 700, 1600, 2999, 10**6])
def test_take_top(spark, bracket_rows, quota):
    items = data(4)
    df = spark.createDataFrame(items, "g string, uid string, v double").repartition(5)
    q = spark.createDataFrame([("hot", quota), ("mid", 7), ("two", 1), (None, 5)], "g string, quota int")
    got = rows(o.take_top(df, ["g"], q, "quota", "v", "uid", bracket_rows), "g", "uid")
    limits, want = {"hot": quota, "mid": 7, "two": 1, None: 5}, []
    for g, pairs in by_group(items).items():
        best = sorted(real(pairs), key=lambda p: (-p[1], md5(p[0]), p[0]))
        want += [(g, u) for u, _ in best[:limits.get(g, 0)]]
    assert got == sorted(want, key=repr)


def test_previous_value_crosses_buckets(spark):
    from pyspark.sql import functions as F
    rnd = random.Random(5)
    items = [(k, i, rnd.choice("abc")) for k in (1, 2) for i in rnd.sample(range(1000), 300)]
    df = spark.createDataFrame(items, "k int, i int, s string").repartition(6)
    got = rows(o.previous_value(df, "k", ["i"], "s", F.expr("i div 50"), "p"), "k", "i", "p")
    want = []
    for k in (1, 2):
        seq = sorted((i, s) for kk, i, s in items if kk == k)
        want += [(k, i, seq[n - 1][1] if n else None) for n, (i, _) in enumerate(seq)]
    assert got == sorted(want, key=repr)


def test_medians_of_crowded_and_missing_brackets(spark, monkeypatch):
    """A bracket is cut into bins until it is small, and widened when it misses."""
    items = data(6)
    df = spark.createDataFrame(items, "g string, uid string, v double").repartition(7)
    want = sorted(((g, statistics.median(v for _, v in real(p))) for g, p in by_group(items).items()), key=repr)
    assert rows(o.group_stats(df, ["g"], "v", bracket_rows=3), "g", "median") == want
    wrong = spark.createDataFrame([(g, 100.0, 200.0) for g in by_group(items)], "g string, _lo double, _hi double")
    values = o._finite(df, ["g"], "v")
    found = o._brackets(values, ["g"], wrong, o.F.lit(1), o.F.lit(1)).collect()
    lowest = {g: min(v for _, v in real(p)) for g, p in by_group(items).items()}
    assert all(r["_lo"] <= lowest[r["g"]] <= r["_hi"] for r in found)


def test_one_group_with_most_rows_is_spread(spark):
    """No task of the ranking stages reads more than a sliver of a group that holds 90 % of the rows."""
    n = 20_000
    df = spark.range(n).selectExpr("IF(id % 10 = 0, 'rest', 'hot') AS g", "CAST(id AS STRING) AS uid",
                                   "CAST(hash(id) AS DOUBLE) AS v")
    rows_ = o._finite(df, ["g"], "v")
    bounds = spark.createDataFrame([("hot", -1e10, 1e10), ("rest", -1e10, 1e10)], "g string, _lo double, _hi double")
    found = o._brackets(rows_, ["g"], bounds, o.F.expr("(n + 1) div 2"), o.F.expr("n div 2 + 1"), bracket_rows=100)
    assert all(r["_inside"] <= 100 for r in found.collect())


def test_previous_value_of_null(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, None), (1, 12, "b"), (1, 13, "b")], "k int, i int, s string")
    got = rows(o.previous_value(df, "k", ["i"], "s", o.F.expr("i div 10"), "p"), "i", "p")
    assert dict(got) == {1: None, 2: "a", 12: None, 13: "b"}


def test_quotas_do_not_shuffle_rows_by_group(spark, monkeypatch):
    """The quotas of `quota_sample` are an aggregate, whose size a planner does not know before it has shuffled both sides."""
    df = spark.createDataFrame(data(3) * 4, "g string, uid string, v double").repartition(5)
    quotas = df.groupBy("g").agg((F.count(F.lit(1)) / 2).cast("bigint").alias("quota"))
    plans = []

    def watched(rows, facts, keys, how="inner", real=o.attach):
        joined = real(rows, facts, keys, how)
        plans.append(joined._jdf.queryExecution().executedPlan().toString())
        return joined

    monkeypatch.setattr(o, "attach", watched)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20k")
    try:
        o.take_hashed(df, ["g"], quotas, "quota", "uid")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(plans) == 4 and all("BroadcastHashJoin" in p and "SortMergeJoin" not in p for p in plans)
