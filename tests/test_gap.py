import math
import random

import pytest
from pyspark.sql import functions as F

from comparing import rows
from larkspur.operators import gap


def counts(spark, **have):
    return spark.createDataFrame(list(have.items()), "label string, have bigint")


def test_gap_report(spark):
    df = counts(spark, missing=62, excess_solder=16, bridge=8, clean=5, mask=86)
    got = {r["label"]: (r["short"], r["at_target"]) for r in gap.gap_report(df).collect()}
    assert got == {"missing": (0, True), "excess_solder": (44, False), "bridge": (52, False)}


def test_gap_lists_absent_classes_only_with_a_catalogue(spark):
    catalog = spark.createDataFrame([("scratch",), ("bridge",)], "label string")
    got = gap.gap_report(counts(spark, bridge=8), 60, catalog=catalog)
    assert rows(got, "label", "have", "short") == [("bridge", 8, 52), ("scratch", 0, 60)]


def test_thinnest(spark):
    df = gap.gap_report(counts(spark, b=8, a=8, c=20))
    assert rows(gap.thinnest_class(df)) == [("a", 52)]
    full = gap.gap_report(counts(spark, b=80))
    assert rows(gap.thinnest_class(full)) == [("solder_bridge", 0)]


def allocate(spark, short, types, budget):
    g = spark.createDataFrame(list(short.items()), "label string, short bigint")
    t = spark.createDataFrame([(x,) for x in types], "defect_type string")
    return {r["defect_type"]: r["asked"] for r in gap.allocate_budget(g, t, budget).collect()}


def test_allocation_examples(spark):
    assert allocate(spark, {"bridge": 52, "excess_solder": 44},
                    ["IC+bridge", "passive_component+missing", "passive_component+excess_solder"], 24
                    ) == {"IC+bridge": 13, "passive_component+excess_solder": 11}
    shared = ["IC+missing", "passive_component+missing", "IC+bridge"]
    short = {"missing": 10, "bridge": 3}
    assert allocate(spark, short, shared, 7) == {
        "IC+missing": 3, "passive_component+missing": 2, "IC+bridge": 2}
    assert allocate(spark, short, shared, 1) == {
        "IC+missing": 1, "passive_component+missing": 0, "IC+bridge": 0}
    assert allocate(spark, {"other": 5}, shared, 7) == {}


def test_allocation_properties_over_many_groups(spark):
    rnd = random.Random(7)
    g, t, budgets = [], [], {}
    for k in range(60):
        budgets[k] = rnd.randint(0, 40)
        for i in range(rnd.randint(1, 6)):
            g.append((k, f"c{i}", rnd.choice([0, 1, 5, rnd.randint(1, 300)]), budgets[k]))
            t += [(k, f"t{j}+c{i}") for j in range(rnd.randint(1, 3))]
    gdf = spark.createDataFrame(g, "k int, label string, short int, budget int")
    tdf = spark.createDataFrame(t, "k int, defect_type string")
    got = {}
    for r in gap.allocate_budget(gdf, tdf, F.col("budget"), ["k"]).collect():
        got.setdefault(r["k"], {})[r["defect_type"]] = r["asked"]
    short = {(k, label): s for k, label, s, _ in g}
    for k, parts in got.items():
        needy = {d for kk, d in t if kk == k and short[k, d.split("+")[-1]] > 0}
        assert set(parts) == needy
        assert sum(parts.values()) == budgets[k]
        if budgets[k] > len(needy):
            assert min(parts.values()) >= 1
        shares = {d: short[k, d.split("+")[-1]] for d in parts}
        heavy = max(shares, key=shares.get)
        assert parts[heavy] >= 0 and math.isfinite(parts[heavy])


def test_asked_vs_got(spark):
    alloc = spark.createDataFrame([("IC+b", 5, 3), ("IC+c", 5, 2)], "defect_type string, short int, asked int")
    made = spark.createDataFrame([("IC+b",)] * 2 + [("IC+c",)] * 2, "defect_type string")
    assert rows(gap.asked_vs_got(alloc, made), "defect_type", "got", "is_short") == [
        ("IC+b", 2, True), ("IC+c", 2, False)]


def test_before_after(spark):
    got = gap.before_after(counts(spark, a=1, b=2), counts(spark, b=5, c=1))
    assert rows(got) == [("a", 1, 0, -1), ("b", 2, 5, 3), ("c", 0, 1, 1)]


def test_budget_map(spark):
    df = spark.createDataFrame([(1, "bridge:52, excess_solder:44,"), (2, "a:x"), (3, "a:1,a:2"), (4, ""), (5, "p:9,q:1,r:2,s:33,t:224")],
                               "k int, c string")
    assert rows(gap.budget_map(df, "c", ["k"]), "k", "label", "count") == [
        (1, "bridge", 52), (1, "excess_solder", 44), (2, "a", None), (3, "a", 2),
        (5, "p", 9), (5, "q", 1), (5, "r", 2), (5, "s", 33), (5, "t", 224)]


def test_draw_grid(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "round int")
    assert rows(gap.draw_grid(df, "round")) == [(1, 4.0, 1.5), (2, 10.0, 3.0), (3, 4.0, 1.5)]


@pytest.mark.parametrize("asked", [1, 999, 1000, 1001, 2500])
def test_work_orders_are_complete(spark, asked):
    alloc = spark.createDataFrame([("IC+cold_joint", "cold_joint", asked), ("IC+x", "x", 0)],
                                  "defect_type string, label string, asked bigint")
    got = gap.work_orders(alloc, "a {label} fault", seed=5).orderBy("ordinal").collect()
    assert [r["ordinal"] for r in got] == list(range(asked))
    assert got[-1]["seed"] == asked - 1 + 5
    assert got[0]["prompt"] == "a cold joint fault"


def test_hpo_grid(spark):
    df = spark.createDataFrame([("s", 2), ("t", 99), ("u", 0)], "study string, cap int")
    got = gap.hpo_grid(df, {"r": [8, 16, 32], "lr": [1e-4, 2e-4]}, F.col("cap"))
    assert rows(got.where("study = 's'"), "r", "lr") == [(8, 1e-4), (8, 2e-4)]
    assert got.where("study = 't'").select("r", "lr").distinct().count() == 6
    assert got.where("study = 'u'").count() == 0
