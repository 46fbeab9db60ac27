import os

import pytest

from comparing import rows
from larkspur.plans import shared


def test_the_session_names_the_shared_folder(spark):
    found = shared.shared_dir(spark)
    df = spark.createDataFrame([(1, "a"), (2, None)], "i int, c string")
    back = shared.cut(df)
    assert rows(back) == rows(df) and back.schema == df.schema
    assert back.inputFiles()[0].removeprefix("file://").startswith(found.removeprefix("file://"))


def test_a_cluster_has_to_name_its_folder():
    from larkspur import session

    class Elsewhere:
        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(ValueError, match="every executor"):
        session.own_shared_folder(Elsewhere)


def test_nothing_is_left_of_a_scope(spark):
    from larkspur.plans.order_stats import take_top
    df = spark.range(200).selectExpr("id % 3 AS g", "CAST(id AS STRING) AS uid", "CAST(id % 50 AS DOUBLE) AS v")
    quotas = spark.createDataFrame([(0, 5), (1, 7)], "g bigint, quota int")
    place = shared.shared_dir(spark).removeprefix("file://")
    before = set(os.listdir(place)) if os.path.isdir(place) else set()
    with shared.scratch_scope(spark):
        assert take_top(df, ["g"], quotas, "quota", "v", "uid").count() == 12
        assert set(os.listdir(place)) > before
    assert set(os.listdir(place)) == before


def test_facts_are_joined_on_null_safe_keys(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("c", 3)], "k string, v int")
    facts = spark.createDataFrame([("a", 10), (None, 20)], "k string, f int")
    assert rows(shared.attach(df, facts, ["k"], "left")) == sorted(
        [("a", 1, 10), (None, 2, 20), ("c", 3, None)], key=repr)
    one = spark.createDataFrame([(7,)], "f int")
    plan = shared.attach(df, one, [])
    assert rows(plan, "v", "f") == [(1, 7), (2, 7), (3, 7)]
    assert "Cartesian" not in plan._jdf.queryExecution().executedPlan().toString()
