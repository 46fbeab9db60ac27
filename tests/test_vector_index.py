"""The vector index against comparing all rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from comparing import rows
from larkspur.operators.similarity import mine_similar, mine_similar_indexed, nn_score, nn_score_indexed
from larkspur.plans.vector_index import VectorIndex, recall_of


def table(spark, m, labels=None):
    data = [(i, [float(x) for x in v], labels[i] if labels else "a") for i, v in enumerate(m)]
    return spark.createDataFrame(data, "id bigint, v array<double>, label string").repartition(4)


def clusters(seed, n=3000, dim=16, groups=40):
    rng = np.random.default_rng(seed)
    centre = rng.standard_normal((groups, dim))
    pick = rng.integers(0, groups, n) * (rng.random(n) > 0.3)  # a third of all rows in one group
    return centre[pick] + 0.3 * rng.standard_normal((n, dim))


def test_recall_without_the_exact_end(spark):
    df = table(spark, clusters(1))
    asking = df.where("id % 50 = 0")
    index = VectorIndex.build(df, "id", "v")
    assert index.rows.count() == 3000  # every row is in a cell
    assert index.probes(0.95, 5) < len(index.centres) / 2
    got = recall_of(mine_similar_indexed(asking, index), mine_similar(asking, df, "id", "v", 5)).collect()[0]
    assert got["queries"] == 60 and got["links"] == 300 and got["recall"] >= 0.9


@pytest.mark.parametrize("seed", [2, 3])
def test_the_exact_end_finds_all(spark, seed):
    m = clusters(seed, 800, 8, 10)
    m[5] = m[6] = 0
    m[7] = m[8] = m[9]
    df = table(spark, m)
    index = VectorIndex.build(df, "id", "v", cells=30)
    got = rows(mine_similar_indexed(df, index, 4, recall=0.3, exact=True), "query_id", "rank", "match_id")
    assert got == rows(mine_similar(df, df, "id", "v", 4), "query_id", "rank", "match_id")


def test_classes_do_not_meet(spark):
    labels = [["a", "b", "c"][i % 3] if i % 7 else None for i in range(400)]
    df = table(spark, clusters(5, 400, 8, 6), labels)
    made, real = df.where("id % 2 = 0"), df.where("id % 2 = 1 AND coalesce(label, '') <> 'c'")
    index = VectorIndex.build(real, "id", "v", "label", cells=12)
    got = rows(nn_score_indexed(made, index, recall=0.2, exact=True), "id", "label", "nn_score", "nearest")
    assert got == rows(nn_score(made, real, "label", "id", "v"), "id", "label", "nn_score", "nearest")


def test_crowded_cells_are_dealt_out(spark, monkeypatch):
    import larkspur.plans.vector_index as vi
    monkeypatch.setattr(vi, "CELL_BLOCKS", 1)
    df = table(spark, clusters(6, 1500, 8, 3))
    index = VectorIndex.build(df, "id", "v", cells=2)
    asking = df.where("id % 50 = 0")
    got = rows(mine_similar_indexed(asking, index, 3, exact=True), "query_id", "rank", "match_id")
    assert got == rows(mine_similar(asking, df, "id", "v", 3), "query_id", "rank", "match_id")


def test_nothing_to_find(spark):
    df = table(spark, clusters(7, 50, 4, 2))
    empty = VectorIndex.build(df.where("false"), "id", "v")
    assert mine_similar_indexed(df, empty).count() == 0
    index = VectorIndex.build(df, "id", "v")
    assert mine_similar_indexed(df.where("false"), index).count() == 0
    one = VectorIndex.build(df.where("id = 3"), "id", "v")
    assert mine_similar_indexed(df.where("id = 4"), one, exact=True).select(F.max("match_id")).collect()[0][0] == 3
