"""All pairs in a grid of cells: exact, and no more shuffled than rows and the best of a cell."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from comparing import rows
from larkspur.operators.similarity import mine_similar, nn_score, nn_score_indexed
from larkspur.plans import tiles
from larkspur.plans.vector_index import VectorIndex


def table(spark, n, seed, dim=6, labels=("a", "b", None)):
    rng = np.random.default_rng(seed)
    m = rng.integers(-2, 3, (n, dim)).astype(float)  # many ties and equal rows
    data = [(i, labels[i % len(labels)], [float(x) for x in v]) for i, v in enumerate(m)]
    return spark.createDataFrame(data, "id bigint, label string, v array<double>").repartition(3), m


def top(m, asking, pool, k):
    size = np.linalg.norm(m, axis=1, keepdims=True)
    u = np.divide(m, size, out=np.zeros_like(m), where=size > 0)
    return [(q, r + 1, p) for q in asking
            for r, (_, p) in enumerate(sorted((-round(float(u[q] @ u[p]), 9), p) for p in pool if p != q)[:k])]


@pytest.fixture()
def small_cells(monkeypatch):
    monkeypatch.setattr(tiles, "BLOCK", 8)
    monkeypatch.setattr(tiles, "_TILE", (7, 5))


@pytest.mark.parametrize("k", [1, 3, 20])
def test_best_of_all_pairs_with_ties(spark, small_cells, k):
    df, m = table(spark, 150, 1)
    got = rows(mine_similar(df.where("id % 3 = 0"), df, "id", "v", k), "query_id", "rank", "match_id")
    assert got == sorted(top(m, range(0, 150, 3), range(150), k), key=repr)


def test_a_pair_of_blocks_is_never_a_row(spark, small_cells, monkeypatch):
    """What is dealt to the cells are rows, copied as often as the grid is wide; a block pair held both blocks."""
    df, _ = table(spark, 200, 2)
    seen = []

    def watched(left, right, cells, keys, kernel, real=tiles.compare_cells):
        seen.append((left.count(), right.count(), cells))
        return real(left, right, cells, keys, kernel)

    monkeypatch.setattr(tiles, "compare_cells", watched)
    found = mine_similar(df, df, "id", "v", 2)
    assert seen == [(1600, 1600, 64)]
    assert "FlatMapCoGroupsInArrow" in found._jdf.queryExecution().toString()
    assert "_matrix" not in found._jdf.queryExecution().toString()


def test_a_side_of_a_cell_is_bounded():
    assert tiles.side_rows(80_000, 64) == 10_000
    assert tiles.side_rows(10 ** 9, 64) == 65_536
    assert tiles.side_rows(10 ** 9, 4096) * 4096 * 8 <= tiles.SIDE_BYTES


def test_rows_without_vector_or_label_meet_nothing(spark):
    df = spark.createDataFrame([(1, "a", [1.0, 0.0]), (2, "a", None), (3, None, [1.0, 0.0]), (4, "a", [1.0, 1.0])],
                               "id bigint, label string, v array<float>")
    got = rows(nn_score(df, df.where("id <> 1"), "label", "id", "v"), "id", "nn_score", "nearest")
    assert got == [(1, pytest.approx(0.5 ** 0.5), 4), (2, None, None), (3, None, None), (4, 1.0, 4)]
    assert rows(mine_similar(df, df, "id", "v", 1), "query_id", "match_id") == [(1, 3), (3, 1), (4, 1)]


def test_a_query_goes_to_a_column_once(spark):
    """Not once to every cell: vectors without clusters visit nearly all of them."""
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(i, "a", [float(x) for x in rng.standard_normal(32)]) for i in range(1200)],
                               "id bigint, label string, v array<double>")
    index = VectorIndex.build(df, "id", "v", "label")
    assert len(index.centres) > 30
    side = tiles.side_rows(1200, 32)
    ends = index._columns(side)[-1]
    asking = df.withColumn("_least", F.lit(0.99))
    visits = index._visits(asking, 20, ends)
    assert len(ends) <= 2 * tiles.PIECES and visits.count() <= 1200 * len(ends)
    assert visits.select(F.sum(F.bit_count(F.conv(F.hex("_cells"), 16, 10).cast("bigint")))).collect()[0][0] == 1200 * 20
    got = rows(nn_score_indexed(df, index, exact=True), "id", "nn_score", "nearest")
    assert got == rows(nn_score(df, df, "label", "id", "v"), "id", "nn_score", "nearest")
