"""Embedding near-dedup against comparing every pair."""

import numpy as np
import pytest

from larkspur.llm.catalog import QUERIES
from larkspur.llm.embedding_near import Layout, near_embeddings, unit

SCHEMA = "vec_id bigint, embedding array<float>, label int, h string, v int, node string"


def brute(rows, bar=0.9):
    """(vec_id, n_links, component_id, kept) of every row, sorted, and the linked pairs."""
    ids = [r[0] for r in rows]
    good = [k for k, (_, v) in enumerate(rows) if v and None not in v and np.isfinite(v).all() and any(v)]
    parent = list(range(len(rows)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    pairs = []
    for dim in {len(rows[k][1]) for k in good}:
        own = np.array([k for k in good if len(rows[k][1]) == dim])
        u = unit(np.array([rows[k][1] for k in own], np.float32).astype(np.float64))
        for a in range(len(own)):
            for b in np.flatnonzero(u[a + 1:] @ u[a] >= bar) + a + 1:
                pairs.append((own[a], own[b]))
    count = [0] * len(rows)
    for a, b in pairs:
        count[a] += 1
        count[b] += 1
        parent[find(a)] = find(b)
    least = {}
    for k, i in enumerate(ids):
        r = find(k)
        if i is not None and (r not in least or i < least[r]):
            least[r] = i
    out = [(i, count[k], least.get(find(k)), i is not None and i == least.get(find(k))) for k, i in enumerate(ids)]
    return sorted(out, key=repr), pairs


def got(df):
    return sorted(map(tuple, df.select("vec_id", "n_links", "component_id", "kept").collect()), key=repr)


def planted(rng, n, groups, low, high=1.0, dim=64):
    """Random vectors, of which `groups` have a partner with a cosine from `low` to `high`."""
    base = unit(rng.standard_normal((n, dim)))
    aside = rng.standard_normal((groups, dim))
    aside = unit(aside - np.einsum("ij,ij->i", aside, base[:groups])[:, None] * base[:groups])
    c = rng.uniform(low, high, groups)[:, None]
    return np.concatenate([base, c * base[:groups] + np.sqrt(1 - c * c) * aside])


def frame(spark, rows, parts=5):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, "h", 2, "n")
                                  for i, v in rows], SCHEMA).repartition(parts)


def test_query(spark, tables):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{tables}/embeddings.parquet").collect()]
    assert got(QUERIES["op12_embedding_near"](spark, tables)) == brute(rows)[0]


@pytest.mark.parametrize("cell_rows", [16, 1024])
def test_groups_copies_and_crowded_cells(spark, cell_rows):
    rng = np.random.default_rng(1)
    centre = unit(rng.standard_normal((6, 64)))
    near = np.concatenate([c + 0.01 * rng.standard_normal((s, 64)) for c, s in zip(centre, (2, 3, 5, 20, 60, 200))])
    rows = list(enumerate(np.concatenate([near, np.repeat(near[:2], 40, axis=0), planted(rng, 300, 0, 1)]).tolist()))
    rng.shuffle(rows)
    assert got(near_embeddings(frame(spark, rows), cell_rows=cell_rows)) == brute(rows)[0]


@pytest.mark.parametrize("high", [0.905, 1.0])
def test_recall_down_to_the_bar(spark, high):
    """Links found are links, and nine in ten of all links, and of those just above the bar, are found."""
    rows = list(enumerate(planted(np.random.default_rng(2), 3000, 1000, 0.9, high).tolist()))
    want, pairs = brute(rows)
    links = dict((r[0], r[1]) for r in want)
    found = got(near_embeddings(frame(spark, rows)))
    assert len(pairs) >= 990 and sum(r[1] for r in found) / 2 >= 0.9 * len(pairs)
    assert all(r[1] <= links[r[0]] for r in found)


def test_odd_vectors(spark):
    one, tiny = [1.0] * 8, [1e-30] * 8
    rows = [(1, one), (1, one), (2, [2.0] * 8), (3, None), (4, []), (5, [0.0] * 8), (6, [float("nan")] + one[1:]),
            (7, [float("inf")] + one[1:]), (8, [None] + one[1:]), (9, tiny), (None, one), (None, [-1.0] * 8), (10, one[:7]),
            (11, [3.0] * 7), (12, [1.0] + [0.0] * 7), (None, None), (5, [0.0] * 8)]
    assert got(near_embeddings(frame(spark, rows, 3))) == brute(rows)[0]


def test_empty(spark):
    assert near_embeddings(frame(spark, [], 1)).count() == 0


def test_layout_grows_slowly():
    small, large = Layout(10_000, 0.9, 0.95), Layout(10_000_000, 0.9, 0.95)
    assert large.width > small.width and large.tables * (large.width + 1) < 6 * small.tables * (small.width + 1)
