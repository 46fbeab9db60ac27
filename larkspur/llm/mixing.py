"""Mixing sources to target weights with the cube method.

A source's rate is target / size. Its whole part is taken of every document;
the fraction becomes every document's inclusion probability. The flight phase
moves these probabilities, three documents at a time, through the null space of
two balancing equations (number of documents, number of words) until each is 0
or 1, so both totals stay as they were. It runs in blocks of one source's
documents, so a hot source is spread; each block leaves at most two documents
undecided, which meet in new, fewer blocks, round after round. When a source is
down to one block, its last one or two documents are landed on the choice that
comes nearest to the target in words; if that is not near, as with few documents,
documents of this block are exchanged.

Defined results: a null or empty text has size 0 (and may be taken or not); a
null source is a source of its own, last in order; a source without words has
target 0 and is not taken; repeated rows are separate documents; an empty table
gives no rows; other columns are ignored. The draw depends on the rows only.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.llm.common import WORD, attach_weighted, written

WEIGHTS = (5, 2, 1)
CAP = 3
ROWS_A_BLOCK = 4_000
#: an entry of over this share of a block's expected words is decided first
OUTSIZE = 0.005
#: a last block that is this near to its expected words, as a share of them, is left alone
NEAR = 0.002
_EPS = 1e-9


def source_targets(sized: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """s, s_null, n, source_size, target: one row per source.

    The excess of capped sources is reshared by weight until no source is above
    its cap, which is water filling: with sources in order of cap / weight, those
    before the first one that its share fits into are capped. The windows run
    over one row per source.
    """
    facts = sized.groupBy("s", "s_null").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.partitionBy().orderBy("s_null", "s")) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), F.pmod(rank, F.lit(len(weights))) + 1).cast("bigint")
    facts = facts.withColumn("w", weight).withColumn("most", F.col("source_size") * cap)
    order = Window.partitionBy().orderBy(F.col("most") / F.col("w"), "s_null", "s")
    up_to = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    level = ((F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(up_to), F.lit(0)))
             / (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(up_to), F.lit(0))))
    fits = F.when(F.col("level") * F.col("w") <= F.col("most"), F.col("turn"))
    facts = facts.withColumn("level", level).withColumn("turn", F.row_number().over(order))
    facts = facts.withColumn("level", F.min_by("level", fits).over(everything))
    target = F.least(F.col("most").cast("double"), F.coalesce(F.col("level") * F.col("w"), F.col("most").cast("double")))
    return facts.select("s", "s_null", "n", "source_size", target.alias("target"))


def settle_largest(pi: np.ndarray, size: np.ndarray, draw) -> np.ndarray:
    """Decides the outsize entries first, against all others at once.

    A triple moves an entry the less the more its size stands out, so an outsize
    one would wait until the landing. Its unit vector projected onto the null
    space moves it, and spreads what it weighs over everything undecided.
    """
    pi = pi.copy()
    outsize = np.flatnonzero(size > (pi * size).sum() * OUTSIZE)
    for k in outsize[np.argsort(-size[outsize], kind="stable")]:
        while _EPS < pi[k] < 1 - _EPS:
            u = np.flatnonzero((pi > _EPS) & (pi < 1 - _EPS))
            if len(u) < 4:
                return pi
            a = np.stack([np.ones(len(u)), size[u] / size[k]])
            unit = (u == k).astype(float)
            move = unit - a.T @ (np.linalg.pinv(a @ a.T) @ (a @ unit))
            move[np.abs(move) < 1e-12] = 0
            if not move.any():
                return pi
            with np.errstate(divide="ignore", invalid="ignore"):
                up = np.where(move > 0, (1 - pi[u]) / move, np.where(move < 0, pi[u] / -move, np.inf)).min()
                down = np.where(move > 0, pi[u] / move, np.where(move < 0, (1 - pi[u]) / -move, np.inf)).min()
            pi[u] += move * (up if next(draw) * (up + down) < down else -down)
            pi = np.where(pi < _EPS, 0.0, np.where(pi > 1 - _EPS, 1.0, pi))
    return pi


def flight(pi: np.ndarray, size: np.ndarray, seed: int) -> np.ndarray:
    """Moves `pi` until at most two entries are strictly between 0 and 1; sum(pi) and sum(pi * size) stay."""
    draw = iter(np.random.default_rng(seed).random(4 * len(pi) + 8).tolist())
    pi = settle_largest(pi.astype(float), size.astype(float), draw).tolist()
    size = size.astype(float).tolist()
    active: list[int] = []
    waiting = iter(range(len(pi)))

    def settle():
        for k in active:
            if pi[k] < _EPS or pi[k] > 1 - _EPS:
                pi[k] = float(round(pi[k]))
        active[:] = [k for k in active if 0.0 < pi[k] < 1.0]

    while True:
        for k in waiting:
            if _EPS < pi[k] < 1 - _EPS:
                active.append(k)
                if len(active) == 3:
                    break
            else:
                pi[k] = float(round(pi[k]))
        if len(active) < 3:
            if len(active) < 2 or size[active[0]] != size[active[1]]:
                return np.array(pi)
            move = (1.0, -1.0)  # two of one size can still be moved
        else:
            a, b, c = (size[k] for k in active)
            move = (b - c, c - a, a - b)
            if not any(move):
                move = (1.0, -1.0, 0.0)
        up = min((1 - pi[k]) / u if u > 0 else pi[k] / -u for k, u in zip(active, move) if u)
        down = min(pi[k] / u if u > 0 else (1 - pi[k]) / -u for k, u in zip(active, move) if u)
        step = up if next(draw) * (up + down) < down else -down
        for k, u in zip(active, move):
            pi[k] += step * u
        settle()


def land(pi: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Decides the few entries that are left: nearest to the expected words, then to the expected number."""
    left = np.flatnonzero((pi > 0) & (pi < 1))
    words, number = (pi * size)[left].sum(), pi[left].sum()
    best = min(itertools.product((1.0, 0.0), repeat=len(left)),
               key=lambda c: (abs((np.array(c) * size[left]).sum() - words), abs(sum(c) - number)))
    pi = pi.copy()
    pi[left] = best
    return pi


def exchange(taken: np.ndarray, size: np.ndarray, expected: float) -> np.ndarray:
    """Nearer to the expected words, by putting in, taking out or swapping documents while that helps.

    A source of a few documents cannot be landed well on its last two alone.
    """
    taken, size = taken.copy(), size.astype(float)
    while True:
        over = (taken * size).sum() - expected
        best, change = abs(over), ()
        one = np.abs(over + size * (1 - 2 * taken))
        if len(one) and one.min() < best * 0.99:
            best, change = one.min(), (one.argmin(),)
        inside, outside = np.flatnonzero(taken == 1), np.flatnonzero(taken == 0)
        if len(inside) and len(outside):
            outside = outside[np.argsort(size[outside], kind="stable")]
            at = np.searchsorted(size[outside], size[inside] - over)  # a partner as large as what would remain
            for k in (np.maximum(at - 1, 0), np.minimum(at, len(outside) - 1)):
                left = np.abs(over - size[inside] + size[outside[k]])
                if left.min() < best * 0.99:
                    best, change = left.min(), (inside[left.argmin()], outside[k[left.argmin()]])
        if not change or abs(over) <= expected * NEAR:
            return taken
        taken[list(change)] = 1 - taken[list(change)]


_ROWS = "doc_id {id}, h bigint, size bigint, s string, s_null boolean, source_size bigint, target double, " \
        "whole bigint, pi double, blocks bigint, block bigint"


def _fly(g: pd.DataFrame) -> pd.DataFrame:
    g = g.sort_values(["h", "doc_id", "size"], kind="stable", ignore_index=True)
    # the draw follows from the block's own rows, whatever the type of their ids
    seed = int(np.bitwise_xor.reduce(g["h"].to_numpy(np.int64)) & 0x7FFFFFFFFFFFFFFF)
    pi = flight(g["pi"].to_numpy(), g["size"].to_numpy(), seed)
    if g["blocks"].iloc[0] == 1:
        size, drawn = g["size"].to_numpy(float), g["pi"].to_numpy()
        pi = exchange(land(pi, size), size, (drawn * size).sum())
    return g.assign(pi=pi)


def row_hash(seed: int = 0) -> Column:
    return F.xxhash64("doc_id", "text", "source", F.lit(seed))


def mix_sources(docs: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP, rows_a_block: int = ROWS_A_BLOCK,
                seed: int = 0) -> DataFrame:
    """doc_id, s, s_null (the source), size, source_size, target, taken_times, taken: one row per document."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint")
    sized = written(docs.select(
        "doc_id", row_hash(seed).alias("h"), size.alias("size"),
        F.coalesce("source", F.lit("")).alias("s"), F.col("source").isNull().alias("s_null")))
    facts = written(source_targets(sized, weights, cap))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rows = (attach_weighted(sized, facts, ["s", "s_null"], "n")
            .withColumn("whole", F.floor(rate).cast("bigint")).withColumn("pi", rate - F.floor(rate))
            .withColumn("blocks", F.ceil(F.col("n") / rows_a_block).cast("bigint")).drop("n"))
    parts = [written(rows.withColumn("block", F.pmod("h", "blocks")))]
    columns = [c.split()[0] for c in _ROWS.split(", ")]
    schema = _ROWS.format(id=docs.schema["doc_id"].dataType.simpleString())
    undecided = (F.col("pi") > 0) & (F.col("pi") < 1)
    while not parts[-1].filter(undecided).isEmpty():
        # blocks leave at most two documents each, so the rounds are logarithmic
        parts.append(written(parts[-1].filter(undecided).select(columns).groupBy("s", "s_null", "block")
                             .applyInPandas(_fly, schema)
                             .withColumn("blocks", F.ceil(F.col("blocks") * 2 / rows_a_block).cast("bigint"))
                             .withColumn("block", F.pmod("h", "blocks"))))
    times = F.col("whole") + F.col("pi").cast("bigint")
    decided = [p.filter(~undecided).select(columns) for p in parts]
    everything = decided[0]
    for d in decided[1:]:
        everything = everything.unionByName(d)
    return everything.select("doc_id", "h", "s", "s_null", "size", "source_size", "target",
                             times.alias("taken_times"), (F.col("size") * times).alias("taken"))


def repeat_rows(docs: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP, seed: int = 0) -> DataFrame:
    """The mix as rows of `docs`, each as often as it is taken. Equal rows share what they are given together."""
    times = mix_sources(docs, weights, cap, seed=seed)
    by_row = written(times.groupBy("h").agg(F.sum("taken_times").alias("_times"), F.count(F.lit(1)).alias("_rows")))
    rows = docs.select(F.struct(*docs.columns).alias("row"), row_hash(seed).alias("h"))
    joined = rows.join(by_row.filter("_times > 0"), "h")
    turn = F.row_number().over(Window.partitionBy("h").orderBy("h"))
    several = joined.filter("_rows > 1").withColumn("_turn", turn).withColumn(
        "_times", F.expr("_times div _rows + CASE WHEN _turn <= _times % _rows THEN 1 ELSE 0 END")).filter("_times > 0")
    taken = joined.filter("_rows = 1").unionByName(several.drop("_turn"))
    return taken.select("row", F.explode(F.sequence(F.lit(1).cast("bigint"), "_times"))).select("row.*")
