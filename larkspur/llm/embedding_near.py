"""Near-duplicate embeddings: iterative quantisation, multi-index Hamming tables, exact cosine.

A rotation is learned on a bounded sample so that the signs of rotated vectors
are balanced codes that keep neighbours together; several starts give as many
bits as are needed. The code is cut into `tables` substrings of `width` bits.
Every vector is entered under its substring and under all substrings one bit
away, so two vectors meet in a table where their substrings differ in two bits at
most. A pair is looked at in one place only: the first such table, there under
one substring that both are entered under. If all of their code bits are near
enough as well, the pair is a candidate, and its original vectors are compared
in double precision.

`width` follows the number of vectors (its logarithm), so that cells stay small;
`tables` follows `recall`, the share of pairs right at the bar that meet; pairs
above the bar meet more often. The tests measure it against brute force.

No pair ever leaves a task. A first pass over codes tells which vectors have a
candidate in a cell; only these get their vectors, are compared, and give back a
count of links and a spanning forest. Equal vectors are one entry with a weight.
A cell of over `cell_rows` entries is split into blocks, and its block pairs are
cells of their own; so a large group of near copies is compared in full, but
spread over tasks.

Defined results: vectors that are null, empty, zero, or hold null or non-finite
components link with nothing, not even their own copies, and are their own
component; vectors of different lengths do not link; rows that share a vec_id are
rows of their own; a null vec_id is reachable but never the smallest, and such a
row is kept in no group; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import attach_weighted, split_for, written
from larkspur.llm.components import components

BAR = 0.9
RECALL = 0.95
#: distinct vectors of a length that the rotation is learned on, those of the smallest hashes
SAMPLE = 4096
CELL_ROWS = 1024
ROWS_A_TASK = 400_000
_CODE_BITS = 128
_ROUNDS = 30


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision; scaled first, so that no square over- or underflows."""
    x = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


class Layout:
    """How many bits a substring has, how many substrings there are, and in how many bits near vectors may differ."""

    def __init__(self, vectors: int, bar: float, recall: float):
        flip = math.acos(bar) / math.pi  # of one sign, for a pair at the bar
        self.width = min(32, max(8, math.ceil(math.log2(max(2, vectors)))))
        meet = sum(math.comb(self.width, k) * flip ** k * (1 - flip) ** (self.width - k) for k in range(3))
        self.tables = max(2, math.ceil(math.log(1 - recall) / math.log(1 - meet)))
        self.bits = max(_CODE_BITS, -(-self.width * self.tables // 64) * 64)
        self.words = self.bits // 64
        self.most = math.ceil(self.bits * flip + 4.5 * math.sqrt(self.bits * flip * (1 - flip)))

    def substring(self, code: np.ndarray, table: np.ndarray) -> np.ndarray:
        """Substring number `table` of each row of words."""
        at = table * self.width
        word, off, rows = at // 64, (at % 64).astype(np.uint64), np.arange(len(code))
        low = code[rows, word] >> off
        rest = np.where(off + np.uint64(self.width) > 64, code[rows, np.minimum(word + 1, self.words - 1)], np.uint64(0))
        high = np.where(off > 0, rest << ((np.uint64(64) - off) % np.uint64(64)), np.uint64(0))
        return (low | high) & np.uint64((1 << self.width) - 1)


def quantiser(sample: np.ndarray, bits: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Mean and projection (dimension x bits): blocks of principal directions, each under a learned rotation."""
    mean = sample.mean(axis=0)
    x = sample - mean
    directions = np.linalg.svd(x.T @ x)[0]
    block = min(64, x.shape[1])
    rng, found, start = np.random.default_rng(seed), [], 0
    while sum(f.shape[1] for f in found) < bits:
        if start + block > x.shape[1]:
            start = 0
        v = x @ directions[:, start:start + block]
        turn = np.linalg.qr(rng.standard_normal((block, block)))[0]
        for _ in range(_ROUNDS):  # signs for this rotation, then the rotation that fits these signs best
            u, _, w = np.linalg.svd(np.where(v @ turn >= 0, 1.0, -1.0).T @ v)
            turn = (u @ w).T
        found.append(directions[:, start:start + block] @ turn)
        start += block
    return mean, np.concatenate(found, axis=1)[:, :bits]


def codes(vectors: np.ndarray, model: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Signs of projected unit vectors, 64 to a word."""
    return np.packbits((vectors - model[0]) @ model[1] >= 0, axis=1, bitorder="little").view(np.uint64)


def usable(v: Column) -> Column:
    """Whether every component is a finite number and not all are zero."""
    x = F.transform(v, lambda c: c.cast("double"))
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.coalesce(fine & F.exists(x, lambda c: c != 0), F.lit(False))


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def learn(classes: DataFrame, layout: Layout, sample: int = SAMPLE) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """A quantiser for each vector length, from `sample` distinct vectors of it at most."""
    models = {}
    for (dim,) in classes.select("dim").distinct().collect():  # one length in any ordinary table
        rows = classes.filter(F.col("dim") == dim).orderBy("h", "node").limit(sample).select("v").toArrow()
        models[dim] = quantiser(unit(_matrix(rows["v"], dim)), layout.bits)
    return models


def _names(layout: Layout) -> list[str]:
    return [f"c{k}" for k in range(layout.words)]


def entries(classes: DataFrame, layout: Layout, models) -> DataFrame:
    """cell, node, code words: a row for every substring that a vector is entered under."""
    names = _names(layout)
    flips = np.append(np.uint64(0), np.uint64(1) << np.arange(layout.width, dtype=np.uint64))
    order = {dim: k for k, dim in enumerate(sorted(models.value))}

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims = b.column(1).to_numpy()
            for dim in np.unique(dims):
                rows = np.flatnonzero(dims == dim)
                for part in np.array_split(rows, -(-len(rows) // 2048)):
                    code = codes(unit(_matrix(b.column(2).take(pa.array(part)), dim)), models.value[dim])
                    node = b.column(0).take(pa.array(part)).to_numpy()
                    cell = np.stack([(layout.substring(code, np.full(len(part), t))[:, None] ^ flips)
                                     + np.uint64((order[dim] * layout.tables + t) << 32)
                                     for t in range(layout.tables)], axis=1).reshape(len(part), -1)
                    each = cell.shape[1]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cell.ravel().view(np.int64)), pa.array(np.repeat(node, each))]
                        + [pa.array(np.repeat(code[:, k].view(np.int64), each)) for k in range(layout.words)],
                        names=["cell", "node", *names])

    return classes.select("node", "dim", "v").mapInArrow(
        enter, "cell bigint, node bigint, " + ", ".join(f"{n} bigint" for n in names))


def _whole_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by their first three columns, in tables that cut no cell."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if b.num_rows == 0:
            continue
        t = pa.Table.from_batches([*held, b])
        key = np.stack([t.column(k).to_numpy() for k in range(3)])
        last = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0))
        whole = int(last[-1]) + 1 if len(last) else 0
        if whole:
            yield t.slice(0, whole)
        held = t.slice(whole).to_batches()
    if held:
        yield pa.Table.from_batches(held)


def _candidates(t: pa.Table, layout: Layout) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers of pairs that are near by their codes and are looked at in this very cell."""
    cell, i_block, j_block, node, side = (t[c].to_numpy() for c in ("cell", "i", "j", "node", "side"))
    code = np.stack([t[n].to_numpy().view(np.uint64) for n in _names(layout)], axis=1)
    new = np.append(True, (cell[1:] != cell[:-1]) | (i_block[1:] != i_block[:-1]) | (j_block[1:] != j_block[:-1]))
    where = np.cumsum(new)
    table = ((cell >> 32) % layout.tables).astype(np.int64)
    key = (cell & 0xFFFFFFFF).astype(np.uint64)
    split = i_block != j_block
    a = np.arange(len(cell))
    for step in range(1, len(cell)):
        a = a[a + step < len(cell)]
        a = a[where[a] == where[a + step]]
        if not len(a):
            return
        x = code[a] ^ code[a + step]
        near = np.bitwise_count(x).sum(axis=1, dtype=np.int64) <= layout.most
        near &= ~split[a] | (side[a] != side[a + step])
        i, x = a[near], x[near]
        if not len(i):
            continue
        here = np.ones(len(i), bool)
        for before in range(layout.tables - 1):  # met in an earlier table
            later = table[i] > before
            here &= ~later | (np.bitwise_count(layout.substring(x, np.full(len(i), before))) > 2)
        d = layout.substring(x, table[i])
        own, other = layout.substring(code[i], table[i]), layout.substring(code[i + step], table[i])
        low = d & (~d + np.uint64(1))
        place = np.where(np.bitwise_count(d) < 2, np.minimum(own, other), np.minimum(own ^ low, other ^ low))
        i = i[here & (place == key[i])]
        yield i, i + step


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """A root for each of n rows, such that linked rows share one."""
    root = np.arange(n)
    while len(a):
        while not np.array_equal(root, up := root[root]):
            root = up
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        open_ = low != high
        a, b, low, high = a[open_], b[open_], low[open_], high[open_]
        np.minimum.at(root, high, low)
    return root


def _placed(rows: DataFrame, cell_rows: int) -> DataFrame:
    """`rows` with the block pair (i, j) and the side of it that they take part in; crowded cells have several."""
    crowded = written(rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > cell_rows)
                      .select("cell", F.ceil(F.col("n") / cell_rows).cast("int").alias("blocks")))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    met = F.when(F.col("blocks").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1))
    return (rows.join(crowded, "cell", "left").withColumn("side", F.coalesce(own, F.lit(0)))
            .withColumn("other", F.explode(met)).drop("blocks")
            .withColumn("i", F.least("side", "other")).withColumn("j", F.greatest("side", "other")).drop("other"))


def links(classes: DataFrame, bar: float = BAR, recall: float = RECALL, cell_rows: int = CELL_ROWS) -> DataFrame:
    """u, v, n: for v null, vector u has n more links; else u and v are linked. `classes`: node, h, dim, v, n, written."""
    spark = classes.sparkSession
    layout = Layout(classes.count(), bar, recall)
    models = spark.sparkContext.broadcast(learn(classes, layout))
    names = _names(layout)
    tasks = split_for(spark, classes.count() * layout.tables * (layout.width + 1), ROWS_A_TASK)
    at = ["cell", "i", "j"]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _whole_cells(batches):
            active = np.zeros(t.num_rows, bool)
            for a, b in _candidates(t, layout):
                active[a] = active[b] = True
            for b in t.filter(pa.array(active)).to_batches():
                yield b

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _whole_cells(batches):
            v, n, node = t["v"].combine_chunks(), t["n"].to_numpy(), t["node"].to_numpy()
            dims, units = t["dim"].to_numpy(), {}
            row_of = np.zeros(t.num_rows, np.int64)
            for dim in np.unique(dims):
                rows = np.flatnonzero(dims == dim)
                row_of[rows] = np.arange(len(rows))
                units[dim] = unit(_matrix(v.take(pa.array(rows)), dim))
            count, left, right = np.zeros(t.num_rows, np.int64), [], []
            for a, b in _candidates(t, layout):
                for dim, u in units.items():
                    of = dims[a] == dim
                    i, j = a[of], b[of]
                    for part in range(0, len(i), 65536):
                        x, y = i[part:part + 65536], j[part:part + 65536]
                        linked = np.einsum("ij,ij->i", u[row_of[x]], u[row_of[y]]) >= bar
                        x, y = x[linked], y[linked]
                        np.add.at(count, x, n[y])
                        np.add.at(count, y, n[x])
                        left.append(x)
                        right.append(y)
            if not left:
                continue
            root = _forest(np.concatenate(left), np.concatenate(right), t.num_rows)
            some, child = np.flatnonzero(count), np.flatnonzero(root != np.arange(t.num_rows))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.append(node[some], node[child])),
                 pa.concat_arrays([pa.nulls(len(some), pa.int64()), pa.array(node[root[child]])]),
                 pa.array(np.append(count[some], np.zeros(len(child), np.int64)))], names=["u", "v", "n"])

    def sorted_cells(df: DataFrame) -> DataFrame:
        return df.repartition(tasks, *at).sortWithinPartitions(*at)

    placed = _placed(entries(classes, layout, models), cell_rows).select(*at, "node", "side", *names)
    active = written(sorted_cells(placed).mapInArrow(
        find, "cell bigint, i int, j int, node bigint, side int, " + ", ".join(f"{n} bigint" for n in names)))
    with_vectors = active.join(classes.select("node", "dim", "v", "n"), "node")
    return sorted_cells(with_vectors.select(*at, "node", "side", *names, "dim", "v", "n")).mapInArrow(
        compare, "u bigint, v bigint, n bigint")


def near_embeddings(vectors: DataFrame, bar: float = BAR, recall: float = RECALL, cell_rows: int = CELL_ROWS) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per vector. `vectors` has vec_id and embedding."""
    given = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").alias("v"))
    fine = given.filter(usable(F.col("v"))).withColumn("h", F.xxhash64("v"))
    classes = written(fine.groupBy("h", "v").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("n"))
                      .withColumn("dim", F.size("v")).withColumn("node", F.monotonically_increasing_id()))
    found = written(links(classes, bar, recall, cell_rows))
    roots = written(components(found.filter("v IS NOT NULL").select("u", "v")))
    counts = found.filter("v IS NULL").groupBy(F.col("u").alias("node")).agg(F.sum("n").alias("more"))
    members = written(classes.join(roots.select(F.col("u").alias("node"), "root"), "node", "left")
                      .join(counts, "node", "left")
                      .select("h", "v", "n", "least", F.coalesce("root", "node").alias("root"),
                              (F.coalesce("more", F.lit(0)) + F.col("n") - 1).alias("n_links")))
    least = written(members.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("m")))
    of_class = written(attach_weighted(members, least, ["root"], "m").select("h", "v", "n", "n_links", "component_id"))
    linked = attach_weighted(fine, of_class, ["h", "v"], "n").select("vec_id", "n_links", "component_id")
    alone = given.filter(~usable(F.col("v"))).select("vec_id", F.lit(0).cast("bigint").alias("n_links"),
                                                     F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
