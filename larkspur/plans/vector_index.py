"""Nearest vectors through coarse cells: every row is indexed, few cells are compared.

Cell centres are learned on a bounded sample by spherical k-means; every row then
goes to the cell of its nearest centre, and a cell keeps the widest angle of a row
to its centre. A search compares a query with the rows of its nearest cells,
exactly. How many cells that are follows from the recall that is asked for, as
measured on the sample. An exact search goes on from there: a cell can be left
out if even its row nearest to the query, by the angles, cannot be among the best.

Cells are put together to columns of a grid, a crowded cell is dealt to several of
them, so a cell may hold any share of all rows. A query goes once to a column, however
many of its cells it visits, with a bit for each of them; so what is shuffled does not
grow with the number of cells, even where the angles rule out none.
The centres are the only large thing that is broadcast, at most CENTRE_BYTES.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larkspur.plans.shared import cut
from larkspur.plans.tiles import BLOCK, cell_kernel, compare_cells, groups_of, side_rows, units

#: rows that centres are learned on and recall is measured on, by the smallest hashes of their ids
SAMPLE = 50_000
#: rows of the sample whose neighbours in the sample are looked up to measure recall
TRIALS = 400
CENTRE_BYTES = 16 << 20
CELL_BLOCKS = 256
DECIMALS = 9
#: numbers of a table of queries by cells
_VISITS = 1 << 20
_ROUNDS = 10
_NOWHERE = -1  # the cell of rows without direction


def learn_centres(units: np.ndarray, cells: int, seed: int = 11) -> np.ndarray:
    """Spherical k-means; a centre that loses all its rows takes a row of the sample that is far from its own centre."""
    rng = np.random.default_rng(seed)
    centres = units[np.sort(rng.choice(len(units), cells, replace=False))]
    for _ in range(_ROUNDS):
        nearest, near = np.empty(len(units), np.int64), np.empty(len(units))
        for part in np.array_split(np.arange(len(units)), -(-len(units) // 4096)):
            s = units[part] @ centres.T
            nearest[part] = s.argmax(axis=1)
            near[part] = s[np.arange(len(part)), nearest[part]]
        total = np.zeros_like(centres)
        np.add.at(total, nearest, units)
        size = np.linalg.norm(total, axis=1)
        lost = np.flatnonzero(size <= 1e-12)
        total[lost] = units[np.argsort(near, kind="stable")[:len(lost)]]
        size[lost] = 1.0
        centres = total / size[:, None]
    return centres


class VectorIndex:
    """Rows by cell, as a table; `build` makes one."""

    def __init__(self, rows: DataFrame, centres: np.ndarray, sample: np.ndarray, uid: str, vector: str, label: str | None):
        self.rows, self.centres, self.uid, self.vector, self.label = rows, centres, uid, vector, label
        self.spark, self._sample = rows.sparkSession, sample
        self.cells = cut(rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("near").alias("near")))

    @classmethod
    def build(cls, rows: DataFrame, uid: str, vector: str, label: str | None = None, cells: int | None = None,
              sample: int = SAMPLE) -> VectorIndex:
        """Index all of `rows`, whose vectors have one length; with a `label`, searches stay within equal labels.

        There are about as many cells as rows in a cell, within CENTRE_BYTES.
        """
        spark = rows.sparkSession
        rows = rows.where(F.col(vector).isNotNull())
        n = rows.count()
        drawn = rows.orderBy(F.xxhash64(uid), uid).limit(sample).select(vector).toArrow()
        known = units(drawn[vector]) if n else np.zeros((0, 1))
        known = known[known.any(axis=1)]
        most = max(1, CENTRE_BYTES // (8 * known.shape[1]))
        wanted = min(cells or math.ceil(math.sqrt(n)), most, max(1, len(known) // 4))
        centres = learn_centres(known, wanted) if len(known) else np.zeros((1, known.shape[1]))
        shared = spark.sparkContext.broadcast(centres)

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if not b.num_rows:
                    continue
                u = units(b.column(1))
                s = u @ shared.value.T
                cell = s.argmax(axis=1)
                near = s[np.arange(len(u)), cell]
                nowhere = ~u.any(axis=1)
                cell[nowhere], near[nowhere] = _NOWHERE, 1.0
                out = [*b.columns, pa.array(cell.astype(np.int32)), pa.array(near)]
                yield pa.RecordBatch.from_arrays(out, names=[*b.schema.names, "cell", "near"])

        chosen = rows.select(uid, vector, *([label] if label else []))
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema)
        return cls(cut(chosen.mapInArrow(place, f"{ddl}, cell int, near double")), centres, known, uid, vector, label)

    def probes(self, recall: float, k: int) -> int:
        """Cells to compare so that this share of the `k` nearest in the sample is among their rows."""
        units = self._sample
        if len(units) <= 1 or recall >= 1:
            return len(self.centres)
        trial = units[:TRIALS]
        s = trial @ units.T
        s[np.arange(len(trial)), np.arange(len(trial))] = -np.inf
        best = np.argsort(-s, axis=1, kind="stable")[:, :min(k, len(units) - 1)]
        cell_of = np.concatenate([(units[p] @ self.centres.T).argmax(axis=1)
                                  for p in np.array_split(np.arange(len(units)), -(-len(units) // 4096))])
        order = np.argsort(np.argsort(-(trial @ self.centres.T), axis=1, kind="stable"), axis=1)
        turn = np.sort(np.take_along_axis(order, cell_of[best], axis=1).ravel())
        return int(turn[min(len(turn) - 1, math.ceil(recall * len(turn)))]) + 1

    # searching
    def _columns(self, side: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[int, int]]]:
        """(first slot and pieces of every cell, column of every slot, first and last cell of every column).

        A slot is a piece of a cell with `side` rows at most, a column so many
        slots in a row as hold about as much. The cell at 0 is the one of rows
        without direction.
        """
        n = np.zeros(len(self.centres) + 1, np.int64)
        for r in self.cells.select("cell", "n").collect():  # at most a row a cell
            n[r["cell"] + 1] = r["n"]
        pieces = np.maximum(1, -(-n // side))
        first, column, ends, held = np.cumsum(pieces) - pieces, [], [], 0
        for cell in range(len(n)):
            share = -(-int(n[cell]) // int(pieces[cell]))
            for _ in range(pieces[cell]):
                if not ends or held + share > side:
                    ends.append((cell, cell))
                    held = 0
                held += share
                ends[-1] = (ends[-1][0], cell)
                column.append(len(ends) - 1)
        return first, pieces, np.array(column), ends

    def _visits(self, queries: DataFrame, probes: int, ends: list[tuple[int, int]], least: str | None = None) -> DataFrame:
        """`queries` once for every column they visit, with the bits of its cells: the nearest `probes`, or, with a column `least`, all others that can reach it."""
        radius = {r["cell"]: (r["n"], r["near"]) for r in self.cells.collect()}  # at most a row a cell
        widest = np.array([math.acos(min(1.0, max(-1.0, radius.get(c, (0, 1.0))[1]))) for c in range(len(self.centres))])
        used = np.array([c in radius for c in range(len(self.centres))])
        facts = self.spark.sparkContext.broadcast((self.centres, widest, used, _NOWHERE in radius))
        columns = queries.columns

        def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            centres, widest, used, nowhere = facts.value
            step = max(1, _VISITS // len(centres))
            for whole in batches:
                if not (used.any() or nowhere):
                    continue
                for b in (whole.slice(i, step) for i in range(0, whole.num_rows, step)):
                    u = units(b.column(at))
                    s = u @ centres.T
                    order = np.argsort(np.argsort(-np.where(used, s, -np.inf), axis=1, kind="stable"), axis=1)
                    first = (order < probes) & used
                    if least is None:
                        goes, rest = first, np.zeros(len(u), bool)
                    else:
                        bound = np.cos(np.maximum(0.0, np.arccos(np.clip(s, -1, 1)) - widest))
                        need = b.column(columns.index(least)).to_numpy(zero_copy_only=False)[:, None]
                        # scores are compared after rounding, and ties count
                        goes = ~first & used & (np.where(u.any(axis=1)[:, None], bound, 0.0) + 10.0 ** -DECIMALS >= need)
                        rest = nowhere & (need[:, 0] <= 10.0 ** -DECIMALS)
                    goes = np.hstack([rest[:, None], goes])
                    for column, (start, end) in enumerate(ends):
                        bits = goes[:, start:end + 1]
                        row = np.flatnonzero(bits.any(axis=1))
                        if len(row):
                            r = pa.array(row)
                            yield pa.RecordBatch.from_arrays(
                                [*(c.take(r) for c in b.columns), pa.array(np.full(len(row), column, np.int32)),
                                 pa.array([x.tobytes() for x in np.packbits(bits[row], axis=1)], pa.binary())],
                                names=[*columns, "_col", "_cells"])

        at = columns.index(self.vector)
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in queries.schema)
        return queries.mapInArrow(visit, f"{ddl}, _col int, _cells binary")

    def _compared(self, queries: DataFrame, probes: int, k: int, skip_self: bool, least: str | None = None) -> DataFrame:
        """(left_id, right_id, score): best rows of the cells visited, up to k of each task that had a share of them."""
        asked, width = queries.agg(F.count(F.lit(1)), F.max(F.size(self.vector))).collect()[0]
        side = side_rows(max(asked, self.cells.agg(F.sum("n")).collect()[0][0] or 0), width or 1, CELL_BLOCKS)
        first, pieces, column, ends = self._columns(side)
        rows = max(1, -(-asked // side))
        starts = [start for start, _ in ends]

        def named(df: DataFrame, *more: str) -> DataFrame:
            if self.label:
                df = df.where(F.col(self.label).isNotNull())
            return df.select(F.col(self.uid).alias("uid"), F.col(self.vector).alias("vec"),
                             *([F.col(self.label).alias("label")] if self.label else []), *more)

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                cell = b["cell"].to_numpy(zero_copy_only=False).astype(np.int64) + 1
                slot = first[cell] + b["_hash"].to_numpy(zero_copy_only=False) % pieces[cell]
                kept = [c for c in b.schema.names if c != "_hash"]
                yield pa.RecordBatch.from_arrays([*(b[c] for c in kept), pa.array(column[slot].astype(np.int32))],
                                                 names=[*kept, "_col"])

        def meets(left: pa.Table, right: pa.Table, mine: np.ndarray, theirs: np.ndarray):
            start = starts[left["_col"][0].as_py()]
            bits = np.frombuffer(b"".join(left["_cells"].take(pa.array(mine)).to_pylist()), np.uint8).reshape(len(mine), -1)
            for cell, places in groups_of(right["cell"].to_numpy()[theirs].astype(np.int64) + 1 - start).items():
                asks = bits[:, cell >> 3] >> (7 - (cell & 7)) & 1
                yield mine[asks == 1], theirs[places]

        left = named(self._visits(queries, probes, ends, least), "_col", "_cells").withColumn(
            "_row", F.pmod(F.xxhash64("uid", "vec"), F.lit(rows)).cast("int"))
        right = named(self.rows, "cell").withColumn("_hash", F.xxhash64("uid", "vec"))
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in right.schema if f.name != "_hash")
        right = right.mapInArrow(place, f"{ddl}, _col int").withColumn("_row", F.explode(F.sequence(F.lit(0), F.lit(rows - 1))))
        return compare_cells(left, right, rows * len(ends), ["_row", "_col"], cell_kernel(k, DECIMALS, skip_self, meets))

    def nearest(self, queries: DataFrame, k: int = 5, recall: float = 0.95, exact: bool = False,
                skip_self: bool = True) -> DataFrame:
        """(query_id, rank, match_id, score): the k most similar rows of each query.

        queries: the index's id, vector and label columns. Without `exact`, those
        among the rows of the cells that the measured recall asks for.
        """
        queries = cut(queries.where(F.col(self.vector).isNotNull()).select(self.uid, self.vector, *([self.label] if self.label else [])))
        probes = self.probes(recall, k)
        found = cut(self._compared(queries, probes, k, skip_self))
        if exact:
            w = Window.partitionBy("left_id").orderBy(F.desc("score"), "right_id")
            kth = found.withColumn("_n", F.row_number().over(w)).where(F.col("_n") == k).select(
                F.col("left_id").alias(self.uid), F.col("score").alias("_least"))
            asking = cut(queries.join(kth, self.uid, "left").withColumn("_least", F.coalesce("_least", F.lit(float("-inf")))))
            found = found.unionByName(self._compared(asking, probes, k, skip_self, "_least"))
        w = Window.partitionBy("left_id").orderBy(F.desc("score"), "right_id")
        return (found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
                .select(F.col("left_id").alias("query_id"), "rank", F.col("right_id").alias("match_id"), "score"))


def recall_of(found: DataFrame, exact: DataFrame) -> DataFrame:
    """(queries, links, found, recall): how many of the exact (query_id, match_id) were found."""
    hit = found.select("query_id", "match_id", F.lit(1).alias("_hit"))
    return exact.join(hit, ["query_id", "match_id"], "left").agg(
        F.count_distinct("query_id").alias("queries"), F.count(F.lit(1)).alias("links"),
        F.count("_hit").alias("found"), (F.count("_hit") / F.count(F.lit(1))).alias("recall"))


assert BLOCK * CELL_BLOCKS <= 1 << 16  # rows of a side that one task compares
