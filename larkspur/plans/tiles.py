"""All-against-all comparison as a grid of cells.

Left rows get one of `rows` row numbers and are copied to all `cols` columns,
right rows the other way round, so that every pair meets in exactly one cell. A
cell is an ordinary grouping key: the work of one hot class is spread over
rows x cols tasks. Both sides of a cell are in memory, a side being SIDE_BYTES
of doubles at most, and pairs exist only as tiles of scores inside a kernel that
keeps the best k of a left row: what is shuffled are single rows, copied as often
as the grid is wide, and the best of each cell.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BLOCK = 256
CELL_BLOCKS = 256
#: a side of a cell as doubles
SIDE_BYTES = 32 << 20
#: a side is cut into so many pieces, up to a piece of the largest size
PIECES = 8
#: classes are dealt to so many parts, each with a grid after its own size
PARTS = 64
_TILE = (1024, 2048)


def units(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of length one; rows of zeros stay zero."""
    rows = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    m = np.asarray(rows.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(rows), -1)
    size = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, size, out=np.zeros_like(m), where=size > 0)


def side_rows(rows: int, width: int, cell_blocks: int = CELL_BLOCKS) -> int:
    """Rows of a side of a cell, where the larger table has `rows` of them with `width` numbers each."""
    most = min(BLOCK * cell_blocks, max(BLOCK, SIDE_BYTES // (8 * max(1, width))))
    return max(BLOCK, min(most, -(-rows // PIECES)))


class Nearest:
    """The best `k` places and scores of every left row, over the right rows that were offered so far.

    Scores are rounded before they are compared, so that the shape of a tile
    cannot decide a tie; ties go to the smaller place.
    """

    def __init__(self, left: np.ndarray, right: np.ndarray, k: int, decimals: int):
        self.left, self.right, self.k, self.decimals = left, right, k, decimals
        self.score = np.full((len(left), k), -np.inf)
        self.place = np.full((len(left), k), len(right), np.int64)
        self._odd = not (np.isfinite(left).all() and np.isfinite(right).all())

    def offer(self, rows: np.ndarray, places: np.ndarray, left_codes: np.ndarray | None = None,
              right_codes: np.ndarray | None = None) -> None:
        """Compare left `rows` with the right rows at `places`, in ascending order; equal codes do not count.

        Codes of right rows ascend with their places.
        """
        for i in range(0, len(rows), _TILE[0]):
            at = rows[i:i + _TILE[0]]
            x = self.left[at]
            for j in range(0, len(places), _TILE[1]):
                p = places[j:j + _TILE[1]]
                s = x @ self.right[p].T
                if self._odd:
                    s[np.isnan(s)] = -np.inf
                if left_codes is not None:
                    first, last = (np.searchsorted(right_codes[p], left_codes[at], side) for side in ("left", "right"))
                    for r in np.flatnonzero(first < last):
                        s[r, first[r]:last[r]] = -np.inf
                # a score can round up to the last of the best, and then its place decides
                near = np.flatnonzero(s.max(axis=1) > self.score[at, -1] - 10.0 ** -self.decimals)
                if len(near):
                    self._merge(at[near], p, np.round(s[near], self.decimals))

    def _merge(self, at: np.ndarray, p: np.ndarray, s: np.ndarray) -> None:
        n, own = min(self.k, len(p)), np.arange(len(at))[:, None]
        if n > 16:
            top = np.argsort(-s, axis=1, kind="stable")[:, :n]
            new = s[own, top]
        else:
            top, new = np.empty((len(at), n), np.int64), np.empty((len(at), n))
            for c in range(n):
                top[:, c] = s.argmax(axis=1)
                new[:, c] = s[own[:, 0], top[:, c]]
                s[own[:, 0], top[:, c]] = -np.inf
        s, p = np.hstack([self.score[at], new]), np.hstack([self.place[at], p[top]])
        best = np.lexsort((p, -s), axis=1)[:, :self.k]
        self.score[at], self.place[at] = s[own, best], p[own, best]

    def told(self, left_ids: pa.ChunkedArray, right_ids: pa.ChunkedArray) -> pa.Table:
        row, k = np.nonzero(np.isfinite(self.score))
        return pa.table({"left_id": left_ids.take(pa.array(row)), "right_id": right_ids.take(pa.array(self.place[row, k])),
                         "score": pa.array(self.score[row, k])})


def groups_of(codes: np.ndarray) -> dict[int, np.ndarray]:
    """The positions of every code, ascending."""
    order = np.argsort(codes, kind="stable")
    ends = np.flatnonzero(np.diff(codes[order])) + 1
    return {int(codes[g[0]]): g for g in np.split(order, ends) if len(g)}


def id_codes(left: pa.ChunkedArray, right: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers by which equal ids are known, for `right` in ascending order; null equals nothing."""
    if left.type != right.type:
        both = pa.int64() if pa.types.is_integer(left.type) and pa.types.is_integer(right.type) else pa.string()
        left, right = left.cast(both), right.cast(both)
    known = pc.unique(right).drop_null()
    missing = len(known)  # nulls come last
    return (pc.fill_null(pc.index_in(left, known), -1).to_numpy(zero_copy_only=False),
            pc.fill_null(pc.index_in(right, known), missing).to_numpy(zero_copy_only=False))


def cell_kernel(k: int, decimals: int, skip_self: bool,
                meets: Callable[[pa.Table, pa.Table, np.ndarray, np.ndarray], object] | None = None):
    """What a cell makes of its two sides, each (uid, vec) with, if classes must not meet, label.

    `meets` may cut the rows and places of a class down: it yields pairs of both.
    """
    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows and right.num_rows:
            right = right.take(pc.sort_indices(right["uid"]))
        nearest = Nearest(units(left["vec"]) if left.num_rows else np.zeros((0, 1)),
                          units(right["vec"]) if right.num_rows else np.zeros((0, 1)), k, decimals)
        if left.num_rows and right.num_rows:
            codes = id_codes(left["uid"], right["uid"]) if skip_self else (None, None)
            mine, theirs = np.zeros(left.num_rows, np.int64), np.zeros(right.num_rows, np.int64)
            if "label" in left.schema.names:
                mine, theirs = id_codes(left["label"], right["label"])
            mine, theirs = groups_of(mine), groups_of(theirs)
            for code in mine.keys() & theirs.keys():
                pairs = [(mine[code], theirs[code])] if meets is None else meets(left, right, mine[code], theirs[code])
                for rows, places in pairs:
                    nearest.offer(rows, places, *codes)
        return nearest.told(left["uid"], right["uid"])

    return compare


def compare_cells(left: DataFrame, right: DataFrame, cells: int, keys: list[str], kernel) -> DataFrame:
    """(left_id, right_id, score): what `kernel` makes of the rows of both sides with equal `keys`."""
    tasks = min(4096, 2 * max(1, cells))  # a number, so that few bytes with much to compare are not put together
    a, b = (df.repartition(tasks, *keys).groupBy(*keys) for df in (left, right))
    kinds = [df.schema["uid"].dataType.simpleString() for df in (left, right)]
    return a.cogroup(b).applyInArrow(kernel, StructType.fromDDL(f"left_id {kinds[0]}, right_id {kinds[1]}, score double"))


def _by_part(numbers: list[int], part: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, numbers)), part + 1) if len(numbers) > 1 else F.lit(numbers[0])


def best_by_cosine(left: DataFrame, right: DataFrame, uid: str, vector: str, k: int, decimals: int,
                   label: str | None = None, skip_self: bool = False, grid: tuple[int, int] | None = None) -> DataFrame:
    """(left_id, right_id, score): up to `k` best right rows per left row and cell; with a `label`, of equal labels.

    Rows without a vector, or without a label where one is asked for, meet
    nothing. The grid follows from the sizes unless it is given.
    """
    parts = PARTS if label else 1
    part = F.pmod(F.xxhash64(label), F.lit(parts)).cast("int") if label else F.lit(0)
    sides, sizes, width = [], [], 1
    for df in (left, right):
        df = df.select(F.col(uid).alias("uid"), F.col(vector).alias("vec"), part.alias("_part"),
                       *([F.col(label).alias("label")] if label else []))
        df = df.where(F.col("vec").isNotNull() & (F.col("label").isNotNull() if label else F.lit(True)))
        found = df.groupBy("_part").agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("width")).collect()
        sizes.append({r["_part"]: r["n"] for r in found})  # PARTS rows at most
        width = max([width, *(r["width"] for r in found)])
        sides.append(df)
    side = side_rows(max(sum(s.values()) for s in sizes), width)
    shape = [[-(-s.get(p, 0) // side) for p in range(parts)] for s in sizes]
    if grid:
        shape = [[g if n else 0 for n in ns] for g, ns in zip(grid, shape)]

    def placed(df: DataFrame, own: str, other: str, mine: list[int], theirs: list[int]) -> DataFrame:
        copies, at = _by_part(theirs, F.col("_part")), F.greatest(_by_part(mine, F.col("_part")), F.lit(1))
        return df.where(copies > 0).withColumns({
            own: F.pmod(F.xxhash64("uid", "vec"), at).cast("int"),
            other: F.explode(F.sequence(F.lit(0), copies - 1))})

    return compare_cells(placed(sides[0], "_row", "_col", *shape), placed(sides[1], "_col", "_row", *shape[::-1]),
                         sum(a * b for a, b in zip(*shape)), ["_part", "_row", "_col"], cell_kernel(k, decimals, skip_self))
