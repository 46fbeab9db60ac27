"""SimHash near-duplicates: all fingerprints within a few bits, through pivot distance tables.

Distances to PIVOTS fixed reference fingerprints are computed once for every
distinct fingerprint. Two fingerprints within d bits differ by at most d in each
of these coordinates, so a pair whose largest coordinate difference is over d is
discarded; survivors are verified bit by bit.

One random pivot lets about a third of unrelated pairs pass, and its windows
overlap, so coordinates alone cannot say which pairs should meet. Pairs meet in
cells: the bits are cut into four blocks, two differing bits leave two blocks
equal, and the cell is those two blocks. Cells of over `cell_rows` fingerprints
are cut again in the bits that are not yet fixed, three times at most, after
which a cell has no more than 256 members; so no group grows with the input, and
none is capped. Within a cell rows are ordered by the first coordinate, compared
only as far as it allows, and only a spanning forest of the links is returned.

Defined results: null and empty texts have no words and fingerprint zero, and are
linked like others; exact copies share a fingerprint and are compared once;
null ids are reachable but never the smallest; an empty table gives no rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import LOWER_AZ, attach_weighted, split_for, text_of, written
from larkspur.llm.components import components
from larkspur.llm.words import may_be_in

SEED = 42
SHINGLE = 3
BITS = 2
PIVOTS = 8
CELL_ROWS = 2048
ROWS_A_TASK = 500_000
_FIRST = 1 << 16


def pivot_fingerprints(n: int = PIVOTS) -> list[int]:
    """Fixed references: hashes of their own numbers."""
    return [xxhash.xxh64_intdigest(i.to_bytes(8, "little"), SEED) for i in range(n)]


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    words = text.encode().translate(LOWER_AZ).split()
    if not words:
        return 0
    grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
    ones, n = np.zeros(64, np.int64), 0
    hashes = map(xxhash.xxh64_intdigest, grams, itertools.repeat(SEED))
    while True:
        h = np.fromiter(itertools.islice(hashes, _FIRST), "<u8")
        if not len(h):
            break
        n += len(h)
        ones += np.unpackbits(h.view(np.uint8), bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, carry: str = "doc_id") -> DataFrame:
    """`carry` (a column) and fp (the 64 bits as a long)."""
    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.fromiter((fingerprint(t.as_py(), shingle) for t in b.column(1)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], names=[carry, "fp"])

    kind = docs.schema[carry].dataType.simpleString()
    return docs.select(carry, text_of(docs).alias("_text")).mapInArrow(compute, f"{carry} {kind}, fp bigint")


# ---- cells ------------------------------------------------------------------

def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def finer_masks(mask: int, bits: int = BITS, blocks: int = 4) -> list[int]:
    """Masks that fix, besides `mask`, all but `bits` of `blocks` blocks of the other bits."""
    free = [i for i in range(64) if not mask >> i & 1]
    cut = [free[i * len(free) // blocks:(i + 1) * len(free) // blocks] for i in range(blocks)]
    return [mask | sum(1 << i for b in chosen for i in b) for chosen in itertools.combinations(cut, blocks - bits)]


def links_in_cells(cell: np.ndarray, fp: np.ndarray, pivots: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forests of the links within cells; rows are sorted by cell and first coordinate."""
    root = np.arange(len(fp))

    def join(a: np.ndarray, b: np.ndarray) -> None:
        while True:
            while not np.array_equal(root, up := root[root]):
                root[:] = up
            low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
            if (low == high).all():
                return
            np.minimum.at(root, high, low)

    first, bits_of = pivots[:, 0], fp.view(np.uint64)  # bitwise_count of a signed number is that of its absolute value
    for step in range(1, len(fp)):
        near = np.flatnonzero((cell[step:] == cell[:-step]) & (first[step:] - first[:-step] <= bits))
        if not len(near):
            break
        near = near[np.abs(pivots[near] - pivots[near + step]).max(axis=1) <= bits]
        near = near[np.bitwise_count(bits_of[near] ^ bits_of[near + step]) <= bits]
        if len(near):
            join(near, near + step)
    linked = np.flatnonzero(root != np.arange(len(fp)))
    return fp[linked], fp[root[linked]]


def near_links(fps: DataFrame, bits: int = BITS, cell_rows: int = CELL_ROWS, blocks: int = 4) -> DataFrame:
    """u, v: links that connect all fingerprints within `bits` bits. `fps` is a written table of distinct fp."""
    spark = fps.sparkSession
    tasks = split_for(spark, 6 * fps.count(), ROWS_A_TASK)
    refs = [_signed(p) for p in pivot_fingerprints()]
    names = [f"d{i}" for i in range(len(refs))]
    table = written(fps.select("fp", *[F.bit_count(F.col("fp").bitwiseXOR(F.lit(r))).cast("tinyint").alias(n)
                                       for r, n in zip(refs, names)]))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in itertools.chain(batches, [None]):
            if b is None and held is None:
                return
            t = pa.Table.from_batches([x for x in ([b] if b is not None else [])]) if held is None else (
                held if b is None else pa.concat_tables([held, pa.Table.from_batches([b])]))
            mask, value = t["mask"].to_numpy(), t["value"].to_numpy()
            new = np.append(True, (mask[1:] != mask[:-1]) | (value[1:] != value[:-1]))
            cell = np.cumsum(new)
            whole = t.num_rows if b is None else int(np.flatnonzero(new)[-1])  # the last cell may go on
            held = None if b is None else t.slice(whole)
            if whole:
                d = np.stack([t[n].to_numpy()[:whole] for n in names], axis=1).astype(np.int16)
                u, v = links_in_cells(cell[:whole], t["fp"].to_numpy()[:whole], d, bits)
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    rows, masks, found = table.withColumn("mask", F.lit(0).cast("bigint")), [0], []
    while masks:
        finer = {m: finer_masks(m, bits, blocks) for m in masks}
        pick = F.create_map(*[x for m, f in finer.items() for x in (
            F.lit(_signed(m)), F.array(*[F.lit(_signed(y)) for y in f]))])
        cells = rows.withColumn("mask", F.explode(pick[F.col("mask")])).withColumn(
            "value", F.col("fp").bitwiseAND(F.col("mask")))
        if len(found):
            cells = written(cells)
        sizes = written(cells.groupBy("mask", "value").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
        masks = sorted({y for f in finer.values() for y in f})
        final = all(64 - bin(m).count("1") <= 8 for m in masks)
        shared = written(attach_weighted(cells, sizes, ["mask", "value"], "n"))
        small = shared if final else shared.filter(F.col("n") <= cell_rows)
        found.append(small.select("mask", "value", "fp", *names).repartition(tasks, "mask", "value")
                     .sortWithinPartitions("mask", "value", "d0").mapInArrow(compare, "u bigint, v bigint"))
        rows = shared.filter(F.col("n") > cell_rows).drop("n", "value")
        if final or rows.isEmpty():
            break
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """doc_id, fp, component_id, root: one row per document; the component's smallest doc_id and smallest fingerprint."""
    rows = written(fingerprints(docs, shingle))
    groups = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")))
    roots = written(components(near_links(groups.select("fp"), bits, cell_rows)))
    members = groups.join(roots.select(F.col("u").alias("fp"), "root"), "fp", "left").select(
        "fp", "least", "n", F.coalesce("root", "fp").alias("root"))
    members = written(members)
    least = written(members.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("m")))
    of_fp = written(attach_weighted(members, least, ["root"], "m").select("fp", "n", "component_id", "root"))
    return attach_weighted(rows, of_fp, ["fp"], "n").select("doc_id", "fp", "component_id", "root")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """One row of `docs` for every group of near-duplicates: that of the smallest doc_id; of rows that share it, any.

    Groups without any id keep one row of their smallest fingerprint.
    """
    found = written(near_duplicates(docs, shingle, bits, cell_rows))
    stays = written(found.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.sum(F.when(F.col("doc_id") == F.col("component_id"), 1).otherwise(0)).alias("n")))
    # bit tables decide most rows where they are; only rows of which they leave open whether they stay are shuffled
    one, not_one, more = (may_be_in(stays.filter(f"n {x} 1").select("doc_id"), ["doc_id"]) for x in ("=", "!=", ">"))
    named = docs.filter("doc_id IS NOT NULL")
    once = named.filter(~not_one).unionByName(
        named.filter(not_one & one).join(stays.filter("n = 1").select("doc_id"), "doc_id", "left_semi"))
    often = named.filter(more).join(stays.filter("n > 1").select("doc_id"), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    # components() names a component by its smallest vertex, so root is a fingerprint of the group itself
    nameless = found.filter("component_id IS NULL").select(F.col("root").alias("fp")).distinct()
    rows = docs.filter("doc_id IS NULL").select(F.struct(*docs.columns).alias("row"), "text")
    without_id = fingerprints(rows, shingle, "row").join(nameless, "fp", "left_semi").dropDuplicates(["fp"]).select("row.*")
    return once.unionByName(often).unionByName(without_id)
