"""Words of many texts at once, as hashes, with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import LOWER_AZ

#: texts are handled in blocks of about so many bytes; one text is never cut
BLOCK_BYTES = 1 << 20
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C15
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    found = _powers.get(base)
    if found is None or len(found) < n:
        size = max(BLOCK_BYTES + (1 << 16), n)
        found = np.full(size, base, np.uint64)
        found[0] = 1
        found = np.cumprod(found)
        if size <= 4 * BLOCK_BYTES:
            _powers[base] = found
    return found[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and start of every word of `raw`, and the number of line feeds before it.

    A word's hash is a polynomial in its bytes, modulo 2^64, taken from running sums.
    """
    buf = np.frombuffer(raw, np.uint8)
    blank = np.concatenate([[True], _BLANK[buf], [True]])
    edge = np.flatnonzero(blank[1:] != blank[:-1])
    start, end = edge[::2], edge[1::2]
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * _power(_BASE, len(buf)), out=total[1:])
    h = (total[end] - total[start]) * _power(pow(_BASE, -1, 1 << 64), len(buf) + 1)[start]
    before = np.searchsorted(start, np.flatnonzero(buf == 10))  # words before every line feed
    return mix(h), start, np.repeat(np.arange(len(before) + 1), np.diff(before, prepend=0, append=len(start)))


def blocks(column: pa.Array | pa.ChunkedArray) -> Iterator[tuple[int, int, list[bytes]]]:
    """Ranges of texts of about BLOCK_BYTES together, and these texts with A-Z lower-cased."""
    column = column.cast(pa.binary())
    ends = np.cumsum(pa.compute.binary_length(column).to_numpy(zero_copy_only=False) if isinstance(column, pa.Array)
                     else pa.compute.binary_length(column).to_numpy())
    first = 0
    while first < len(column):
        start = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, start + BLOCK_BYTES, "right")))
        yield first, last, [t.translate(LOWER_AZ) for t in column.slice(first, last - first).to_pylist()]
        first = last


def packed(x: np.ndarray) -> bytes:
    """Non-negative numbers in as few bytes each as hold the largest; the first byte says how many that is."""
    most = int(x.max()) if len(x) else 0
    size = next(s for s in (1, 2, 4, 8) if most < 1 << 8 * s)
    return bytes([size]) + x.astype(f"<u{size}").tobytes()


def unpacked(blob: bytes | pa.Buffer) -> np.ndarray:
    x = np.frombuffer(blob, np.uint8)
    return x[1:].view(f"<u{int(x[0])}").astype(np.int64)


CHUNK = 1 << 14


def gather_table(df: DataFrame, fill, size: int, kind, combine: str) -> np.ndarray:
    """An array of fixed `size` that all rows of `df` add to.

    `fill(batch, array)` adds one Arrow batch to a task's own array; the tasks'
    arrays meet in chunks, by sum, by bitwise or, or by a sum that stays at the
    greatest number of their kind (`fill` sees to that within a task). Only the finished array, whose
    size does not depend on the data, reaches the driver.
    """
    name, step = np.dtype(kind).str, min(CHUNK, size)

    def fill_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, some = np.zeros(size, name), False
        for b in batches:
            some = some or b.num_rows > 0
            fill(b, own)
        if some:
            chunk = [(i // step, own[i:i + step].tobytes()) for i in range(0, size, step) if own[i:i + step].any()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([c for c, _ in chunk], pa.int32()), pa.array([x for _, x in chunk], pa.binary())],
                names=["chunk", "part"])

    def meet(t: pa.Table) -> pa.Table:
        out = np.zeros(step, name)
        for x in t["part"]:
            x = np.frombuffer(x.as_buffer(), name)
            if combine == "sum":
                out[:len(x)] += x
            elif combine == "saturate":
                out[:len(x)] += np.minimum(x, np.iinfo(name).max - out[:len(x)])
            else:
                out[:len(x)] |= x
        return pa.table({"chunk": t["chunk"][:1], "part": pa.array([out.tobytes()], pa.binary())})

    schema = "chunk int, part binary"
    got = df.mapInArrow(fill_all, schema).groupBy("chunk").applyInArrow(meet, schema).collect()
    out = np.zeros(-(-size // step) * step, name)
    for chunk, part in got:
        out[chunk * step:(chunk + 1) * step] = np.frombuffer(part, name)
    return out[:size]


# ---- bit tables of keys -----------------------------------------------------

LOOKUP_BITS = 24, 28  # 2 to 32 MB, by the number of wanted keys; a table that is too full only lets more pass


def bit_at(table: np.ndarray, place: np.ndarray) -> np.ndarray:
    return (table[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def set_bits(table: np.ndarray, place: np.ndarray) -> None:
    np.bitwise_or.at(table, place >> 3, (1 << (place & 7)).astype(np.uint8))


def lookup_bits(keys: int) -> int:
    """Bits of the address in a bit table for so many keys, sixteen places a key within LOOKUP_BITS."""
    return min(LOOKUP_BITS[1], max(LOOKUP_BITS[0], (16 * keys).bit_length()))


def may_be_in(wanted: DataFrame, keys: list[str]) -> Column:
    """Whether the row's `keys`, of the same types, may be among those of `wanted`; surely not where it says no.

    A bit table of bounded size is broadcast, so rows that it rules out need no shuffle.
    """
    bits = lookup_bits(wanted.count())

    def places(h: np.ndarray) -> np.ndarray:
        return (h.astype(np.int64).view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)

    def fill(batch: pa.RecordBatch, own: np.ndarray) -> None:
        set_bits(own, places(batch.column(0).to_numpy()))

    table = wanted.sparkSession.sparkContext.broadcast(
        gather_table(wanted.select(F.xxhash64(*keys).alias("h")), fill, 1 << (bits - 3), np.uint8, "or"))

    @F.arrow_udf("boolean")
    def holds(h: pa.Array) -> pa.Array:
        return pa.array(bit_at(table.value, places(h.to_numpy())))

    return holds(F.xxhash64(*keys))
