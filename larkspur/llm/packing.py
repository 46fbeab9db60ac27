"""Packing token sequences by patterns fitted with non-negative least squares.

Documents become pieces of at most `capacity` tokens; the histogram of piece
lengths has at most `capacity` bins, whatever the corpus, and the whole plan is
made from it: patterns of one, two or three lengths are enumerated, their
repeat counts fitted to the histogram by non-negative least squares (with a
penalty on empty space), rounded down, and what the histogram then still holds
is packed best fit, a length with many pieces many times at once. The plan says
for every length which ranks of its pieces go where; pieces are ranked with
Spark (within salted blocks plus offsets, so one very common length is spread)
and take their places. Every step after the histogram is a join on length with
the plan, whose size depends on the capacity only.

Defined results: a null text counts as empty and is one piece of one token (the
end id); repeated rows are packed once each; null ids pass through; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import functools
import json
import os
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larkspur.llm.common import Memo, split_for, text_of, written
from larkspur.llm.token_counts import byte_of_char

CAPACITY = 4096
END_ID = 1
SWEEPS = 60
ROWS_A_BLOCK = 50_000
CACHE_ROWS = 600_000


#: printable Latin characters that are their own normal form and have one lower-case form everywhere
_PLAIN = re.compile("[!-~\xa1-\u012f\u0131-\u024f]+").fullmatch

#: marks that make one piece after letters; an apostrophe or a special token may not
_TAIL = "!\"#$%&()*+,-./:;=>?@[\\]^_`{|}~"


class ChunkIds:
    """Token ids of texts by the library; ids of blank-free chunks are kept, for no token reaches over a blank."""

    def __init__(self, path: str, cache_rows: int = CACHE_ROWS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        # part by part: the file as Python objects takes a worker many times the room of its bytes
        normalizer, pre = (json.loads(x.__getstate__()) for x in (self.tokenizer.normalizer, self.tokenizer.pre_tokenizer))
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        if any(c.isspace() for t in added for c in t) or not self._drops_blanks():
            raise ValueError("tokens of this tokenizer may hold blanks")
        if [n["type"] for n in normalizer["normalizers"]] != ["NFC", "Replace", "Lowercase"] or not all(
                t.startswith("<|") for t in added):
            raise ValueError("unknown normaliser or special tokens")
        pre = pre["pretokenizers"]
        self.split = regex.compile(pre[0]["pattern"]["Regex"]).findall
        self.letter = {b: c for c, b in byte_of_char().items()}
        self.pieces, self.words = Memo(self._piece, cache_rows // 2), Memo(self._word, cache_rows)

    def _drops_blanks(self) -> bool:
        ids = lambda s: self.tokenizer.encode(s, add_special_tokens=False).ids
        return all(ids(b) == [] and ids(f"a{b}!{b}b") == ids("a") + ids("!") + ids("b") for b in " \t\n\r\x0b\x0c")

    def _piece(self, piece: str) -> bytes:
        spelled = piece if piece.isascii() else "".join(map(self.letter.__getitem__, piece.encode()))
        return np.array([t.id for t in self.tokenizer.model.tokenize(spelled)], "<u4").tobytes()

    def _word(self, word: bytes) -> bytes:
        """Ids of one chunk. Plain Latin chunks skip the library's normaliser, which takes most of its time."""
        text = word.decode()
        head = text.rstrip(_TAIL)
        if head.isalpha() and (head.isascii() or _PLAIN(head)):  # letters are one piece, what follows another
            first = self.pieces[head.lower()]
            return first if len(head) == len(text) else first + self.pieces[text[len(head):]]
        if _PLAIN(text) and "<|" not in text:
            return b"".join(map(self.pieces.__getitem__, self.split(text.lower())))
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __call__(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.words.__getitem__, text.encode().split())), "<u4")  # at ASCII blanks


@functools.lru_cache(maxsize=2)
def chunk_ids(path: str, cache_rows: int = CACHE_ROWS) -> ChunkIds:
    """One for each Python worker, which Spark reuses from task to task."""
    return ChunkIds(path, cache_rows)


_PIECES = "row bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def pieces_of(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID,
              cache_rows: int = CACHE_ROWS) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: every document's ids and the end id, cut at the capacity."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = chunk_ids(path, cache_rows)
        for b in batches:
            rows, out = [], ([], [], [], [])
            for k, text in enumerate(b.column(1)):
                ids = np.append(ids_of(text.as_py()), np.uint32(end_id)).astype("<u4")
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start:start + capacity]
                    rows.append(k)
                    for c, v in zip(out, (piece, start, len(part), zlib.crc32(part.tobytes()))):
                        c.append(v)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(rows, pa.int64())), pa.array(out[0], pa.int32()),
                 *(pa.array(c, pa.int64()) for c in out[1:])],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", text_of(docs).alias("_text")).mapInArrow(
        cut, _PIECES.replace("row bigint", f"doc_id {id_type}"))


# ---- the plan, from a histogram ---------------------------------------------

Pattern = tuple[int, ...]


def few_document_patterns(hist: np.ndarray, widest: int = 24) -> list[Pattern]:
    """Patterns of up to three lengths that fill the capacity, or come as near as present lengths allow, longest first.

    Pairs for every length; triples from every length and `widest` partners
    spread over the lengths that fit. The number depends on the capacity only.
    """
    capacity = len(hist) - 1
    present = np.flatnonzero(hist).tolist()
    found: set[Pattern] = set()

    def largest(most: int) -> int:
        i = bisect_right(present, most)
        return present[i - 1] if i else 0

    for a in present:
        found.add((a,))
        b = largest(capacity - a)
        if b:
            found.add(tuple(sorted((a, b), reverse=True)))
        room = bisect_right(present, capacity - a)
        for i in np.unique(np.linspace(0, room - 1, widest).astype(int)) if room else ():
            b = present[i]
            c = largest(capacity - a - b)
            if c:
                found.add(tuple(sorted((a, b, c), reverse=True)))
    return sorted(found, key=lambda p: (-sum(p), p))


def fit_repeats(hist: np.ndarray, patterns: list[Pattern], sweeps: int = SWEEPS) -> np.ndarray:
    """Repeat counts x >= 0 that minimise |A x - hist|^2 + |w (empty space of x)|^2, by coordinate descent."""
    capacity = len(hist) - 1
    rest = hist.astype(float).copy()
    x = np.zeros(len(patterns))
    columns = []
    for p in patterns:
        lengths, times = np.unique(p, return_counts=True)
        empty = (capacity - sum(p)) / capacity
        columns.append((lengths.tolist(), times.tolist(), 2.0 * empty, float((times ** 2).sum() + 4.0 * empty ** 2)))
    space = 0.0  # the penalty row's left side; its target is 0
    for _ in range(sweeps):
        moved = 0.0
        for k, (lengths, times, weight, norm) in enumerate(columns):
            gain = -weight * space
            for a, t in zip(lengths, times):
                gain += t * rest[a]
            step = max(-x[k], gain / norm)
            if step:
                x[k] += step
                space += weight * step
                for a, t in zip(lengths, times):
                    rest[a] -= t * step
                moved = max(moved, abs(step))
        if moved < 0.25:
            break
    return x


def round_down(hist: np.ndarray, patterns: list[Pattern], x: np.ndarray) -> tuple[list[tuple[Pattern, int]], np.ndarray]:
    """Whole repeats, never more than the histogram holds, fullest patterns first; and what is left of it."""
    capacity, rest, plan = len(hist) - 1, hist.copy(), []
    for k in np.argsort([capacity - sum(p) for p in patterns], kind="stable"):
        p = patterns[k]
        if sum(p) < 0.98 * capacity:
            continue  # half-empty patterns are left to the best fit of what remains
        lengths, times = np.unique(p, return_counts=True)
        n = int(min(np.floor(x[k] + 1e-9), (rest[lengths] // times).min()))
        if n > 0:
            rest[lengths] -= times * n
            plan.append((p, n))
    return plan, rest


def pack_residual(rest: np.ndarray) -> list[tuple[Pattern, int]]:
    """Best fit: a sequence takes the longest length left, then again and again the longest that fits.

    It is repeated as often as its lengths allow, so the steps depend on the
    number of lengths, not of pieces.
    """
    rest = rest.copy()
    capacity = len(rest) - 1
    present = np.flatnonzero(rest).tolist()
    plan = []
    while present:
        used: dict[int, int] = {}
        room = capacity
        while room:
            i = bisect_right(present, room) - 1
            while i >= 0 and used.get(present[i], 0) >= rest[present[i]]:
                i -= 1
            if i < 0:
                break
            a = present[i]
            n = min(room // a, int(rest[a]) - used.get(a, 0))
            used[a] = used.get(a, 0) + n
            room -= n * a
        times = min(int(rest[a]) // t for a, t in used.items())
        plan.append((tuple(a for a, t in used.items() for _ in range(t)), times))
        for a, t in used.items():
            rest[a] -= t * times
            if not rest[a]:
                present.remove(a)
    return plan


def plan_sequences(hist: np.ndarray) -> pd.DataFrame:
    """length, first (rank), n, per (pieces of this length in a sequence), sequence (the first), offset (of the first)."""
    patterns = few_document_patterns(hist)
    plan, rest = round_down(hist, patterns, fit_repeats(hist, patterns))
    plan += pack_residual(rest)
    taken, sequence, rows = np.zeros(len(hist), np.int64), 0, []
    for p, times in plan:
        offset = 0
        for a, t in zip(*np.unique(p, return_counts=True)):
            rows.append((int(a), int(taken[a]), int(t * times), int(t), sequence, offset))
            taken[a] += t * times
            offset += int(a * t)
        sequence += times
    assert (taken == hist).all()
    return pd.DataFrame(rows, columns=["length", "first", "n", "per", "sequence", "offset"]).astype("int64")


# ---- places -----------------------------------------------------------------

def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, rows_a_block: int = ROWS_A_BLOCK) -> DataFrame:
    """`pieces` (a written table with length <= capacity) plus sequence_id and offset."""
    spark = pieces.sparkSession
    keys = [c for c in pieces.columns if c != "length"]
    counts = pieces.groupBy("length").count().collect()  # at most `capacity` rows
    hist = np.zeros(capacity + 1, np.int64)
    for length, n in counts:
        hist[length] = n
    blocks = split_for(spark, int(hist.sum()), rows_a_block)
    block = F.pmod(F.xxhash64(*keys), F.lit(blocks)).cast("int")
    sizes = pieces.groupBy("length", block.alias("block")).agg(F.count(F.lit(1)).alias("m"))
    before = sizes.select("length", "block", (F.sum("m").over(
        Window.partitionBy("length").orderBy("block")) - F.col("m")).alias("before"))
    within = F.row_number().over(Window.partitionBy("length", "block").orderBy(*keys)) - 1
    ranked = (pieces.withColumn("block", block).withColumn("within", within)
              .join(before, ["length", "block"])
              .withColumn("rank", F.col("within") + F.col("before")).drop("within", "before", "block"))
    plan = plan_sequences(hist)
    at = spark.sparkContext.broadcast({  # at most a few rows for each of `capacity` lengths and pattern
        c: plan.sort_values(["length", "first"])[c].to_numpy() for c in plan.columns})
    width = int(hist.max(initial=0)) + 1
    columns = pieces.columns
    schema = pieces.schema.simpleString()[7:-1] + ",sequence_id:bigint,offset:bigint"

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = at.value
        starts = p["length"] * width + p["first"]
        for b in batches:
            length = b.column("length").to_numpy()
            rank = b.column("rank").to_numpy()
            k = np.searchsorted(starts, length * width + rank, "right") - 1
            turn, slot = np.divmod(rank - p["first"][k], p["per"][k])
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in columns]
                + [pa.array(p["sequence"][k] + turn), pa.array(p["offset"][k] + slot * length)],
                names=[*columns, "sequence_id", "offset"])

    return ranked.select(*pieces.columns, F.col("rank").cast("bigint")).mapInArrow(place, schema)


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: every piece of every document in its place."""
    return pack_pieces(written(pieces_of(docs, path, capacity, end_id)), capacity)
