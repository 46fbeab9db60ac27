"""Exact token counts at every prefix of a text, by dynamic programming over a byte-level BPE vocabulary.

For a piece w of the pre-tokenizer, the last token of the encoding of w[:i] is
the only token t that ends there and may follow the last token of
w[:i - len(t)]; so count[i] = count[i - len(t)] + 1, and one pass yields the
counts of all prefixes. A piece never reaches over the blanks before a word, so
counts of blank-and-word chunks are kept (bounded, per worker) and a text's
prefix table is their running sum. Questions about truncation or budgets are
then look-ups in that table; nothing is encoded again.

The count at position i is what the library gives for text[:i] alone, also
where a cut falls into white space or a contraction or a special string.

Defined results: a null text counts as empty (0 tokens); special strings count
as their one token, as is the library's default; repeated rows and null ids pass
through; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, LongType, StructField, StructType

from larkspur.llm.common import Memo, text_of

#: the pre-tokenizer's pattern; a fixed value of byte-level BPE files
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_CHUNKS = re.compile(r"[ \t-\r]*[^ \t-\r]+|[ \t-\r]+").findall
_OTHER_BLANK = re.compile("[\x1c-\x1f\x85\xa0  -     　]").search
CACHE_ROWS = 600_000
_HEAD = 6
_ONE_PIECE = re.compile(" ?[A-Za-z]+").fullmatch


def byte_of_char() -> dict[str, int]:
    """The printable stand-ins that byte-level BPE files use for bytes."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class PrefixCounter:
    """Counts of all prefixes. `table(text)[i]` is the number of tokens of text[:i]."""

    def __init__(self, path: str, cache_rows: int = CACHE_ROWS):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, model = spec["pre_tokenizer"], spec["model"]
        if spec["normalizer"] or model["type"] != "BPE" or pre["type"] != "ByteLevel" or pre["add_prefix_space"]:
            raise ValueError(f"{path} is not a plain byte-level BPE file")
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            raise ValueError("special tokens that take in blanks or mind word borders are not supported")
        byte = byte_of_char()
        raw = lambda s: bytes(byte[c] for c in s)
        special = [t["content"] for t in spec["added_tokens"]]
        self.tokens = {raw(t) for t in model["vocab"] if t not in special}
        merges = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.rank = {(raw(a), raw(b)): i for i, (a, b) in enumerate(merges)}
        #: every ending of a token, and whether it is one
        self.ends = {t[i:]: False for t in self.tokens for i in range(1, len(t))} | dict.fromkeys(self.tokens, True)
        #: last tokens and counts for the beginnings that pieces share
        self.heads = Memo(lambda w: self._grow(w, [b""], [0]), cache_rows // 4)
        self.pieces: dict[str, list[int]] = {}
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.halves = {a + b: (a, b, r) for (a, b), r in self.rank.items()}
        if len(self.halves) != len(self.rank):
            raise ValueError("two merges make the same token")
        self.edges: tuple[dict, dict] = ({}, {})
        self.follows: dict[tuple[bytes, bytes], bool] = {}
        self.chunks = Memo(self._chunk_bytes, cache_rows)
        self.cache_rows = cache_rows

    def _edge(self, t: bytes, side: int) -> list[tuple[bytes, int]]:
        """The parts of t that come to lie at its right (1) or left (0) end while it is merged, and the merge that ends each."""
        found = self.edges[side].get(t)
        if found is None:
            found, ended, part = [], 1 << 60, t
            while True:
                found.append((part, ended))
                if part not in self.halves:
                    break
                *two, ended = self.halves[part]
                part = two[side]
            self.edges[side][t] = found
        return found

    def _may_follow(self, last: bytes, t: bytes) -> bool:
        """Whether last and t stay apart: no merge over their border comes before the merges inside them. Ties go to the left."""
        if not last:
            return True
        if len(self.follows) > self.cache_rows:
            self.follows.clear()
        rank = self.rank
        self.follows[last, t] = apart = not any(
            r < x_end and r <= y_end
            for x, x_end in self._edge(last, 1) for y, y_end in self._edge(t, 0)
            if (r := rank.get((x, y))) is not None)
        return apart

    def piece(self, w: bytes) -> list[int]:
        """Token counts of w[:0], w[:1], ... as byte prefixes of one piece."""
        head = w[:_HEAD]
        last, count = self.heads[head] if len(w) > _HEAD else ([b""], [0])
        return self._grow(w, last.copy(), count.copy())[1]

    def _grow(self, w: bytes, last: list[bytes], count: list[int]) -> tuple[list[bytes], list[int]]:
        """Carries the last tokens and the counts of the first prefixes of w on to all of them."""
        ends, follows = self.ends, self.follows
        for i in range(len(last), len(w) + 1):
            for j in range(i - 1, -1, -1):
                t = w[j:i]
                whole = ends.get(t)
                if whole is None:
                    raise ValueError(f"the vocabulary has no encoding of {w[:i]!r}")
                if whole:
                    fits = follows.get((last[j], t))
                    if self._may_follow(last[j], t) if fits is None else fits:
                        last.append(t)
                        count.append(count[j] + 1)
                        break
            else:
                raise ValueError(f"the vocabulary has no encoding of {w[:i]!r}")
        return last, count

    def _piece_counts(self, p: str) -> list[int]:
        """Counts of p[:1], p[:2], ... in code points."""
        found = self.pieces.get(p)
        if found is None:
            w = p.encode()
            counts = self.piece(w)
            found = [counts[i] for i in range(1, len(w) + 1) if i == len(w) or w[i] & 0xC0 != 0x80]
            if p in ("'re", "'ve", "'ll"):  # cut in two: mark and letter
                found[1] = 2
            if len(self.pieces) > self.cache_rows // 2:
                self.pieces.clear()
            if len(p) < 40:
                self.pieces[p] = found
        return found

    def chunk(self, s: str) -> list[int]:
        """Counts of s[:1], s[:2], ..., s, for s that starts at a border of pieces and has no special string."""
        if _ONE_PIECE(s):
            return self._piece_counts(s)
        out, base, before = [], 0, ""
        for p in PIECES.findall(s):
            at = self._piece_counts(p)
            start = base
            base += at[-1]
            at = [start + c for c in at]
            if before and before.isspace() and p[0].isspace():  # a cut after the blanks takes them as one piece
                at[0] = start - self.piece(before.encode())[-1] + self.piece((before + p[0]).encode())[-1]
            out += at
            before = p
        return out

    def _chunk_bytes(self, s: str) -> bytes:
        counts = self.chunk(s)
        return bytes(counts) if max(counts) < 256 else b""

    def ordinary(self, text: str) -> np.ndarray:
        """Prefix counts of a text whose special strings, if any, are ordinary text."""
        if not text:
            return np.zeros(1, np.int64)
        if not _OTHER_BLANK(text):
            chunks = _CHUNKS(text)
            inner = np.frombuffer(b"".join(map(self.chunks.__getitem__, chunks)), np.uint8)
            if len(inner) == len(text):
                size = np.fromiter(map(len, chunks), np.int64, len(chunks))
                total = inner[np.cumsum(size) - 1].astype(np.int64)
                return np.append(0, inner + np.repeat(np.cumsum(total) - total, size))
            chunks = [self.chunk(s) for s in chunks]
        else:
            chunks = [self.chunk(text)]
        base = np.cumsum([0, *(c[-1] for c in chunks)])
        return np.concatenate([[0], *(b + np.array(c) for b, c in zip(base, chunks))])

    def table(self, text: str) -> np.ndarray:
        if self.special is None or not self.special.search(text):
            return self.ordinary(text)
        out, start = [np.zeros(1, np.int64)], 0
        for m in self.special.finditer(text):
            part = self.ordinary(text[start:m.end()])  # inside the string a cut is ordinary text
            part[-1] = part[m.start() - start] + 1
            out.append(out[-1][-1] + part[1:])
            start = m.end()
        out.append(out[-1][-1] + self.ordinary(text[start:])[1:])
        return np.concatenate(out)


@functools.lru_cache(maxsize=2)
def counter(path: str, cache_rows: int = CACHE_ROWS) -> PrefixCounter:
    """One for each Python worker, which Spark reuses from task to task."""
    return PrefixCounter(path, cache_rows)


def longest_prefix(table: np.ndarray, budget: int) -> int:
    """Code points of the longest prefix that has at most `budget` tokens."""
    fits = np.flatnonzero(table <= budget)
    return int(fits[-1]) if len(fits) else 0


def prefix_token_counts(docs: DataFrame, path: str, limit: int = 1024, stored: bool = True,
                        columns: Sequence[str] = ("doc_id",), cache_rows: int = CACHE_ROWS) -> DataFrame:
    """`columns`, n_bytes, n_tokens, over_limit, limit_chars (code points within the limit) and, if `stored`,
    prefix_counts: the table as little-endian 32-bit numbers, for `decode`.
    """
    ids = [StructField(f"_c{i}", docs.schema[c].dataType) for i, c in enumerate(columns)]
    facts = [StructField("n_bytes", LongType()), StructField("n_tokens", LongType()),
             StructField("over_limit", BooleanType()), StructField("limit_chars", LongType())]
    schema = StructType(ids + facts + [StructField("prefix_counts", BinaryType())] * stored)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = counter(path, cache_rows).table
        for b in batches:
            n, cut, kept = [], [], []
            for text in b.column(b.num_columns - 1):
                t = table(text.as_py())
                n.append(int(t[-1]))
                cut.append(longest_prefix(t, limit) if t.max() > limit else len(t) - 1)
                if stored:
                    kept.append(t.astype("<i4").tobytes())
            n = pa.array(n, pa.int64())
            columns = [*b.columns[:-1], n, pa.compute.greater(n, limit), pa.array(cut, pa.int64())]
            yield pa.RecordBatch.from_arrays(
                columns + [pa.array(kept, pa.binary())] * stored, names=schema.names)

    named = [docs[c].alias(f"_c{i}") for i, c in enumerate(columns)]
    text = text_of(docs)
    out = docs.select(*named, F.octet_length(text).cast("bigint").alias("n_bytes"), text.alias("_text")).mapInArrow(count, schema)
    return out.select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(columns)], *schema.names[len(ids):])


def decode(prefix_counts: bytes) -> np.ndarray:
    return np.frombuffer(prefix_counts, "<i4")
