"""Cross-tokenizer alignment: which tokens of A and B cover the same bytes, by lockstep merging.

Both tokenizers spell the same bytes, a space and the text, so a token is a range
of bytes. One state vector holds, for every document of a block, a pointer into
its A tokens and one into its B tokens. A step emits the pair under the pointers
of all documents at once (a link: the two ranges overlap), then moves on the
pointer whose token ends first, or both where they end together (a cut). Finished
documents are compacted out of the vector.

Links are counted by block: a block keeps a dictionary of its distinct id pairs
with the number of its documents that hold each, and its documents keep places in
that dictionary. Dictionaries are summed over the corpus by pair, and only the
pairs that a block has go back to it. No document, pair or block is a hot group:
a pair comes at most once from a block, and a block is `block_bytes` of text, or
one longer text.

Defined results: texts that are null or empty, or that a tokenizer does not spell
byte for byte, have no tokens: zeros, and an empty text for the groups; rows that
share an id, and rows without id, are documents of their own; special tokens'
strings are ordinary text; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import text_of, written

#: bytes of text that are aligned together
BLOCK_BYTES = 6 << 20
#: fixed value: how byte-level BPE files split text before merging
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: the splitter of the fast path recurses over white space; texts with longer runs take the other one
_LONG_BLANK = re.compile(r"\s{10000}")


def _byte_letters() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves, and the others, in order, as letters from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(rest)}


class ByteTokens:
    """A byte-level BPE of the tokenizers library; `ids(text)` are those of a space and the text."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import tiktoken
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        letter = _byte_letters()
        spelled = {bytes(letter[c] for c in t): i for t, i in model["vocab"].items() if all(c in letter for c in t)}
        self.size = max(model["vocab"].values()) + 1
        self.length = np.zeros(self.size, np.int32)
        for t, i in spelled.items():
            self.length[i] = len(t)
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        merged = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = [model["vocab"]["".join(m)] for m in merged]
        special = {t["id"] for t in json.loads(self.library.to_str())["added_tokens"]}
        # with ids in the order of merges, ids are ranks, and the rank library gives the same tokens in a third of the time
        self.fast = tiktoken.Encoding(
            os.path.basename(path), pat_str=_SPLIT, special_tokens={},
            mergeable_ranks={t: i for t, i in spelled.items() if i not in special}) if made == sorted(made) else None

    def ids(self, text: str) -> list[int]:
        if self.fast is None or len(text) >= 10000 and _LONG_BLANK.search(text):
            return self.library.encode(" " + text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(" " + text)

    def faithful(self, text: str, raw: bytes, ids: np.ndarray) -> bool:
        return int(self.length[ids].sum()) == len(raw)  # every byte has a token, and no token stands for other bytes


class PieceTokens:
    """A sentencepiece model, which puts the space before the text by itself."""

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = self.model.get_piece_size()
        self.bytes = [bytes([int(p[3:-1], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
                      for i, p in enumerate(self.model.id_to_piece(list(range(self.size))))]
        self.length = np.array([len(b) for b in self.bytes], np.int32)

    def ids(self, text: str) -> list[int]:
        return self.model.encode(text, num_threads=1)

    def faithful(self, text: str, raw: bytes, ids: np.ndarray) -> bool:
        return int(self.length[ids].sum()) == len(raw) and b"".join(map(self.bytes.__getitem__, ids.tolist())) == raw


@functools.lru_cache(maxsize=2)
def _tokenizer(path: str) -> ByteTokens | PieceTokens:
    return PieceTokens(path) if path.endswith(".model") else ByteTokens(path)


class Tokens(NamedTuple):
    """Tokens of a block of documents; document d has those from start[d] to start[d + 1]."""

    ids: np.ndarray
    end: np.ndarray  # byte behind each token, counted within its document
    start: np.ndarray


def tokens_of(texts: list[str | None], a: ByteTokens | PieceTokens, b: ByteTokens | PieceTokens) -> tuple[Tokens, Tokens]:
    """Tokens of both kinds; none where the text has no faithful spelling in both."""
    ids: tuple[list, list] = [], []
    for text in texts:
        both = [np.array(t.ids(text), np.int32) for t in (a, b)] if text else []
        raw = b" " + text.encode() if text else b""
        fine = bool(text) and all(t.faithful(text, raw, i) for t, i in zip((a, b), both))
        for k in range(2):
            ids[k].append(both[k] if fine else np.zeros(0, np.int32))
    out = []
    for k, t in enumerate((a, b)):
        start = np.append(0, np.cumsum([len(i) for i in ids[k]])).astype(np.int64)
        flat = np.concatenate(ids[k]) if ids[k] else np.zeros(0, np.int32)
        end = np.cumsum(t.length[flat], dtype=np.int64)
        before = np.append(0, end)[start[:-1]]
        out.append(Tokens(flat, end - np.repeat(before, np.diff(start)), start))
    return out[0], out[1]


class Alignment(NamedTuple):
    """Links as (document, A token, B token) in the order of steps, and for each cut the last token before it, in order."""

    doc: np.ndarray
    a: np.ndarray
    b: np.ndarray
    cut_doc: np.ndarray
    cut_a: np.ndarray
    cut_b: np.ndarray


def lockstep(a: Tokens, b: Tokens) -> Alignment:
    """All documents' pointers advance together, one link a step, until every document is through."""
    doc = np.flatnonzero(np.diff(a.start)).astype(np.int32)
    at_a, at_b = a.start[doc].astype(np.int32), b.start[doc].astype(np.int32)
    stop = a.start[doc + 1].astype(np.int32)
    steps: list[tuple[np.ndarray, ...]] = []
    cuts: list[tuple[np.ndarray, ...]] = []
    while len(doc):
        steps.append((doc, at_a, at_b))
        end_a, end_b = a.end[at_a], b.end[at_b]
        cut = end_a == end_b
        cuts.append((doc[cut], at_a[cut], at_b[cut]))
        at_a, at_b = at_a + (end_a <= end_b), at_b + (end_b <= end_a)
        going = at_a < stop
        if not going.all():  # both pointers of a document run out at its last byte
            doc, at_a, at_b, stop = doc[going], at_a[going], at_b[going], stop[going]
    none = [(np.zeros(0, np.int32),) * 3]
    link = [np.concatenate(x) for x in zip(*(steps or none))]
    cut_doc, cut_a, cut_b = (np.concatenate(x) for x in zip(*(cuts or none)))
    order = np.argsort(cut_a)
    return Alignment(*link, cut_doc[order], cut_a[order], cut_b[order])


@functools.lru_cache(maxsize=2)
def _digits(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of so many bits in decimal, one a row, and how many digits each has."""
    size = 1 << bits
    text = np.char.encode(np.arange(size).astype(str), "ascii")
    wide = text.dtype.itemsize
    return text.view(np.uint8).reshape(size, wide), np.char.str_len(text).astype(np.int8)


def group_texts(a: Tokens, b: Tokens, found: Alignment) -> tuple[bytes, np.ndarray]:
    """`a1,a2|b1;a3|b2,b3` of all documents in a row, and where each document's ends."""
    n_a, n_b = len(a.ids), len(b.ids)
    bound_a, bound_b = np.append(0, found.cut_a + 1), np.append(0, found.cut_b + 1)
    of_a = np.repeat(np.arange(len(found.cut_a)), np.diff(bound_a))
    of_b = np.repeat(np.arange(len(found.cut_b)), np.diff(bound_b))
    place_a, place_b = np.arange(n_a) + bound_b[of_a], np.arange(n_b) + bound_a[of_b + 1]
    ids, sign = np.empty(n_a + n_b, np.int32), np.full(n_a + n_b, ord(","), np.uint8)
    ids[place_a], ids[place_b] = a.ids, b.ids
    sign[place_a[found.cut_a]], sign[place_b[found.cut_b]] = ord("|"), ord(";")
    has = np.flatnonzero(np.diff(b.start))
    last = place_b[b.start[has + 1] - 1]
    digits, count = _digits(int(ids.max()).bit_length() if len(ids) else 1)
    wide = digits.shape[1]
    grid = np.zeros((len(ids), wide + 1), np.uint8)
    grid[:, :wide] = digits[ids]
    count = count[ids]
    grid[np.arange(len(ids)), count] = sign
    used = count + np.int8(1)
    used[last] -= 1
    ends = np.append(0, np.cumsum(used, dtype=np.int64))
    return grid[np.arange(wide + 1, dtype=np.int8) < used[:, None]].tobytes(), ends[a.start + b.start]


def _blocks(batches: Iterator[pa.RecordBatch], block_bytes: int) -> Iterator[tuple[pa.Array, list[str | None]]]:
    """First column and texts (second column) of rows of about so many bytes."""
    for b in batches:
        size = np.cumsum(pa.compute.binary_length(b.column(1)).fill_null(0).to_numpy(zero_copy_only=False))
        first = 0
        while first < b.num_rows:
            done = size[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(size, done + block_bytes, "right")))
            yield b.column(0).slice(first, last - first), b.column(1).slice(first, last - first).to_pylist()
            first = last


def align_tokens(docs: DataFrame, a_path: str, b_path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, a_ids, b_ids, a_ends, b_ends, cuts, link_a, link_b: a document's tokens, with the bytes behind them, and
    what lockstep merging finds: the bytes where tokens of both end, and the numbers of the tokens that each link joins."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _blocks(batches, block_bytes):
            a, b = tokens_of(texts, _tokenizer(a_path), _tokenizer(b_path))
            found = lockstep(a, b)
            order = np.argsort(found.doc, kind="stable")
            links = np.append(0, np.cumsum(np.bincount(found.doc, minlength=len(texts))))
            cuts = np.append(0, np.cumsum(np.bincount(found.cut_doc, minlength=len(texts))))
            doc = found.doc[order]

            def lists(start, values, kind):
                return pa.ListArray.from_arrays(pa.array(start, pa.int32()), pa.array(values, kind))

            yield pa.RecordBatch.from_arrays([
                ids, lists(a.start, a.ids, pa.int32()), lists(b.start, b.ids, pa.int32()),
                lists(a.start, a.end, pa.int64()), lists(b.start, b.end, pa.int64()),
                lists(cuts, a.end[found.cut_a], pa.int64()),
                lists(links, found.a[order] - a.start[doc], pa.int32()), lists(links, found.b[order] - b.start[doc], pa.int32())],
                names=["doc_id", "a_ids", "b_ids", "a_ends", "b_ends", "cuts", "link_a", "link_b"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_of(docs).alias("text")).mapInArrow(
        run, f"doc_id {kind}, a_ids array<int>, b_ids array<int>, a_ends array<bigint>, b_ends array<bigint>, "
             "cuts array<bigint>, link_a array<int>, link_b array<int>")


# ---- links that are counted over the corpus ---------------------------------

_BLOCK = ("doc_id array<bigint>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, n_links array<bigint>, "
          "groups_sha256 array<string>, pairs array<bigint>, holders array<bigint>, n_pairs array<int>, place binary, times binary")


_BLOCK_ARROW = pa.schema([(c, {"array<bigint>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()),
                               "array<string>": pa.list_(pa.string()), "binary": pa.binary()}[kind])
                          for c, kind in (x.split(" ") for x in _BLOCK.split(", "))])


def _least(x: np.ndarray) -> np.ndarray:
    """Non-negative numbers in as few bytes as hold them all; the first byte of the result says how many that is."""
    kind = next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if not len(x) or int(x.max()) <= np.iinfo(k).max)
    return np.append(np.uint8(np.dtype(kind).itemsize), x.astype(kind).view(np.uint8))


def _wide(blob: memoryview | bytes) -> np.ndarray:
    x = np.frombuffer(blob, np.uint8)
    return x[1:].view(f"u{int(x[0])}").astype(np.int64)


def _gaps(x: np.ndarray, each: np.ndarray) -> np.ndarray:
    """Ascending numbers, in runs of `each`, as steps from the one before; a run's first number stands for itself."""
    before = np.append(0, x[:-1])[:len(x)]
    before[(np.cumsum(each) - each)[each > 0]] = 0
    return x - before


def _ungapped(x: np.ndarray, each: np.ndarray) -> np.ndarray:
    total = np.cumsum(x)
    start = (np.cumsum(each) - each)[each > 0]
    return total - np.repeat(np.append(0, total)[start], each[each > 0])


def _aligned_block(ids: pa.Array, texts: list[str | None], a_path: str, b_path: str) -> list:
    ta, tb = _tokenizer(a_path), _tokenizer(b_path)
    a, b = tokens_of(texts, ta, tb)
    found = lockstep(a, b)
    n = len(texts)
    text, ends = group_texts(a, b, found)
    has = np.diff(a.start) > 0
    shown = memoryview(text)
    sha = [hashlib.sha256(shown[ends[d]:ends[d + 1]]).hexdigest() if has[d] else "" for d in range(n)]
    pair = a.ids[found.a].astype(np.int64) * tb.size + b.ids[found.b]
    pairs = np.unique(pair)
    held, times = np.unique(found.doc.astype(np.int64) * max(1, len(pairs)) + np.searchsorted(pairs, pair), return_counts=True)
    holder, place = np.divmod(held, max(1, len(pairs)))
    each = np.bincount(holder, minlength=n)
    return [ids.cast(pa.int64()).to_pylist(), np.diff(a.start), np.diff(b.start), np.bincount(found.cut_doc, minlength=n),
            np.bincount(found.doc, minlength=n), sha, pairs, np.bincount(place, minlength=len(pairs)), each.astype(np.int32),
            _least(_gaps(place, each)).tobytes(), _least(times).tobytes()]


def aligned_blocks(docs: DataFrame, a_path: str, b_path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """A row for every block of documents: what each document has, the block's distinct pairs, and who holds them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _blocks(batches, block_bytes):
            values = _aligned_block(ids, texts, a_path, b_path)
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, _BLOCK_ARROW)], schema=_BLOCK_ARROW)

    return docs.select(docs["doc_id"].cast("bigint"), text_of(docs).alias("text")).mapInArrow(run, _BLOCK)


def pair_counts(blocks: DataFrame, b_size: int) -> DataFrame:
    """pair, documents, best: in how many documents a pair of ids is linked, and whether its A id has no pair in more."""
    each = blocks.select(F.explode(F.arrays_zip("pairs", "holders")).alias("x"))
    counts = written(each.groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.holders").alias("documents")))
    a_id = F.floor(F.col("pair") / b_size)
    most = counts.groupBy(a_id.alias("a_id")).agg(F.max("documents").alias("most"))
    return counts.withColumn("a_id", a_id).join(most, "a_id").select(
        "pair", "documents", (F.col("documents") == F.col("most")).alias("best"))


def _counted(block: pa.Table, facts: pa.Table) -> pa.Table:
    row = {c: block[c][0] for c in block.column_names}
    documents = np.zeros(len(row["pairs"].values), np.int64)
    best = np.zeros(len(documents), np.int64)
    at = facts["at"].to_numpy()
    documents[at], best[at] = facts["documents"].to_numpy(), facts["best"].to_numpy()
    each = row["n_pairs"].values.to_numpy().astype(np.int64)
    place = _ungapped(_wide(row["place"].as_buffer()), each)
    times = _wide(row["times"].as_buffer())
    start = np.cumsum(each) - each

    def summed(x: np.ndarray) -> np.ndarray:
        total = np.append(0, np.cumsum(x))
        return total[start + each] - total[start]

    plain = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    return pa.table({c: row[c].values for c in plain}
                    | {"n_best": summed(times * best[place]), "count_sum": summed(times * documents[place])})


def align_digests(docs: DataFrame, a_path: str, b_path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum: one row per document.

    A pair's count is the number of documents that hold it linked; n_best counts
    the links whose pair has the highest count of all pairs of its A id, count_sum
    adds the counts of all links.
    """
    blocks = written(aligned_blocks(docs, a_path, b_path, block_bytes)
                     .withColumn("block", F.monotonically_increasing_id()))
    facts = written(pair_counts(blocks, _tokenizer(b_path).size))
    wanted = blocks.select(F.col("block").alias("of"), F.posexplode("pairs").alias("at", "pair"))
    known = wanted.join(facts, "pair").select("of", "at", "documents", "best")
    out = ("doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
           "n_best bigint, count_sum bigint")
    return blocks.drop("holders").groupBy("block").cogroup(known.groupBy("of")).applyInArrow(_counted, out)
