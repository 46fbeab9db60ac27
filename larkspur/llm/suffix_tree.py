"""Language-model scores from a probabilistic suffix tree over words.

A state is a run of up to DEPTH words. Candidates are runs seen at least
`least_context` times in training texts, whatever the corpus, so the tree grows
with it; every word that follows a candidate is counted. A candidate is kept if
its own next-word distribution, each occurrence predicted from the others (leave
one out), beats its parent's by `divergence` nats; the parent is the longest kept
suffix. A kept state with `total` followers gives a word that follows it n times
(n + PRIOR * p) / (total + PRIOR), p being its parent's probability, so every
state sums to one. The root has every training word, by absolute discounting, and
one unknown word with what that frees. A token is scored by the longest kept
suffix of what precedes it.

No task and no driver holds the tree. Texts become blocks of token numbers, one
row each, in a table that is bucketed by block. A block asks for the counts of its
own distinct words and runs, level by level: askings go to ranges of the hash, are
summed there, and the sums come back in the order they were asked in. Runs are only
asked for behind a run that the level before found frequent, and go to the range that
counted it. They are told as that run's place there, once, and the numbers of the words
that follow it: words are numbered by falling count when they are counted, frequent
runs in the order of asking, so that the places a block tells lie close together.
Answers are shuffled once, to a table that is bucketed like the blocks. One asking block of
every run is told to weigh it, so gains are summed over distinct runs; runs seen once
weigh alike behind a context and are only counted. A hot word
or run is one number a block; followers of a context that occurs over SPREAD times
are dealt to several hashes.

Words are known by 64-bit hashes. Defined results: a null text counts as empty,
which is the end token alone; a null id counts as held out; without training
texts every token is unknown, with probability one; repeated rows count and are
scored each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import pickle
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import held_out, parts, split_for, text_of
from larkspur.llm.words import blocks, mix, word_hashes
from larkspur.plans.shared import scratch_path

DEPTH = 3
LEAST_CONTEXT = 32
DIVERGENCE = 10.0
PRIOR = 50.0
FOLDS = 10
BLOCK_BYTES = 8 << 20  # of text that ask and are scored together; a block takes texts by the megabyte
BYTES_A_TASK = 64 << 20
BYTES_A_RANGE = 8 << 20
SPREAD = 1 << 18  # occurrences of a context whose followers go to one range
PLACE_BITS = 24  # of a key, for the place in a range; runs beyond them are known by a hash of their place
#: the end token's hash: no word is empty
END = int(mix(np.array([0xE0D], np.uint64))[0])
_ASKED = "kind int, range bigint, block bigint, keys binary, amounts binary"
_TOLD = "kind int, range bigint, block bigint, told binary, total bigint, words bigint, once bigint, twice bigint"


def followed(key: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Key of a run of words with one more word."""
    return mix(key * np.uint64(0x9E3779B97F4A7C15) + word)


def tokens(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts, each closed by the end token, and the number of tokens of each."""
    h, start, _ = word_hashes(b"\n".join(raws))
    n = np.diff(np.searchsorted(start, np.cumsum([len(r) + 1 for r in raws])), prepend=0)
    return np.insert(h, np.cumsum(n), np.uint64(END)), n + 1


@dataclass
class Root:
    tokens: int = 0
    words: int = 0
    discount: float = 0.5

    def known(self, count: np.ndarray) -> np.ndarray:
        """Probability of words by their training counts; 0 is the unknown word."""
        if not self.tokens:
            return np.ones(len(count))
        return np.where(count > 0, count - self.discount, self.discount * self.words) / self.tokens

    def base_log10(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + 0.1) / (self.tokens + 0.1 * (self.words + 1)))


class Distinct:
    """The distinct keys of an array, sorted, and the way from them to the array's places and back.

    Keys that stand for different things in `apart` are kept apart; one of these may come several times then.
    """

    def __init__(self, keys: np.ndarray, apart: np.ndarray | None = None):
        self.order = np.argsort(keys, kind="stable")
        in_order = keys[self.order]
        new = in_order[1:] != in_order[:-1]
        if apart is not None:
            new |= np.diff(apart[self.order]) != 0
        self.first = np.flatnonzero(np.append(True, new)[:len(keys)])
        self.keys = in_order[self.first]

    def total(self, amounts: np.ndarray) -> np.ndarray:
        return np.add.reduceat(amounts[self.order], self.first) if len(self.first) else amounts[:0]

    def one_of(self, values: np.ndarray) -> np.ndarray:
        return values[self.order[self.first]]

    def spread(self, values: np.ndarray) -> np.ndarray:
        out = np.empty(len(self.order), values.dtype)
        out[self.order] = np.repeat(values, np.diff(np.append(self.first, len(self.order))))
        return out


# ---- blocks -----------------------------------------------------------------

def squeezed(*arrays: np.ndarray) -> bytes:
    """Arrays of numbers, each byte of the numbers compressed on its own: high bytes are mostly alike, low ones are not."""
    zstd, out = pa.Codec("zstd"), []
    for x in arrays:
        if x.dtype.kind == "f":
            kind = "<f8"
        else:
            most = int(x.max()) if len(x) else 0
            kind = next(f"<u{s}" for s in (1, 2, 4, 8) if most < 1 << 8 * s)
        x = np.ascontiguousarray(x, kind)
        out.append((kind, len(x), [zstd.compress(b.tobytes(), asbytes=True) for b in x.view(np.uint8).reshape(len(x), -1).T]
                    if len(x) else []))
    return pickle.dumps(out, protocol=5)


def whole(blob: bytes) -> list[np.ndarray]:
    """The arrays again: integers as int64 (uint64 if they were too large), others as float64."""
    zstd, out = pa.Codec("zstd"), []
    for kind, n, parts in pickle.loads(blob):
        x = np.empty((n, len(parts)), np.uint8)
        for i, part in enumerate(parts):
            x[:, i] = np.frombuffer(zstd.decompress(part, n), np.uint8)
        x = x.reshape(-1).view(kind)
        out.append(x if kind in ("<f8", "<u8") else x.astype(np.int64))
    return out


def steps(x: np.ndarray) -> np.ndarray:
    """What is added, modulo 2^64, from each number to the next."""
    x = x.astype(np.uint64)
    return np.append(x[:1], x[1:] - x[:-1])


def sums(x: np.ndarray) -> np.ndarray:
    return np.cumsum(x.astype(np.uint64), dtype=np.uint64)


def block_table(docs: DataFrame, folds: int, block_bytes: int, buckets: int) -> DataFrame:
    """block, doc_ids, held, tokens: one row per block; a table of its own, bucketed by block."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", held_out(F.col("doc_id"), folds).alias("held_out"), text_of(docs).alias("text"))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, ids, held, hashes, numbers, size = TaskContext.get().partitionId() << 33, [], [], [], [], 0

        def closed() -> pa.RecordBatch:
            words, at, count = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
            order = np.argsort(-count, kind="stable")  # small numbers for frequent words
            number = np.empty(len(words), np.int64)
            number[order] = np.arange(len(words))
            blob = squeezed(steps(words[order]), number[at], np.concatenate(numbers))  # equally frequent words are in order
            one = pa.concat_arrays(ids)
            out = pa.concat_arrays(held)
            ends = pa.array([0, len(one)], pa.int32())
            return pa.RecordBatch.from_arrays(
                [pa.array([block]), pa.ListArray.from_arrays(ends, one), pa.ListArray.from_arrays(ends, out),
                 pa.array([blob], pa.binary())], names=["block", "doc_ids", "held", "tokens"])

        for b in batches:
            for lo, hi, raws in blocks(b.column(2)):
                h, n = tokens(raws)
                ids.append(b.column(0).slice(lo, hi - lo))
                held.append(b.column(1).slice(lo, hi - lo))
                hashes.append(h)
                numbers.append(n)
                size += sum(map(len, raws))
                if size >= block_bytes:
                    yield closed()
                    block, ids, held, hashes, numbers, size = block + 1, [], [], [], [], 0
        if ids:
            yield closed()

    name = f"blocks_{uuid.uuid4().hex}"
    (rows.mapInArrow(gather, f"block bigint, doc_ids array<{kind}>, held array<boolean>, tokens binary")
     .write.bucketBy(buckets, "block").option("path", scratch_path(docs.sparkSession, "blocks")).saveAsTable(name))
    return docs.sparkSession.table(name)


@dataclass
class Block:
    """Tokens of a block, the words they are numbers of, and for every token whether it is for training."""
    words: np.ndarray
    number: np.ndarray
    n: np.ndarray
    train: np.ndarray

    @classmethod
    def read(cls, blob: bytes, held: np.ndarray) -> Block:
        words, number, n = whole(blob)
        return cls(sums(words), number, n, np.repeat(~held, n))

    def vocabulary(self) -> tuple[Distinct, np.ndarray]:
        """Its words, and how often they occur in training texts."""
        words = Distinct(self.words)
        return words, words.total(np.bincount(self.number, self.train, len(self.words)).astype(np.int64))


# ---- asking and telling -----------------------------------------------------

def numbered(part: np.ndarray, place: np.ndarray, bits: int) -> np.ndarray:
    """Keys of words or frequent runs by their ranges and places there: both in the top bits, others are left to a word's number."""
    place = place.astype(np.uint64)
    top = part.astype(np.uint64) << np.uint64(64 - bits) if bits else np.zeros(len(place), np.uint64)
    keys = top | place << np.uint64(64 - bits - PLACE_BITS)
    far = np.flatnonzero(place >> np.uint64(PLACE_BITS))
    keys[far] = mix(top[far] | place[far])
    return keys


def runs_of(context: np.ndarray, word: np.ndarray, total: np.ndarray) -> tuple[Distinct, np.ndarray]:
    """The distinct runs of a block, by context and word number, and the hash by which each place's run is asked for.

    The order has the top bits of that hash (or key of a range and place) before the word's number; those that differ in
    their other bits stay apart.
    """
    pieces = total // SPREAD + 1
    turn = (word % pieces).astype(np.uint64)
    at = np.where(pieces > 1, mix(context ^ mix(turn + np.uint64(1))), context)
    low = np.uint64(int(word.max(initial=0)).bit_length())
    return Distinct(at >> low << low | word.astype(np.uint64), at), at


def ask(kind: int, block: int, keys: np.ndarray, amounts: np.ndarray, bits: int, word: np.ndarray | None = None) -> pa.RecordBatch:
    """Sorted `keys` with their amounts, a row for every range of the hash that has any; of runs, `word` follows the key.

    Amounts of odd kinds, gains, are three rows: runs seen once, occurrences (0 but from one block), gain of the other runs.
    """
    part = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
    first = np.flatnonzero(np.append(True, part[1:] != part[:-1])[:len(part)])
    told, counted = [], []
    for lo, hi in zip(first, np.append(first[1:], len(keys))):
        if word is None:
            told.append(squeezed(steps(keys[lo:hi])))
        else:
            key, follows = keys[lo:hi], word[lo:hi].astype(np.uint64)
            start = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            up = steps(follows)
            up[start] = follows[start]
            told.append(squeezed(steps(key[start]), np.diff(start, append=hi - lo), up))
        if kind % 2:
            once, total, gain = amounts[:, lo:hi]
            counted.append(squeezed((2 * once + (gain != 0)).astype(np.int64), total.astype(np.int64), gain[gain != 0]))
        else:
            counted.append(squeezed(amounts[lo:hi]))
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(first), kind, np.int32)), pa.array(part[first]), pa.array(np.full(len(first), block, np.int64)),
         pa.array(told, pa.binary()), pa.array(counted, pa.binary())], names=[c.split()[0] for c in _ASKED.split(", ")])


def asked_runs(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Of every amount, the key of its context and the number of its word."""
    key, n, up = whole(blob)
    up, start = up.astype(np.uint64), np.cumsum(n) - n
    total = np.cumsum(up, dtype=np.uint64)
    return np.repeat(sums(key), n), total - np.repeat(total[start] - up[start], n)


def asked_keys(blob: bytes) -> np.ndarray:
    """One key for every amount: of a run, its context with the word."""
    found = whole(blob)
    return sums(found[0]) if len(found) == 1 else followed(*asked_runs(blob))


def asked_gains(blob: bytes) -> np.ndarray:
    """Three rows, as for `ask`."""
    once, total, some = whole(blob)
    gain = np.zeros(len(once))
    gain[once & 1 == 1] = some
    return np.stack([once >> 1, total, gain])


def tell(asked: DataFrame, least: int, divergence: float, depth: int) -> DataFrame:
    """Of every range: to each asking block the sums of its keys, in its order.

    Even kinds are counts: twice the sum, plus one for the block that weighs the key; with words (kind 0)
    come their places by falling count, with runs the places of the frequent ones in order of context and
    word, which nobody needs of the last level. Odd kinds are gains: whether their sum is above `divergence`.
    """
    def meet(t: pa.Table) -> pa.Table:
        kind, block = t["kind"][0].as_py(), t["block"].to_numpy()
        turn = np.argsort(block, kind="stable")
        blobs, amounts = ([t[c][int(i)].as_buffer() for i in turn] for c in ("keys", "amounts"))
        runs = kind > 0 and kind % 2 == 0
        if runs:
            found = [asked_runs(x) for x in blobs]
            edges = np.cumsum([len(k) for k, _ in found])[:-1]
            context, word = (np.concatenate(x) for x in zip(*found))
            each = Distinct(followed(mix(context), word))
        else:
            found = [asked_keys(x) for x in blobs]
            edges = np.cumsum([len(k) for k in found])[:-1]
            each = Distinct(np.concatenate(found))
        facts = np.zeros((4, len(turn)), np.int64)
        if kind % 2:
            once, total, gain = (each.total(x) for x in np.concatenate([asked_gains(x) for x in amounts], axis=1))
            gain += once * (np.log(PRIOR) - np.log(np.maximum(total, 1) - 1 + PRIOR))
            told = [np.packbits(a).tobytes() for a in np.split(each.spread(gain > divergence), edges)]
        else:
            sums = each.total(np.concatenate([whole(x)[0] for x in amounts]))
            answers = each.spread(sums * 2)
            answers[each.order[each.first]] += 1
            facts[:, 0] = sums.sum(), (sums > 0).sum(), (sums == 1).sum(), (sums == 2).sum()
            answers = np.split(answers, edges)
            place = np.zeros(len(sums), np.int64)
            if kind == 0:
                place[np.argsort(-sums, kind="stable")] = np.arange(len(sums))
                told = [squeezed(*x) for x in zip(answers, np.split(each.spread(place), edges))]
            elif kind < 2 * depth:
                often = np.flatnonzero(sums >= least)
                at = each.order[each.first[often]]
                place[often[np.lexsort((word[at], context[at]))]] = np.arange(len(often))
                told = [squeezed(x, steps(p[x >> 1 >= least])) for x, p in zip(answers, np.split(each.spread(place), edges))]
            else:
                told = [squeezed(x) for x in answers]
        return pa.table({"kind": t["kind"].take(pa.array(turn)), "range": t["range"].take(pa.array(turn)),
                         "block": pa.array(block[turn]), "told": pa.array(told, pa.binary()),
                         **{c: pa.array(x) for c, x in zip(("total", "words", "once", "twice"), facts)}})

    return asked.groupBy("kind", "range").applyInArrow(meet, _TOLD)


class Answers:
    """What a block was told, by kind, in the order of its keys."""

    def __init__(self, t: pa.Table):
        self.rows: dict[int, list[tuple[int, bytes]]] = {}
        for kind, part, told in zip(t["kind"].to_pylist(), t["range"].to_pylist(), t["told"]):
            self.rows.setdefault(kind, []).append((part, told.as_buffer()))

    def counts(self, level: int, least: int, bits: int, last: bool = False) -> tuple[np.ndarray, ...]:
        """Of the keys of a level: training counts, whether this block weighs them, ranges and places there.

        Runs have a place if they are frequent (others 0), but for those of the last level.
        """
        found = [(part, *whole(x)) for part, x in sorted(self.rows.get(2 * level, []), key=lambda r: r[0])]
        if not found:
            return (np.zeros(0, np.int64), np.zeros(0, bool), *[np.zeros(0, np.int64)] * 2)
        x = np.concatenate([x for _, x, *_ in found])
        count, part = x >> 1, np.repeat([part for part, *_ in found], [len(x) for _, x, *_ in found])
        if level == 0:
            place = np.concatenate([p for *_, p in found])
        else:
            place = np.zeros(len(x), np.int64)
            if not last:
                place[count >= least] = np.concatenate([sums(p) for *_, p in found])
        return count, (x & 1).astype(bool), part, place

    def kept(self, level: int, keys: np.ndarray, bits: int) -> np.ndarray:
        part = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
        sizes = np.unique(part, return_counts=True)[1]
        rows = sorted(self.rows.get(2 * level + 1, []), key=lambda r: r[0])
        parts = [np.unpackbits(np.frombuffer(x, np.uint8), count=n) for (_, x), n in zip(rows, sizes.tolist())]
        return np.concatenate(parts).astype(bool) if parts else np.zeros(0, bool)


# ---- the tree ---------------------------------------------------------------

def gains(runs: Distinct, states: Distinct, n: np.ndarray, mine: np.ndarray,
          weighs: np.ndarray, total: np.ndarray, p: np.ndarray) -> np.ndarray:
    """A block's part of the gains of its contexts, three rows as for `ask`: `n` and `mine` are of runs, the rest of places."""
    at = runs.order[runs.first]
    own = np.flatnonzero(mine & (n > 1))
    n_own, q, t = n[own], p[at[own]], total[at[own]]
    out, each = np.zeros((3, len(states.keys))), np.zeros(len(p))
    each[at] = mine & (n == 1)
    out[0] = states.total(each)
    out[1] = states.one_of(total) * (states.total(weighs.astype(np.int64)) > 0)
    each[:] = 0
    each[at[own]] = n_own * (np.log((n_own - 1 + PRIOR * q) / (t - 1 + PRIOR)) - np.log(q))
    out[2] = states.total(each)
    return out


def visit(b: Block, told: Answers, step: int, depth: int, least: int, root: Root, bits: int) -> list | tuple:
    """What a block asks at a step, as (kind, keys, amounts, words or None); after the last, counts and probabilities of its tokens.

    Step s asks for the runs of level s (s words and a next one) and gives its part of
    the gains of the contexts of level s - 1, whose counts it knows.
    """
    asks = []
    words, _ = b.vocabulary()
    c, mine, part, spot = told.counts(0, least, bits)
    word = words.spread(spot << bits | part)[b.number]  # a number for every word, the same in all blocks, small for frequent ones
    keys = words.spread(numbered(part, spot, bits))[b.number]
    c, weighed = words.spread(c)[b.number], words.spread(mine)[b.number]
    starts = np.cumsum(b.n) - b.n
    ends = starts + b.n - 1
    place = np.arange(len(c)) - np.repeat(starts, b.n)
    p, count = root.known(c), c
    for d in range(1, min(step, depth) + 1):
        key, total, weighs = (np.append(x[:1], x[:-1]) for x in (keys, count, weighed))
        # every occurrence of a run but for the end token has a next token; a text's first has the end token before it
        key[starts], total[starts], weighs[starts] = (keys[ends], c[ends], weighed[ends]) if d == 1 else (0, 0, False)
        k = np.flatnonzero((total >= least) & (place >= d - 1))
        context, total_k = key[k], total[k]
        runs, at = runs_of(context, word[k], total_k)
        if d == step:
            asks.append((2 * d, runs.one_of(at), runs.total(b.train[k].astype(np.int64)), runs.one_of(word[k])))
            break
        n, mine, part, spot = told.counts(d, least, bits, d == depth)
        states = Distinct(context)
        if d == step - 1:
            asks.append((2 * d + 1, states.keys, gains(runs, states, n, mine, weighs[k], total_k, p[k]), None))
        n = runs.spread(n)
        if d < step - 1:
            kept = states.spread(told.kept(d, states.keys, bits))
            p[k] = np.where(kept, (n + PRIOR * p[k]) / (total_k + PRIOR), p[k])
        count, weighed, keys = np.zeros(len(c), np.int64), np.zeros(len(c), bool), np.zeros(len(c), np.uint64)
        count[k], weighed[k], keys[k] = n, runs.spread(mine), runs.spread(numbered(part, spot, bits))
    return (c, p, starts) if step == depth + 2 else asks


def _met(state: pa.Table, told: pa.Table) -> tuple[int, Block, Answers]:
    held = state["held"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(bool)
    return state["block"][0].as_py(), Block.read(state["tokens"][0].as_py(), held), Answers(told)


def answer_table(told: DataFrame, buckets: int, name: str | None = None) -> str:
    """Adds answers to a table bucketed by block, so that they meet their blocks without another shuffle; its name."""
    out = told.repartition(buckets, "block").write
    if name:
        out.insertInto(name)
        return name
    name = f"told_{uuid.uuid4().hex}"
    out.bucketBy(buckets, "block").option("path", scratch_path(told.sparkSession, "told")).saveAsTable(name)
    return name


def grow(state: DataFrame, depth: int, least: int, divergence: float, bits: int, buckets: int | None = None) -> tuple[Root, DataFrame]:
    """The root, and what every block has been told about its words, runs and contexts. `buckets`: those of `state`."""
    spark = state.sparkSession
    buckets = buckets or parts(spark)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                number, b, _ = _met(pa.Table.from_batches([batch.slice(i, 1)]), pa.table({"kind": [], "range": [], "told": []}))
                words, amounts = b.vocabulary()
                yield ask(0, number, words.keys, amounts, bits)

    name = answer_table(tell(state.mapInArrow(first, _ASKED), least, divergence, depth), buckets)
    told = spark.table(name)
    s = told.filter("kind = 0").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("total", "words", "once", "twice")]).first()
    # with no word seen once there is still something unknown to expect
    discount = s["once"] / (s["once"] + 2 * s["twice"]) if s["once"] and s["twice"] else 0.5
    root = Root(s["total"], s["words"], discount)
    for step in range(1, depth + 2):
        def asking(mine: pa.Table, answers: pa.Table, step: int = step) -> pa.Table:
            number, b, known = _met(mine, answers)
            out = [ask(kind, number, keys, amounts, bits, word)
                   for kind, keys, amounts, word in visit(b, known, step, depth, least, root, bits) if len(keys)]
            return pa.Table.from_batches(out) if out else ask(0, 0, np.zeros(0, np.uint64), np.zeros(0, np.int64), bits)

        answer_table(tell(meeting(state, told, asking, _ASKED), least, divergence, depth), buckets, name)
        told = spark.table(name)
    return root, told


def meeting(state: DataFrame, told: DataFrame, fn, schema: str) -> DataFrame:
    """`fn` on every block with what it was told; only the answers are shuffled, unless they are bucketed by block too."""
    def guarded(mine: pa.Table, answers: pa.Table) -> pa.Table:
        out = fn(mine, answers)
        return pa.table(out) if isinstance(out, pa.RecordBatch) else out

    answers = told.select("block", "kind", "range", "told")
    return state.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(guarded, schema)


def score_texts(docs: DataFrame, depth: int = DEPTH, least_context: int = LEAST_CONTEXT, divergence: float = DIVERGENCE,
                folds: int = FOLDS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: one row per document."""
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(0, math.ceil(math.log2(split_for(spark, total, BYTES_A_RANGE))))
    buckets = split_for(spark, total, BYTES_A_TASK)
    state = block_table(docs, folds, block_bytes, buckets)
    root, told = grow(state, depth, least_context, divergence, bits, buckets)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def score(mine: pa.Table, answers: pa.Table) -> pa.Table:
        _, b, known = _met(mine, answers)
        c, p, starts = visit(b, known, depth + 2, depth, least_context, root, bits)
        m, base, own = (np.add.reduceat(x, starts) for x in ((c > 0).astype(np.int64), root.base_log10(c), np.log10(p)))
        return pa.table({
            "doc_id": mine["doc_ids"].combine_chunks().flatten(), "held_out": mine["held"].combine_chunks().flatten(),
            "n_tokens": pa.array(b.n), "n_known": pa.array(m), "train_tokens": pa.array(np.full(len(b.n), root.tokens, np.int64)),
            "base_score": pa.array(base), "score": pa.array(own)})

    return meeting(state, told, score, f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, "
                                       "train_tokens bigint, base_score double, score double")
