"""Line dedup by an exact set-similarity join.

A line is the set of its words (A-Z lower-cased). A line goes if an earlier one,
by (doc_id, line number), has a Jaccard coefficient of `bar` or more with it.

Words are ordered by rarity, from counts over all documents: a table of fixed
size holds a rarity class for every word hash, and (class, hash) is one order of
all words, which is all that prefix filtering needs to be exact. Lines whose
similarity reaches the bar share a word of their prefixes, so each line's record
goes to the lists of its prefix words. In a list, records sorted by set size are
compared as far as the length filter allows; the positional filter and a parity
sketch (its differing bits never outnumber the differing words) discard most
pairs. Pairs that are left are verified on their words.

Equal lines are known by 128-bit digests. They are reduced to the earliest in every task and then in buckets of digests, so
a line in a third of all documents comes as one record a task. Of a line's other
possible partners the `first` likest by their sketches in a list are verified,
for one match is enough; where not even the likest is a sure one, the WIDE likest
are. Lines for which that decides nothing, though they have more, are joined
again in the lists of their own words only, with finer sketches, all partners
verified. So no list of pairs of a group of like lines is made.

Defined results: a null text counts as empty; a line without words stays; lines
of documents without id stay and match nothing; rows that share an id are
documents of their own, in the order of a hash of their texts; lines of one
document count too, the first stays; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
import math
import pickle
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import LOWER_AZ, WORD, Memo, attach_weighted, split_for, text_of, written
from larkspur.llm.phrases import ranked
from larkspur.llm.words import bit_at, blocks, gather_table, lookup_bits, may_be_in, mix, set_bits, word_hashes
from larkspur.plans.shared import scratch_path

BAR = 0.8
RARITY_BITS = 21  # 2 MB
FIRST = 4
WIDE = 64
#: lines that are out, up to which they are told to every task by broadcast (some 20 bytes each); more go by a join
TOLD = 1_000_000
BYTES_A_BUCKET = 16 << 20  # of text
LINES_A_BUCKET = 100_000  # of the table of lines whose pairs are verified
_EPS = 1e-9


def rarity_classes(docs: DataFrame, bits: int = RARITY_BITS) -> tuple[np.ndarray, int]:
    """For every value of a word hash's first `bits` bits, the logarithm of its count in all texts; and all texts' bytes."""
    def fill(batch: pa.RecordBatch, own: np.ndarray) -> None:
        for _, _, raws in blocks(batch.column(0)):
            h = word_hashes(b"\n".join(raws))[0]
            np.add.at(own, (h >> np.uint64(64 - bits)).astype(np.int64), 1)
            own[-1] += sum(map(len, raws))

    count = gather_table(docs.select("text"), fill, (1 << bits) + 1, np.int64, "sum")
    return np.minimum(255, 8 * np.log2(count[:-1] + 1.0)).astype(np.uint8), int(count[-1])


def probe_length(size: np.ndarray, bar: float) -> np.ndarray:
    """Words of a set, rarest first, of which one is in any set that reaches the bar with it."""
    return size - np.ceil(size * bar - _EPS).astype(np.int64) + 1


#: times the size of sketches in the round over what is left open, where records are few
FINE = 8


def sketch_words(size: np.ndarray, fine: int = 1) -> np.ndarray:
    """64-bit words of a set's parity sketch, a power of two: enough for unlike sets to differ in more bits than like ones may."""
    return np.int64(1) << np.ceil(np.log2(np.clip(size * fine / 96, 1, 64))).astype(np.int64)


def folded(sketch: np.ndarray, at: np.ndarray, k: int, to: int) -> np.ndarray:
    """Sketches of k words, at those places, as sketches of `to` words: places modulo a smaller power of two."""
    return np.bitwise_xor.reduce(sketch[at[:, None] + np.arange(k)].reshape(len(at), k // to, to), axis=1)


def differing_bits(sketch: np.ndarray, at: np.ndarray, k: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """In how many bits the sketches of i and j differ, in the smaller of their lengths."""
    out = np.zeros(len(i), np.int64)
    both = k[i] * 128 + k[j]
    for c in np.unique(both):
        rows, a, b = np.flatnonzero(both == c), int(c) // 128, int(c) % 128
        for part in np.array_split(rows, -(-len(rows) * max(a, b) // 1_000_000)):
            out[part] = np.bitwise_count(folded(sketch, at[i[part]], a, min(a, b))
                                         ^ folded(sketch, at[j[part]], b, min(a, b))).sum(axis=1, dtype=np.int64)
    return out


class Lines:
    """Word sets of the lines of a block of texts, in order of rarity; lines without words are left out.

    With `wanted`, a bit table of words, lines that surely hold none of these are left out too.
    """

    def __init__(self, raws: list[bytes], rarity: np.ndarray, fine: int = 1, wanted: np.ndarray | None = None):
        bits = int(len(rarity)).bit_length() - 1
        h, _, line = word_hashes(b"\n".join(raws))
        word = (rarity[(h >> np.uint64(64 - bits)).astype(np.int64)].astype(np.uint64) << np.uint64(56)) | (h >> np.uint64(8))
        if wanted is not None and len(line):
            holds = np.zeros(line[-1] + 1, bool)
            holds[line[bit_at(wanted, (mix(word) >> np.uint64(64 - _bits(wanted))).astype(np.int64))]] = True
            word, line = word[holds[line]], line[holds[line]]
        order = np.argsort(word)  # equal words are alike, so only the second sort has to be stable
        order = order[np.argsort(small_int(line)[order], kind="stable")]
        word, line = word[order], line[order]
        new = np.append(True, (word[1:] != word[:-1]) | (line[1:] != line[:-1]))[:len(word)]
        word, line = word[new], line[new]
        self.word = word
        self.start = np.flatnonzero(np.append(True, line[1:] != line[:-1]))[:len(word)]
        self.size = np.diff(np.append(self.start, len(word)))
        line = self.number = line[self.start]  # in the block
        count = np.array([r.count(b"\n") + 1 for r in raws])
        first = np.cumsum(count) - count
        self.doc = np.searchsorted(first, line, "right") - 1  # number of the text
        self.line = line - first[self.doc]
        low = mix(word)
        k = sketch_words(self.size, fine)
        self.sketch_at = np.cumsum(k) - k
        self.sketch = np.zeros(int(k.sum()), np.uint64)
        place = (low >> np.uint64(52)).astype(np.int64) & np.repeat(64 * k - 1, self.size)
        np.bitwise_xor.at(self.sketch, np.repeat(self.sketch_at, self.size) + (place >> 6),
                          np.uint64(1) << (place & 63).astype(np.uint64))


def digests(raws: list[bytes], number: np.ndarray) -> np.ndarray:
    """Two 64-bit numbers for every line of that `number` in the block: a digest of the line."""
    lines = b"\n".join(raws).split(b"\n")
    found = [hashlib.blake2b(lines[k], digest_size=16).digest() for k in number.tolist()]
    return np.frombuffer(b"".join(found), "<u8").reshape(-1, 2)


def small_int(x: np.ndarray) -> np.ndarray:
    """`x` in 16 bits if it fits, which numpy sorts by radix."""
    return x.astype(np.uint16) if not len(x) or x.max() < 1 << 16 else x


def narrow(x: np.ndarray) -> tuple[int, np.ndarray]:
    """Least value, and the rest above it in as few bytes as do."""
    low = int(x.min()) if len(x) else 0
    x = (x - low).astype(np.uint64)
    kind = next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if not len(x) or x.max() <= np.iinfo(k).max)
    return low, x.astype(kind)


def wide(x: tuple[int, np.ndarray]) -> np.ndarray:
    return x[1].astype(np.int64) + x[0]


_RECORDS = "bucket int, blob binary"
_FOUND = "doc bigint, line bigint, by_doc bigint, by_line bigint, more boolean"
_FOUND_ARROW = pa.schema([(c, pa.int64()) for c in ("doc", "line", "by_doc", "by_line")] + [("more", pa.bool_())])


def records(batches: Iterator[pa.RecordBatch], rarity: np.ndarray, buckets: int, bar: float,
            focus: tuple[np.ndarray, np.ndarray] | None = None) -> Iterator[pa.RecordBatch]:
    """Blobs of records by bucket, and of digests by bucket, below 0. Of equal lines in a batch the earliest is recorded,
    the others are out and told with the digests.

    With a `focus` (bit tables of words and of lines) only records of those
    words are made, and those lines are marked; there are no digests then.
    """
    fine = 1 if focus is None else FINE
    for b in batches:
        ids = b.column(0).to_numpy()
        kept: dict[str, list[np.ndarray]] = {k: [] for k in ("doc", "line", "size", "sketch", "at", "words", "n", "digest")}
        sketched = 0
        for lo, hi, raws in blocks(b.column(1)):
            x = Lines(raws, rarity, fine, None if focus is None else focus[0])
            n = probe_length(x.size, bar)
            at = np.repeat(x.start - np.append(0, np.cumsum(n)[:-1])[:len(n)], n) + np.arange(n.sum())
            for k, v in (("doc", ids[lo:hi][x.doc]), ("line", x.line), ("size", x.size), ("sketch", x.sketch),
                         ("at", x.sketch_at + sketched), ("words", x.word[at]), ("n", n), ("digest", digests(raws, x.number))):
                kept[k].append(v)
            sketched += len(x.sketch)
        if not kept["doc"]:
            continue
        doc, line, size, sketch, sketch_at, words, n, digest = (np.concatenate(kept[k]) for k in kept)
        k_of = sketch_words(size, fine)
        out = repeats(digest, doc, line)
        whole = digest[:, 0]
        row = np.repeat(np.arange(len(n)), n)
        pos = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        stays = ~out[row]
        row, pos, word = row[stays], pos[stays], mix(words[stays])
        asks = np.ones(len(doc), bool)
        if focus is not None:
            stays = bit_at(focus[0], (word >> np.uint64(64 - _bits(focus[0]))).astype(np.int64))
            row, pos, word = row[stays], pos[stays], word[stays]
            asks = bit_at(focus[1], _places(doc, line, _bits(focus[1])))
        bucket = (word >> np.uint64(32)) % np.uint64(buckets)
        order = np.argsort(small_int(bucket.astype(np.int64)), kind="stable")
        row, pos, word, bucket = row[order], pos[order], word[order].astype(np.uint32), bucket[order].astype(np.int64)
        edges = np.searchsorted(bucket, np.arange(buckets + 1))
        names, blobs = [], []
        for k in range(buckets):
            part = slice(edges[k], edges[k + 1])
            r = row[part]
            if len(r):
                names.append(k)
                blobs.append(pickle.dumps((
                    word[part], narrow(doc[r]), narrow(line[r]), narrow(size[r]), narrow(pos[part]),
                    sketch[np.repeat(sketch_at[r] - np.cumsum(k_of[r]) + k_of[r], k_of[r]) + np.arange(k_of[r].sum())],
                    whole[r], asks[r]), protocol=5))
        if focus is None:
            of = (whole % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(of, kind="stable")
            edges = np.searchsorted(of[order], np.arange(buckets + 1))
            for k in range(buckets):
                r = order[edges[k]:edges[k + 1]]
                if len(r):
                    names.append(-1 - k)
                    own, gone = r[~out[r]], r[out[r]]
                    blobs.append(pickle.dumps((digest[own], narrow(doc[own]), narrow(line[own]),
                                               narrow(doc[gone]), narrow(line[gone])), protocol=5))
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array(blobs, pa.binary())], names=["bucket", "blob"])


def repeats(digest: np.ndarray, doc: np.ndarray, line: np.ndarray) -> np.ndarray:
    """Which lines have an earlier one of the same digest."""
    order = np.lexsort((line, doc, digest[:, 1], digest[:, 0]))
    same = np.append(False, (digest[order][1:] == digest[order][:-1]).all(axis=1))[:len(order)]
    out = np.zeros(len(doc), bool)
    out[order[same]] = True
    return out


def equal_lines(blobs: list[bytes]) -> dict[str, np.ndarray]:
    """Lines that are out because an earlier one has the same digest, from the digests of one bucket."""
    parts = [pickle.loads(x) for x in blobs]
    digest = np.concatenate([p[0] for p in parts])
    doc, line, gone_doc, gone_line = (np.concatenate([wide(p[i]) for p in parts]) for i in (1, 2, 3, 4))
    out = repeats(digest, doc, line)
    none = np.zeros(0, np.int64)
    doc, line = np.append(gone_doc, doc[out]), np.append(gone_line, line[out])
    return {"doc": doc, "line": line, "by_doc": none, "by_line": none, "more": np.zeros(len(doc), bool)}


def _likest(later: np.ndarray, earlier: np.ndarray, bits: np.ndarray, sure: np.ndarray, rank: np.ndarray, first: int,
            more: np.ndarray):
    """Of each later record the `first` partners that differ in the fewest bits, or the WIDE first if the very first is
    no `sure` match; marks in `more` those that have others."""
    order = np.lexsort((rank[earlier], bits, later))
    later, earlier, bits, sure = later[order], earlier[order], bits[order], sure[order]
    head = np.searchsorted(later, later)
    turn = np.arange(len(later)) - head
    stays = turn < np.where(sure[head], first, max(first, WIDE))
    more[later[~stays]] = True
    return later[stays], earlier[stays], bits[stays], sure[stays]


def compare_lists(blobs: list[bytes], bar: float, first: int | None, focused: bool = False) -> dict[str, np.ndarray]:
    """Pairs to verify, from the records of one bucket; all pairs without `first`."""
    parts = [pickle.loads(x) for x in blobs]
    word, sketch, whole = (np.concatenate([p[i] for p in parts]) for i in (0, 5, 6))
    doc, line, size, pos = (np.concatenate([wide(p[i]) for p in parts]) for i in (1, 2, 3, 4))
    asks = np.concatenate([p[7] for p in parts])
    k_of = sketch_words(size, FINE if focused else 1)
    sketch_at = np.cumsum(k_of) - k_of
    parity = np.bitwise_xor.reduceat(sketch, sketch_at) if len(word) else sketch

    order = np.lexsort((line, doc, whole, word.astype(np.uint64) << np.uint64(32) | size.astype(np.uint64)))
    word, doc, line, size, pos, parity, whole, k_of, sketch_at, asks = (
        x[order] for x in (word, doc, line, size, pos, parity, whole, k_of, sketch_at, asks))
    same = np.append(False, (word[1:] == word[:-1]) & (size[1:] == size[:-1]) & (whole[1:] == whole[:-1]))[:len(word)]
    word, doc, line, size, pos, parity, k_of, sketch_at, asks = (
        x[~same] for x in (word, doc, line, size, pos, parity, k_of, sketch_at, asks))

    n = len(word)
    rank = np.empty(n, np.int64)
    rank[np.lexsort((line, doc))] = np.arange(n)
    rank_of_line = np.append(0, np.cumsum((np.diff(doc[np.argsort(rank)]) != 0) | (np.diff(line[np.argsort(rank)]) != 0)))[:n]
    rank = rank_of_line[rank] if n else rank
    more = np.zeros(n, bool)
    later, earlier, bits, sure, held = [], [], [], [], 0
    i = np.arange(n)
    for step in range(1, n):
        i = i[i + step < n]
        j = i + step
        goes_on = (word[i] == word[j]) & (size[i] >= size[j] * bar - _EPS)
        i, j = i[goes_on], j[goes_on]
        if not len(i):
            break
        need = np.ceil((size[i] + size[j]) * bar / (1 + bar) - _EPS).astype(np.int64)
        reach = np.minimum(pos[i], pos[j]) + 1 + np.minimum(size[i] - pos[i], size[j] - pos[j]) - 1
        most = size[i] + size[j] - 2 * need  # words that one has and the other has not
        may = (reach >= need) & (np.bitwise_count(parity[i] ^ parity[j]) <= most) & (rank[i] != rank[j])
        a, b, most = i[may], j[may], most[may]
        swap = rank[a] > rank[b]
        a, b = np.where(swap, a, b), np.where(swap, b, a)  # later, earlier
        wanted = asks[a]
        a, b, most = a[wanted], b[wanted], most[wanted]
        differ = np.bitwise_count(parity[a] ^ parity[b]).astype(np.int64)
        fine = np.flatnonzero(np.minimum(k_of[a], k_of[b]) > 1)
        if len(fine):
            differ[fine] = differing_bits(sketch, sketch_at, k_of, a[fine], b[fine])
            near = differ <= most
            a, b, differ, most = a[near], b[near], differ[near], most[near]
        later.append(a)
        earlier.append(b)
        bits.append(differ)
        sure.append(2 * differ <= most)
        held += len(a)
        if held > 2_000_000 and first is not None:
            later, earlier, bits, sure = ([x] for x in _likest(*map(np.concatenate, (later, earlier, bits, sure)), rank, first, more))
            held = len(later[0])
    x, y = (np.concatenate(c) if c else np.zeros(0, np.int64) for c in (later, earlier))
    if first is not None and len(x):
        x, y, _, _ = _likest(x, y, np.concatenate(bits), np.concatenate(sure), rank, first, more)
    elif len(x):  # a pair may have met in several lists
        x, y = np.divmod(np.unique(x * n + y), n)
    return {"doc": doc[x], "line": line[x], "by_doc": doc[y], "by_line": line[y], "more": more[x]}


def candidates(docs: DataFrame, rarity, buckets: int, bar: float, first: int | None, focus=None) -> DataFrame:
    """doc, line, by_doc, by_line, more: lines that are out (by_doc null) and pairs to verify."""
    def run(batches):
        return records(batches, rarity.value, buckets, bar, None if focus is None else focus.value)

    def compare(t: pa.Table) -> pa.Table:
        blobs = [x.as_buffer() for x in t["blob"]]
        got = equal_lines(blobs) if t["bucket"][0].as_py() < 0 else compare_lists(blobs, bar, first, focus is not None)
        decided = len(got["doc"]) - len(got["by_doc"])
        fill = lambda x: pa.concat_arrays([pa.nulls(decided, pa.int64()), pa.array(x, pa.int64())])
        return pa.Table.from_arrays([pa.array(got["doc"]), pa.array(got["line"]), fill(got["by_doc"]), fill(got["by_line"]),
                                     pa.array(got["more"])], schema=_FOUND_ARROW)

    return docs.mapInArrow(run, _RECORDS).groupBy("bucket").applyInArrow(compare, _FOUND)


def _places(doc: np.ndarray, line: np.ndarray, bits: int) -> np.ndarray:
    x = mix(mix(doc.astype(np.int64).view(np.uint64)) + line.astype(np.uint64))
    return (x >> np.uint64(64 - bits)).astype(np.int64)


def _bits(table: np.ndarray) -> int:
    return (8 * len(table)).bit_length() - 1


def lines_at(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """doc, line, words (once each, A-Z lower-cased, space-joined) of all rows of `wanted` (doc, line), and of some others.

    A bit table says which lines may be wanted; a fuller one only lets more lines
    pass, which the join that follows drops.
    """
    bits = lookup_bits(wanted.count())

    def fill(batch: pa.RecordBatch, own: np.ndarray) -> None:
        set_bits(own, _places(batch.column(0).to_numpy(), batch.column(1).to_numpy(), bits))

    table = docs.sparkSession.sparkContext.broadcast(gather_table(wanted, fill, 1 << (bits - 3), np.uint8, "or"))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            docs_, lines_, texts = [], [], []
            count = pa.compute.count_substring(b.column(1), "\n").to_numpy(zero_copy_only=False) + 1
            row = np.repeat(np.arange(b.num_rows), count)
            number = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            ids = b.column(0).to_numpy()
            has = bit_at(table.value, _places(ids[row], number, bits))
            row, number = row[has], number[has]
            edges = np.flatnonzero(np.append(True, row[1:] != row[:-1])) if len(row) else []
            for lo, hi in zip(edges, [*edges[1:], len(row)]):
                lines = b.column(1)[row[lo]].as_py().split("\n")
                docs_ += [ids[row[lo]]] * (hi - lo)
                lines_ += number[lo:hi].tolist()
                texts += [b" ".join(dict.fromkeys(lines[k].encode().translate(LOWER_AZ).split())).decode() for k in number[lo:hi]]
            yield pa.RecordBatch.from_arrays([pa.array(docs_, pa.int64()), pa.array(lines_, pa.int64()),
                                              pa.array(texts, pa.string())], names=["doc", "line", "words"])

    return docs.mapInArrow(pick, "doc bigint, line bigint, words string")


def verified(known: DataFrame, pairs: DataFrame, bar: float) -> tuple[DataFrame, DataFrame]:
    """Of a written table of pairs: doc, line, match, more for every later line; and doc, line, words of all lines in it.

    A line's words are one string, which takes less room than a list, in a table
    that is bucketed by line: joins shuffle the pairs only, not this table again.
    """
    spark = pairs.sparkSession
    sides = pairs.select("doc", "line").unionByName(pairs.select(F.col("by_doc").alias("doc"), F.col("by_line").alias("line")))
    wanted = written(sides.groupBy("doc", "line").agg(F.count(F.lit(1)).alias("n")))
    buckets = split_for(spark, wanted.count(), LINES_A_BUCKET)
    name = f"lines_{uuid.uuid4().hex}"
    (lines_at(known, wanted.select("doc", "line")).repartition(buckets, "doc", "line").join(wanted, ["doc", "line"])
     .write.bucketBy(buckets, "doc", "line").option("path", scratch_path(spark, "lines")).saveAsTable(name))
    texts = spark.table(name)
    left = written(attach_weighted(pairs, texts, ["doc", "line"], "n").select(
        "doc", "line", "more", "by_doc", "by_line", F.col("words").alias("a")))
    both = attach_weighted(left, texts.select(F.col("doc").alias("by_doc"), F.col("line").alias("by_line"), "n", "words"),
                           ["by_doc", "by_line"], "n").select("doc", "line", "more", "a", "words")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Memo(lambda t: frozenset(t.split()), 64)
        for b in batches:
            match = []
            for a, c in zip(*(b.column(k).cast(pa.binary()).to_pylist() for k in (3, 4))):
                a, c = words[a], words[c]
                shared = len(a & c)
                match.append(shared / (len(a) + len(c) - shared) >= bar - _EPS)
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(match, pa.bool_())], names=["doc", "line", "more", "match"])

    judged = written(both.mapInArrow(judge, "doc bigint, line bigint, more boolean, match boolean").groupBy("doc", "line").agg(
        F.max("match").alias("match"), F.max("more").alias("more")))
    return judged, texts


def focus_on(open_lines: DataFrame, rarity, bar: float) -> tuple[np.ndarray, np.ndarray]:
    """Bit tables of the prefix words of `open_lines` (doc, line, words) and of the lines themselves."""
    number = open_lines.agg(F.count(F.lit(1)).alias("lines"), F.coalesce(F.sum(F.regexp_count("words", F.lit(WORD))), F.lit(0)).alias("words")).first()
    of_words, of_lines = lookup_bits(number["words"]), lookup_bits(number["lines"])

    def fill_words(batch: pa.RecordBatch, own: np.ndarray) -> None:
        x = Lines(batch.column(0).cast(pa.binary()).to_pylist(), rarity.value)
        n = probe_length(x.size, bar)
        at = np.repeat(x.start - np.append(0, np.cumsum(n)[:-1])[:len(n)], n) + np.arange(n.sum())
        set_bits(own, (mix(x.word[at]) >> np.uint64(64 - of_words)).astype(np.int64))

    def fill_lines(batch: pa.RecordBatch, own: np.ndarray) -> None:
        set_bits(own, _places(batch.column(0).to_numpy(), batch.column(1).to_numpy(), of_lines))

    return (gather_table(open_lines.select("words"), fill_words, 1 << (of_words - 3), np.uint8, "or"),
            gather_table(open_lines.select("doc", "line"), fill_lines, 1 << (of_lines - 3), np.uint8, "or"))


def numbered(docs: DataFrame) -> DataFrame:
    """row (a struct of all columns) and doc, which tells rows apart and has the order of doc_id; null without id.

    It is doc_id itself where no two rows share one, else rows are numbered in the order of doc_id and a hash of the text.
    """
    whole = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    ids = docs["doc_id"].cast("bigint")
    shared = docs.filter(ids.isNotNull()).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    if shared.isEmpty():
        return docs.select(whole, ids.alias("doc"))
    order = written(docs.filter(ids.isNotNull()).select(whole, ids.alias("first"), F.xxhash64(text_of(docs)).alias("then")))
    return ranked(order, F.col("first"), F.col("then")).select("row", F.col("id").alias("doc")).unionByName(
        docs.filter(ids.isNull()).select(whole, F.lit(None).cast("bigint").alias("doc")))


def later_matches(rows: DataFrame, bar: float = BAR, first: int = FIRST) -> DataFrame:
    """doc, line: every line that has an earlier match. `rows` is `numbered`."""
    spark = rows.sparkSession
    known = rows.filter("doc IS NOT NULL").select("doc", F.coalesce("row.text", F.lit("")).alias("text"))
    classes, total = rarity_classes(known)
    rarity = spark.sparkContext.broadcast(classes)
    buckets = split_for(spark, total, BYTES_A_BUCKET)
    found = written(candidates(known, rarity, buckets, bar, first))
    out = found.filter("by_doc IS NULL").select("doc", "line")
    named = ["doc", "line", "by_doc", "by_line"]
    pairs = written(found.filter("by_doc IS NOT NULL").groupBy(*named).agg(F.max("more").alias("more"))
                    .join(out.distinct(), ["doc", "line"], "left_anti"))
    judged, texts = verified(known, pairs, bar)
    out = out.unionByName(judged.filter("match").select("doc", "line"))
    still = judged.filter("more AND NOT match").select("doc", "line")
    undecided = written(texts.filter(may_be_in(still, ["doc", "line"])).join(still, ["doc", "line"], "left_semi"))
    if not undecided.isEmpty():  # few: all their partners that finer sketches leave
        focus = spark.sparkContext.broadcast(focus_on(undecided, rarity, bar))
        rest = written(candidates(known, rarity, buckets, bar, None, focus).select(*named).distinct()
                       .join(undecided.select("doc", "line"), ["doc", "line"], "left_semi").withColumn("more", F.lit(False)))
        out = out.unionByName(verified(known, rest, bar)[0].filter("match").select("doc", "line"))
    return out.distinct()


def drop_lines(rows: DataFrame, removed: DataFrame) -> DataFrame:
    """All columns of the rows with those lines taken out of text, and n_lines and n_removed (in place of any of that name)."""
    by_doc = written(removed.groupBy("doc").agg(F.collect_list("line").alias("out")))  # at most a document's own lines
    if (by_doc.agg(F.sum(F.size("out"))).first()[0] or 0) <= TOLD:
        by_doc = F.broadcast(by_doc)
    names = rows.schema["row"].dataType.names
    joined = rows.join(by_doc, "doc", "left").select("row", "out")
    kinds = joined.schema["row"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, out = b.column(0).field(names.index("text")), b.column(1)
            n = pa.compute.add(pa.compute.count_substring(texts.fill_null(""), "\n"), 1).cast(pa.int64())
            gone, kept = np.zeros(b.num_rows, np.int64), [None] * b.num_rows
            for row in np.flatnonzero(out.is_valid().to_numpy(zero_copy_only=False)):
                drop = set(out[row].as_py())
                lines = texts[row].as_py().split("\n")
                kept[row] = "\n".join(x for k, x in enumerate(lines) if k not in drop)
                gone[row] = len(drop)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(kept, pa.string()), n, pa.array(gone)],
                                             names=["row", "kept", "n_lines", "n_removed"])

    out = joined.mapInArrow(cut, f"row {kinds}, kept string, n_lines bigint, n_removed bigint")
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("row.text"))
    return out.select(*[text.alias(c) if c == "text" else F.col("row")[c].alias(c) for c in names if c not in ("n_lines", "n_removed")], "n_lines", "n_removed")


def dedup_lines(docs: DataFrame, bar: float = BAR, first: int = FIRST) -> DataFrame:
    """All columns of docs, without the lines that match an earlier one, plus n_lines and n_removed."""
    rows = numbered(docs)
    return drop_lines(rows, later_matches(rows, bar, first))
