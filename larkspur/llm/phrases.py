"""Phrase collocations: exact counts of word sequences by direct-address tiling.

Texts become blocks of numbered words. Words with `least` occurrences in a
language are ranked by frequency over the whole corpus; a rank is a symbol, and a
word of another language is another symbol. Neighbouring symbols are counted by
tiles of the rank square: pairs of two of the `dense` first ranks meet in tiles
of 256 by 256 cells, whose cell number is the address of the count (bincount);
the far larger rest of the square, nearly empty, is kept as sorted codes with
counts. Blocks' tiles are merged sixty-four at a time, codes being dealt to ever
more buckets as they merge, so no task grows with the corpus. Before that, all
pairs are counted in a table of hash cells; a pair whose cell has fewer than
`least` occurrences is not frequent and is not sent at all. The table has a fixed
size: once cells hold that many by chance (some hundred million pairs) it lets more and more pairs
pass, and what is sent then is bounded by the texts' own length.

Frequent pairs are ranked in turn and become symbols of the next level: the pair
at word i followed by the pair at word i + 1 is a phrase of three words, and so
on. Blocks learn the ranks of the pairs they hold from a broadcast of all frequent
ones where these are counted to be `told` at most, else tile by tile: so many blocks
together get a tile's ranks once and are answered one after the other, so a task holds
one tile's ranks, and these are not copied for every block. A phrase of fewer than
`least` occurrences cannot be part of a frequent one, so nothing is lost on the way.

Defined results: a null text is empty, a null language is `und`; repeated rows
count each; rows without id count like others; an empty table, or one without
frequent phrases, gives no rows; other columns are ignored.
"""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.llm.common import parts, split_for, text_of, written
from larkspur.llm.words import gather_table, mix, packed, unpacked

LEAST = 100
LONGEST = 5
TOP = 2000
SIDE = 256  # cells of a tile's side
DENSE = 16 * SIDE  # ranks whose pairs are counted in tiles
BLOCK_BYTES = 4 << 20  # of text
FAN_IN = 64
#: frequent words or pairs that are told to every task by broadcast, 16 bytes each; more go by joins
TOLD = 1_000_000
#: blocks that get the ranks of a tile together, and bytes of answers that are handed on at once
ASK_TOGETHER = 256
ANSWER_BYTES = 4 << 20
_BUCKET_BITS = 8
#: cells that occurrences of pairs are counted in before any pair is told apart; 4 MB, and a quarter of it past two words
CELL_BITS = 21, 19
_BREAK = b"\xff"  # in no UTF-8 text
_PLAIN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz " + _BREAK * 10)
_WINDOW = 1 << 20


# ---- words ------------------------------------------------------------------

class _Block:
    """Words of some texts, numbered in the order they come, and the texts as these numbers; -1 parts two pieces."""

    def __init__(self):
        self.size = 0
        self.next = itertools.count()
        self.number: dict[str, defaultdict] = {}
        self.codes: list[np.ndarray] = []

    def add(self, lang: str, text: str) -> None:
        number = self.number.get(lang)
        if number is None:
            number = self.number[lang] = defaultdict(self.next.__next__)
            number[_BREAK] = -1
        raw = text.encode().translate(_PLAIN)
        self.size += len(raw)
        at = 0
        while at < len(raw):  # a long text goes by windows that end at a blank
            end = raw.find(b" ", at + _WINDOW) if at + _WINDOW < len(raw) else -1
            end = len(raw) if end < 0 else end
            words = raw[at:end].replace(_BREAK, b" " + _BREAK + b" ").split()
            self.codes.append(np.fromiter(map(number.__getitem__, words), np.int32, len(words)))
            at = end
        self.codes.append(np.full(1, -1, np.int32))

    def row(self) -> pa.RecordBatch:
        codes = np.concatenate(self.codes)
        n = sum(len(d) - 1 for d in self.number.values())
        langs, words = [""] * n, [b""] * n
        for lang, number in self.number.items():
            for w, i in number.items():
                if i >= 0:
                    langs[i], words[i] = lang, w
        self.number.clear()
        count = np.bincount(codes[codes >= 0], minlength=n)
        return pa.RecordBatch.from_arrays([
            pa.ListArray.from_arrays([0, n], pa.array(langs, pa.string())),
            pa.ListArray.from_arrays([0, n], pa.array(words, pa.binary()).cast(pa.string())),
            pa.ListArray.from_arrays([0, n], pa.array(count.astype(np.int64))),
            pa.array([packed(codes.astype(np.int64) + 1)], pa.binary())], names=["langs", "words", "counts", "codes"])


def word_blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """langs, words, counts, codes: blocks of whole texts with their words (A-Z lower-cased)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block()
        for b in batches:
            for lang, text in zip(b.column(0), b.column(1)):
                block.add(lang.as_py(), text.as_py())
                if block.size >= block_bytes:
                    yield block.row()
                    block = _Block()
        if block.codes:
            yield block.row()

    return docs.select(F.coalesce(docs["lang"].cast("string"), F.lit("und")).alias("lang"), text_of(docs).alias("text")).mapInArrow(
        run, "langs array<string>, words array<string>, counts array<bigint>, codes binary")


def ranked(df: DataFrame, *order: Column) -> DataFrame:
    """`df`, which is read twice, with `id`: 0 for the first row in this order, and so on; written."""
    spark = df.sparkSession
    spread = written(df.repartitionByRange(parts(spark), *order).sortWithinPartitions(*order)
                     .withColumn("_part", F.spark_partition_id())
                     .withColumn("_row", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    sizes = sorted(map(tuple, spread.groupBy("_part").count().collect()))  # a row for each task
    start = itertools.accumulate([n for _, n in sizes], initial=0)
    before = F.create_map(*[x for (p, _), s in zip(sizes, start) for x in (F.lit(p), F.lit(s))]) if sizes else None
    at = F.col("_row") + before[F.col("_part")] if sizes else F.col("_row")
    return spread.withColumn("id", at.cast("bigint")).drop("_part", "_row")


# ---- tiles ------------------------------------------------------------------

_TILES = "tile bigint, block bigint, part bigint, codes binary, counts binary"
_TILES_ARROW = pa.schema([("tile", pa.int64()), ("block", pa.int64()), ("part", pa.int64()),
                          ("codes", pa.binary()), ("counts", pa.binary())])


def _bucket(code: np.ndarray, bits: int) -> np.ndarray:
    """Buckets of the sparse part of the square, below 0; more bits split each bucket of fewer bits."""
    return -1 - (mix(code.view(np.uint64)) >> np.uint64(64 - bits)).astype(np.int64)


def _slices(key: np.ndarray) -> Iterator[tuple[int, slice]]:
    edge = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    for k, (lo, hi) in enumerate(zip(edge, np.append(edge[1:], len(key)))):
        yield int(key[lo]), slice(lo, hi)


def tile_counts(left: np.ndarray, right: np.ndarray, dense: int, side: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """tile, codes and counts of all pairs: addresses within dense tiles, sorted codes in buckets of the rest."""
    across = dense // side
    near = (left < dense) & (right < dense)
    a, b = left[near], right[near]
    tile = (a // side * across + b // side).astype(np.int32)
    order = np.argsort(tile.astype(np.uint16) if across * across <= 1 << 16 else tile, kind="stable")
    tile, address = tile[order], (a % side * side + b % side)[order]
    for t, part in _slices(tile) if len(tile) else ():
        count = np.bincount(address[part], minlength=side * side)
        used = np.flatnonzero(count)
        yield t, used, count[used]
    code, count = np.unique(left[~near] << 32 | right[~near], return_counts=True)
    bucket = _bucket(code, _BUCKET_BITS)
    order = np.argsort(bucket, kind="stable")
    for t, part in _slices(bucket[order]) if len(code) else ():
        yield t, code[order[part]], count[order[part]]


def merge_tiles(batches: Iterator[pa.RecordBatch], bits: int, side: int, least: int | None) -> Iterator[pa.RecordBatch]:
    """Rows of equal tile and part, which come together, as one; sparse ones split into buckets of so many bits.

    With `least`, codes of a smaller count are left out.
    """
    def told(tile: int, part: int, codes: list[np.ndarray], counts: list[np.ndarray]) -> list[tuple]:
        if tile >= 0:
            total = np.zeros(side * side, np.int64)
            for x, n in zip(codes, counts):
                total[x] += n  # addresses of one row are distinct
            code = np.flatnonzero(total)
            out = [(tile, code, total[code])]
        else:
            code, n = np.concatenate(codes), np.concatenate(counts)
            order = np.argsort(code, kind="stable")
            code, n = code[order], n[order]
            first = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
            code, n = code[first], np.add.reduceat(n, first)
            bucket = _bucket(code, bits)
            order = np.argsort(bucket, kind="stable")
            out = [(t, code[order[s]], n[order[s]]) for t, s in _slices(bucket[order])]
        if least is not None:
            out = [(t, x[n >= least], n[n >= least]) for t, x, n in out]
        return [(t, 0, part, packed(x), packed(n)) for t, x, n in out if len(x)]

    at, codes, counts, rows = None, [], [], []
    for b in batches:
        for t, p, x, n in zip(b["tile"].to_pylist(), b["part"].to_pylist(), b["codes"], b["counts"]):
            if (t, p) != at:
                if at is not None:
                    rows += told(*at, codes, counts)
                at, codes, counts = (t, p), [], []
            codes.append(unpacked(x.as_buffer()))
            counts.append(unpacked(n.as_buffer()))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _TILES_ARROW)], schema=_TILES_ARROW)
            rows = []
    if at is not None and (rows := told(*at, codes, counts)):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _TILES_ARROW)], schema=_TILES_ARROW)


def _told(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


# ---- levels -----------------------------------------------------------------

_PLACES = "block bigint, part bigint, at binary, symbol binary"
_PLACES_ARROW = pa.schema([("block", pa.int64()), ("part", pa.int64()), ("at", pa.binary()), ("symbol", pa.binary())])


def _neighbours(at: pa.Scalar, symbol: pa.Scalar) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place, left and right symbol of every pair of neighbours."""
    at, symbol = np.cumsum(unpacked(at.as_buffer())), unpacked(symbol.as_buffer())
    i = np.flatnonzero(at[1:] == at[:-1] + 1)
    return at[i], symbol[i], symbol[i + 1]


def _places(block: int, part: int, at: np.ndarray, symbol: np.ndarray) -> tuple:
    return block, part, packed(np.diff(at, prepend=0)), packed(symbol)


def _cell(left: np.ndarray, right: np.ndarray, bits: int) -> np.ndarray:
    return (mix((left << 32 | right).view(np.uint64)) >> np.uint64(64 - bits)).astype(np.int64)


def busy_cells(places: DataFrame, least: int, bits: int) -> np.ndarray | None:
    """Whether each of 2^bits cells has `least` occurrences of pairs; None if so many cannot be told."""
    most = np.iinfo(np.uint16).max
    if least > most:
        return None

    def fill(batch: pa.RecordBatch, own: np.ndarray) -> None:
        for at, symbol in zip(batch["at"], batch["symbol"]):
            _, left, right = _neighbours(at, symbol)
            own += np.minimum(np.bincount(_cell(left, right, bits), minlength=1 << bits), most - own).astype(own.dtype)

    return gather_table(places.select("at", "symbol"), fill, 1 << bits, np.uint16, "saturate") >= least


def count_pairs(places: DataFrame, dense: int, side: int, least: int, bits: int) -> DataFrame:
    """tile, block, part, codes, counts: pairs of every block, but for those that cannot have `least` occurrences."""
    busy = places.sparkSession.sparkContext.broadcast(busy_cells(places, least, bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block, part, at, symbol in zip(*(b[c] for c in ("block", "part", "at", "symbol"))):
                _, left, right = _neighbours(at, symbol)
                if busy.value is not None:
                    may = busy.value[_cell(left, right, bits)]
                    left, right = left[may], right[may]
                rows = [(t, block.as_py(), part.as_py(), packed(x), packed(n))
                        for t, x, n in tile_counts(left, right, dense, side)]
                if rows:
                    yield _told(rows, _TILES_ARROW)

    return places.mapInArrow(run, _TILES)


def frequent_pairs(counted: DataFrame, blocks: int, least: int, dense: int, side: int) -> DataFrame:
    """tile, code, left, right, f, id: pairs with enough occurrences in the corpus, ranked by these."""
    across = dense // side
    rows, bits, left = counted, _BUCKET_BITS, blocks
    tasks = split_for(counted.sparkSession, blocks * 500.0, 4000)
    def open_codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for tile, codes, counts in zip(b["tile"].to_pylist(), b["codes"], b["counts"]):
                code, n = unpacked(codes.as_buffer()), unpacked(counts.as_buffer())
                if tile >= 0:
                    tiles = np.full(len(code), tile)
                    a, c = tile // across * side + code // side, tile % across * side + code % side
                else:
                    tiles, a, c = _bucket(code, _BUCKET_BITS), code >> 32, code & 0xFFFFFFFF
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (tiles, code, a, c, n)],
                                                 names=["tile", "code", "left", "right", "f"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return merge_tiles(batches, bits, side, None)

    def merge_last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return open_codes(merge_tiles(batches, bits, side, least))

    while True:
        left = -(-left // FAN_IN)
        rows = (rows.withColumn("part", F.floor(F.col("part") / FAN_IN).cast("bigint")).repartition(tasks, "tile", "part")
                .sortWithinPartitions("tile", "part"))
        if left == 1:
            break
        bits = min(bits + 6, 40)
        rows = written(rows.mapInArrow(merge, _TILES))
    found = written(rows.mapInArrow(merge_last, "tile bigint, code bigint, left bigint, right bigint, f bigint"))
    return ranked(found, F.desc("f"), F.col("left"), F.col("right"))


def told_places(places: DataFrame, frequent: DataFrame) -> DataFrame:
    """Blocks with the ids of their frequent pairs as symbols, at the place of the pair's first word; by broadcast."""
    t = frequent.select("left", "right", "id").toArrow()
    pair = t["left"].to_numpy() << 32 | t["right"].to_numpy()
    order = np.argsort(pair)
    told = places.sparkSession.sparkContext.broadcast((pair[order], t["id"].to_numpy()[order]))

    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, number = told.value
        for b in batches:
            for block, part, at, symbol in zip(*(b[c] for c in ("block", "part", "at", "symbol"))):
                place, left, right = _neighbours(at, symbol)
                has, i = _found(pair, left << 32 | right)
                yield _told([_places(block.as_py(), part.as_py(), place[has], number[i[has]])], _PLACES_ARROW)

    return places.mapInArrow(rename, _PLACES)


def _found(known: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of `asked` are in the sorted `known`, and where."""
    if not len(known):
        return np.zeros(len(asked), bool), np.zeros(len(asked), np.int64)
    at = np.minimum(np.searchsorted(known, asked), len(known) - 1)
    return known[at] == asked, at


_ASKED = "tile", "together", "block", "codes", "ids"
_ANSWERS = pa.schema([("of", pa.int64()), ("pairs", pa.binary()), ("ids", pa.binary())])


def answered(batches: Iterator[pa.RecordBatch], dense: int, side: int) -> Iterator[pa.RecordBatch]:
    """Frequent pairs of blocks with their ids. Rows come by tile: first, without block, its frequent codes and ids, then blocks' codes."""
    across = dense // side
    at, known, ids = None, None, None
    for b in batches:
        rows, size = [], 0
        for tile, block, codes, numbers in zip(b["tile"].to_pylist(), b["block"].to_pylist(), b["codes"], b["ids"]):
            if block is None:
                at, known, ids = tile, unpacked(codes.as_buffer()), unpacked(numbers.as_buffer())
                continue
            if tile != at:
                continue  # has no frequent pairs
            code = unpacked(codes.as_buffer())
            has, i = _found(known, code)
            code, number = code[has], ids[i[has]]
            if not len(code):
                continue
            if tile >= 0:
                code = (tile // across * side + code // side) << 32 | (tile % across * side + code % side)
            rows.append((block, packed(code), packed(number)))
            size += len(rows[-1][1]) + len(rows[-1][2])
            if size >= ANSWER_BYTES:
                yield _told(rows, _ANSWERS)
                rows, size = [], 0
        if rows:
            yield _told(rows, _ANSWERS)


def joined_places(places: DataFrame, counted: DataFrame, frequent: DataFrame, dense: int, side: int) -> DataFrame:
    """What `told_places` tells, by joins: tiles meet the ranks of their pairs, and blocks the answers of their tiles."""
    def pack(t: pa.Table) -> pa.Table:
        code, number = t["code"].to_numpy(), t["id"].to_numpy()
        order = np.argsort(code)
        return pa.table({"tile": t["tile"][:1], "codes": pa.array([packed(code[order])], pa.binary()),
                         "ids": pa.array([packed(number[order])], pa.binary())})

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return answered(batches, dense, side)

    def rename(own: pa.Table, told: pa.Table) -> pa.Table:
        rows = []
        if told.num_rows:
            pair = np.concatenate([unpacked(x.as_buffer()) for x in told["pairs"]])
            number = np.concatenate([unpacked(x.as_buffer()) for x in told["ids"]])
            order = np.argsort(pair)
            pair, number = pair[order], number[order]
            for block, part, at, symbol in zip(*(own[c] for c in ("block", "part", "at", "symbol"))):
                place, left, right = _neighbours(at, symbol)
                has, i = _found(pair, left << 32 | right)
                rows.append(_places(block.as_py(), part.as_py(), place[has], number[i[has]]))
        return pa.Table.from_batches([_told(rows, _PLACES_ARROW)] if rows else [], _PLACES_ARROW)

    blocks = places.count()
    together = -(-blocks // ASK_TOGETHER) or 1
    packs = frequent.groupBy("tile").applyInArrow(pack, "tile bigint, codes binary, ids binary").withColumn(
        "together", F.explode(F.sequence(F.lit(0), F.lit(together - 1)).cast("array<bigint>"))).withColumn("block", F.lit(None).cast("bigint"))
    asked = counted.withColumn("together", F.pmod("part", F.lit(together)).cast("bigint")).withColumn("ids", F.lit(None).cast("binary"))
    answers = (packs.select(*_ASKED).unionByName(asked.select(*_ASKED))
               .repartition(split_for(places.sparkSession, blocks * 500.0, 4000), "tile", "together")
               .sortWithinPartitions("tile", "together", F.col("block").asc_nulls_first())
               .mapInArrow(answer, "of bigint, pairs binary, ids binary"))
    return places.groupBy("block").cogroup(answers.groupBy("of")).applyInArrow(rename, _PLACES)


def _word_places(block: pa.Scalar, part: pa.Scalar, codes: pa.Scalar, number: np.ndarray) -> tuple:
    """Places of a block's frequent words; `number` has the id or -1 for break and words, in the block's own order."""
    symbol = number[unpacked(codes.as_buffer())]
    at = np.flatnonzero(symbol >= 0)
    return _places(block.as_py(), part.as_py(), at, symbol[at])


def _key(langs: pa.Array, words: pa.Array) -> pa.Array:
    """Word and language as one text; words hold no blank."""
    return pa.compute.binary_join_element_wise(words.cast(pa.large_string()), langs.cast(pa.large_string()),
                                                pa.scalar(" ", pa.large_string()))


def told_words(blocks: DataFrame, words: DataFrame) -> DataFrame:
    """The first level: blocks with the ids of their frequent words; by broadcast of one flat array."""
    t = words.select("lang", "word", "id").toArrow()
    told = blocks.sparkSession.sparkContext.broadcast(
        (_key(t["lang"].combine_chunks(), t["word"].combine_chunks()), t["id"].to_numpy()))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, ids = told.value
            for block, part, langs, words, codes in zip(*(b[c] for c in ("block", "part", "langs", "words", "codes"))):
                at = pa.compute.index_in(keys, _key(langs.values, words.values))  # a block's words are distinct
                at = at.fill_null(-1).to_numpy(zero_copy_only=False)
                number = np.full(len(words) + 1, -1, np.int64)
                number[at[at >= 0] + 1] = ids[at >= 0]
                yield _told([_word_places(block, part, codes, number)], _PLACES_ARROW)

    return blocks.select("block", "part", "langs", "words", "codes").mapInArrow(place, _PLACES)


def joined_words(blocks: DataFrame, words: DataFrame) -> DataFrame:
    """What `told_words` tells, by joins."""
    def place(own: pa.Table, told: pa.Table) -> pa.Table:
        rows = []
        for block, part, codes in zip(*(own[c] for c in ("block", "part", "codes"))):
            number = np.full(int(unpacked(codes.as_buffer()).max(initial=0)) + 1, -1, np.int64)
            number[told["at"].to_numpy() + 1] = told["id"].to_numpy()
            rows.append(_word_places(block, part, codes, number))
        return pa.Table.from_batches([_told(rows, _PLACES_ARROW)] if rows else [], _PLACES_ARROW)

    known = _block_words(blocks).join(words.select("lang", "word", "id"), ["lang", "word"]).select("of", "at", "id")
    return blocks.select("block", "part", "codes").groupBy("block").cogroup(known.groupBy("of")).applyInArrow(place, _PLACES)


def _block_words(blocks: DataFrame) -> DataFrame:
    return blocks.select(F.col("block").alias("of"), F.posexplode(F.arrays_zip("langs", "words", "counts")).alias("at", "x")).select(
        "of", "at", F.col("x.langs").alias("lang"), F.col("x.words").alias("word"), F.col("x.counts").alias("n"))


def phrase_counts(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, dense: int = DENSE, side: int = SIDE,
                  block_bytes: int = BLOCK_BYTES, told: int = TOLD) -> tuple[list[DataFrame], DataFrame]:
    """Frequent phrases of 1, 2, ... words, each as written table, and the number of words (`n`) of each language.

    Columns: id, lang, phrase, last (its last word), f, starts and ends (the
    occurrences of its first and last 1, 2, ... words), left and right (ids of its
    first and last words but one, among the phrases one word shorter).
    """
    blocks = written(word_blocks(docs, block_bytes).withColumn("block", F.monotonically_increasing_id()))
    n_blocks = max(1, blocks.count())
    blocks = blocks.withColumn("part", F.pmod(F.xxhash64("block"), F.lit(n_blocks)))
    words = written(_block_words(blocks).groupBy("lang", "word").agg(F.sum("n").alias("f")))
    sizes = words.groupBy("lang").agg(F.sum("f").alias("n"))
    known = ranked(words.filter(F.col("f") >= least), F.desc("f"), F.col("lang"), F.col("word"))
    levels = [known.select("id", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "f", F.array("f").alias("starts"),
                           F.array("f").alias("ends"), F.lit(None).cast("bigint").alias("left"), F.lit(None).cast("bigint").alias("right"))]
    size = known.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("word")), F.lit(0)).alias("bytes")).first()
    small = size["n"] <= told and size["bytes"] <= 16 * told
    places = written(told_words(blocks, known) if small else joined_words(blocks, known))
    for length in range(2, longest + 1):
        counted = count_pairs(places, dense, side, least, CELL_BITS[length > 2])
        frequent = frequent_pairs(counted, n_blocks, least, dense, side)
        before = levels[-1]
        first = before.select(F.col("id").alias("left"), "lang", F.col("phrase").alias("p"), F.col("starts").alias("s"))
        rest = before.select(F.col("id").alias("right"), "last", F.col("ends").alias("e"))
        levels.append(written(frequent.select("id", "left", "right", "f").join(first, "left").join(rest, "right").select(
            "id", "lang", F.concat_ws(" ", "p", "last").alias("phrase"), "last", "f", F.concat("s", F.array("f")).alias("starts"),
            F.concat("e", F.array("f")).alias("ends"), "left", "right")))
        if length < longest:
            places = written(told_places(places, frequent) if frequent.count() <= told
                             else joined_places(places, counted, frequent, dense, side))
    return levels, sizes


# ---- scores -----------------------------------------------------------------

def _cuts(length: int) -> Column:
    """Score and parts of a phrase for every place to cut it, exact beyond 64 bits."""
    each = []
    for k in range(1, length):
        left, right = F.col("starts")[k - 1], F.col("ends")[length - k - 1]
        above = (F.col("f") * 1000).cast("decimal(19,0)") * F.col("n").cast("decimal(18,0)")
        below = left.cast("decimal(19,0)") * right.cast("decimal(18,0)")
        each.append(F.struct(F.call_function("div", above, below).alias("score"), F.lit(k).alias("k"), left.alias("l"), right.alias("r")))
    return F.array(*each)


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, dense: int = DENSE,
                 side: int = SIDE, block_bytes: int = BLOCK_BYTES, told: int = TOLD) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first `top` phrases of 2 to `longest` words.

    A phrase that occurs a times is cut where floor(1000 * a * n / (l * r)) is
    least, earliest at ties. It is left out if a frequent phrase that holds it
    occurs as often; that is so if one of one word more does.
    """
    levels, sizes = phrase_counts(docs, least, longest, dense, side, block_bytes, told)
    scored = []
    for length in range(2, longest + 1):
        rows = levels[length - 1]
        if length < longest:
            longer = levels[length]
            held = longer.select(F.col("left").alias("id"), "f").unionByName(longer.select(F.col("right").alias("id"), "f"))
            rows = rows.join(held.groupBy("id").agg(F.max("f").alias("longer")), "id", "left").filter(
                F.coalesce(F.col("longer"), F.lit(0)) * 100 < F.col("f") * 100)
        best = F.array_min(_cuts(length))
        scored.append(rows.join(sizes, "lang").withColumn("x", best).select(
            "lang", "phrase", F.col("f").alias("a"), "x.l", "x.r", "n", "x.score"))
    every = scored[0]
    for x in scored[1:]:
        every = every.unionByName(x)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return every.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("bigint"), "phrase", "a", "l", "r", "n", "score")
