"""Language ID from bit-sliced Bloom filters of byte n-grams.

One table of positions holds, in each entry, a bit for every language: the k
entries of an n-gram, ANDed, are all languages whose filter contains it, in one
probe. Languages beyond 64 go into further slices. A document's n-grams give a
popcount per language; a language whose filter is full to the share p answers
yes by chance with p^k, so its count o of n is corrected to (o - p^k n)/(1 - p^k).
The largest corrected count decides.

Learning takes at most about `per_language` labelled documents of each language,
chosen by a hash of the row; their n-grams are counted with Spark. A language's
filter takes an n-gram unless it is far rarer there than in another language, so
that quotations do not teach the wrong language. Prediction reads whole texts.

Defined results: null text or text without a letter is `und` with score 0, as is
everything if nothing could be learned; equal counts go to the language first in
code point order; repeated rows, null ids, empty tables and other columns are fine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import hash01, held_out

SIZES = (3, 4, 5)
POSITION_BITS = 21  # 2 MB for up to eight languages
PROBES = 2
PER_LANGUAGE = 3000
RARER = 0.1
UNKNOWN = "und"
_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)
_BATCH_BYTES = 1 << 20
_LETTER = regex.compile(r"\p{L}").search


def grams(texts: list[str], n: int) -> tuple[np.ndarray, np.ndarray]:
    """All byte n-grams of the lower-cased texts as numbers, and how many each text has. A blank pads both ends."""
    raw = [b" " + t.lower().encode() + b" " for t in texts]
    size = np.array([len(r) for r in raw])
    buf = np.frombuffer(b"".join(raw) + b" " * n, np.uint8)
    total = int(size.sum())
    key = np.full(total, n << 56, np.uint64)
    for i in range(n):
        key |= buf[i:i + total].astype(np.uint64) << np.uint64(8 * i)
    keep = np.ones(total, bool)
    ends = np.cumsum(size)
    for i in range(1, n):
        keep[ends - i] = False  # would reach into the next text
    return key[keep], size - n + 1


def positions(key: np.ndarray, bits: int, probes: int) -> list[np.ndarray]:
    return [(key * np.uint64(m) >> np.uint64(64 - bits)).astype(np.int64) for m in _MULTIPLIERS[:probes]]


def _in_blocks(texts: list[str]) -> Iterator[list[str]]:
    block, size = [], 0
    for t in texts:
        block.append(t)
        size += len(t)
        if size > _BATCH_BYTES:
            yield block
            block, size = [], 0
    if block:
        yield block


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        langs, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
        for lang in sorted(set(langs)):
            for block in _in_blocks([t for t, x in zip(texts, langs) if x == lang]):
                keys, counts = np.unique(np.concatenate([grams(block, n)[0] for n in SIZES]), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(keys)), pa.array(keys.view(np.int64)), pa.array(counts)],
                    names=["lang", "gram", "n"])


class Model:
    """Learned languages in code point order, the most frequent of them, and one table for every 64."""

    def __init__(self, languages: list[str], common: str, tables: list[np.ndarray], bits: int, probes: int):
        self.languages, self.common, self.tables, self.bits, self.probes = languages, common, tables, bits, probes
        share = np.array([((t >> t.dtype.type(i)) & t.dtype.type(1)).mean()
                          for t in tables for i in range(min(64, len(languages)))][:len(languages)])
        self.by_chance = np.minimum(share ** probes, 1 - 1e-9)

    def counts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Corrected counts, texts x languages, and n-grams per text."""
        seen = np.zeros((len(texts), len(self.languages)))
        total = np.zeros(len(texts))
        for n in SIZES:
            key, size = grams(texts, n)
            size = np.maximum(size, 0)
            total += size
            starts = np.cumsum(size) - size
            full = size > 0
            at = positions(key, self.bits, self.probes)
            for k, table in enumerate(self.tables):
                hit = table[at[0]]
                for p in at[1:]:
                    hit &= table[p]
                for i in range(64 * k, min(64 * k + 64, len(self.languages))):
                    one = (hit >> table.dtype.type(i - 64 * k)) & table.dtype.type(1)
                    if full.any():
                        seen[full, i] += np.add.reduceat(one, starts[full], dtype=np.int64)
        f = self.by_chance
        return np.maximum(0, (seen - total[:, None] * f) / (1 - f)), total

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        known = [i for i, t in enumerate(texts) if t is not None and _LETTER(t)] if self.languages else []
        at = 0
        for block in _in_blocks([texts[i] for i in known]):
            counts, total = self.counts(block)
            best = counts.argmax(axis=1)
            for row, j in enumerate(best):
                i = known[at + row]
                top = counts[row, j]
                names[i] = self.languages[j] if top > 0 else self.common
                scores[i] = float(min(1.0, top / total[row])) if total[row] else 0.0
            at += len(block)
        return names, scores


def learn(labelled: DataFrame, per_language: int = PER_LANGUAGE, bits: int = POSITION_BITS, probes: int = PROBES) -> Model:
    """From `text` and `lang`, both not null. Reaches the driver: one row per language, and the filter's positions."""
    sizes = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    languages = sorted(sizes, key=lambda s: s.encode())
    if not languages:
        return Model([], UNKNOWN, [], bits, probes)
    common = min(languages, key=lambda s: (-sizes[s], s.encode()))
    share = labelled.groupBy("lang").agg(F.least(F.lit(1.0), per_language / F.count(F.lit(1))).alias("share"))
    taken = (labelled.join(F.broadcast(share), "lang")  # one row per language
             .filter(hash01("text") < F.col("share")).select("lang", "text"))
    counts = (taken.mapInArrow(_count_grams, "lang string, gram bigint, n bigint")
              .groupBy("gram", "lang").agg(F.sum("n").alias("n")))
    # a gram's rate in each language, against its largest
    totals = F.create_map(*[x for r in taken.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("b")).collect()
                            for x in (F.lit(r["lang"]), F.lit(float(r["b"] + 1)))])
    of = F.create_map(*[x for i, s in enumerate(languages) for x in (F.lit(s), F.lit(i))])
    by_gram = counts.groupBy("gram").agg(F.collect_list(F.struct(
        of[F.col("lang")].alias("i"), (F.col("n") / totals[F.col("lang")]).alias("rate"))).alias("r"))
    kept = by_gram.select("gram", F.explode(F.filter("r", lambda x: x["rate"] >= RARER * F.array_max("r.rate"))["i"]).alias("i"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = positions(b.column(0).to_numpy().view(np.uint64), bits, probes)
            i = b.column(1).to_numpy()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(at)), pa.array(np.tile(i // 64, probes)),
                 pa.array(np.tile((np.uint64(1) << (i % 64).astype(np.uint64)).view(np.int64), probes))],
                names=["at", "slice", "mask"])

    bits_set = (kept.mapInArrow(place, "at bigint, slice int, mask bigint")
                .groupBy("slice", "at").agg(F.bit_or("mask").alias("mask"))).toArrow()
    slices = -(-len(languages) // 64)
    kind = next(t for t, w in ((np.uint8, 8), (np.uint16, 16), (np.uint32, 32), (np.uint64, 64))
                if w >= min(64, len(languages)))
    tables = [np.zeros(1 << bits, kind) for _ in range(slices)]
    which, at, mask = (bits_set[c].to_numpy() for c in ("slice", "at", "mask"))
    for k in range(slices):
        tables[k][at[which == k]] = mask[which == k].view(np.uint64).astype(kind)
    return Model(languages, common, tables, bits, probes)


def identify(docs: DataFrame, model: Model, columns: list[str], row: str | None = None) -> DataFrame:
    """`columns` of docs plus lang_pred and score, from the column `text` alone.

    `row`: one of `columns`, a struct without nulls whose field `text` is read in place of the column, so that
    workers are sent every text once.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a size set by `bits` and the number of languages
    fields = [f"_c{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(columns)]

    field = None if row is None else docs.schema[row].dataType.names.index("text")
    at = len(columns) if row is None else columns.index(row)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(at) if field is None else b.column(at).field(field)
            names, scores = shared.value.predict(texts.to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:len(columns)], pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=[*b.schema.names[:len(columns)], "lang_pred", "score"])

    text = [docs["text"].alias("_text")] if row is None else []
    out = docs.select(*[docs[c].alias(f"_c{i}") for i, c in enumerate(columns)], *text).mapInArrow(
        predict, ", ".join([*fields, "lang_pred string", "score double"]))
    return out.select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(columns)], "lang_pred", "score")


def language_of(docs: DataFrame, per_language: int = PER_LANGUAGE, folds: int = 5) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learned from the rows that are not held out and have a text and a lang."""
    model = learn(docs.filter(~held_out(F.col("doc_id"), folds) & F.col("lang").isNotNull() & F.col("text").isNotNull())
                  .select("lang", "text"), per_language)
    return identify(docs, model, ["doc_id"]).select("doc_id", held_out(F.col("doc_id"), folds).alias("held_out"), "lang_pred", "score")
