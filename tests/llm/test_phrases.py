"""Collocations against counting every phrase."""

import pickle
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from larkspur.llm import phrases
from larkspur.llm.phrases import collocations, tile_counts
from larkspur.llm.words import packed, unpacked

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, longest=5, top=2000):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", (text or "").translate(AZ)):
            words = re.findall(r"[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i:i + k])] += 1
    frequent = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    held = Counter()
    for (lang, p), a in frequent.items():
        for k in range(2, len(p)):
            for i in range(len(p) - k + 1):
                held[lang, p[i:i + k]] = max(held[lang, p[i:i + k]], a)
    by = {}
    for (lang, p), a in frequent.items():
        if held[lang, p] < a:
            score, _, l, r = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]])
                                 for k in range(1, len(p)))
            by.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), l, r))
    return sorted((lang, rank, p.decode(), -a, l, r, n[lang], -score) for lang, found in by.items()
                  for rank, (score, a, p, l, r) in enumerate(sorted(found)[:top], 1))


def got(df):
    return sorted(map(tuple, df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()))


def frame(spark, rows, parts=6):
    return spark.createDataFrame([(lang, text, 1, "w", 2) for lang, text in rows],
                                 "lang string, text string, block int, words string, part int").repartition(parts)


def made_up(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["é", "ﬁ", "A", "a", "\x1c", "\x00"]
    rows = []
    for _ in range(n):
        text = "".join(rng.choice(words[:1 + rng.randrange(len(words))]) + rng.choice([" "] * 12 + ["  ", "\t", ". ", ",", "\n", "\x0b", "!?"])
                       for _ in range(rng.randrange(120)))
        rows.append((rng.choice(["en", "en", "en", "de", None, "und"]), text + rng.choice(["", "w1 w2 w3 w4 w5", " a a a a a a a"])))
    return rows + [(None, None), ("en", ""), ("en", " .,. "), ("fr", "x " * 5000), ("en", rows[0][1])] * 3


@pytest.mark.parametrize("dense,side,block_bytes,told", [(4096, 256, 1 << 20, 10 ** 6), (16, 4, 500, 0), (8, 4, 1, 0), (8, 4, 1, 300)])
def test_every_phrase(spark, dense, side, block_bytes, told):
    """Also where most of the square is sparse, where every text is a block and merging takes several rounds, and without
    broadcasts."""
    rows = made_up(block_bytes, 200)
    assert got(collocations(frame(spark, rows), 8, dense=dense, side=side, block_bytes=block_bytes, told=told)) == brute(rows, 8)


def test_only_the_first(spark):
    rows = made_up(5, 80)
    assert got(collocations(frame(spark, rows), 4, longest=3, top=7)) == brute(rows, 4, 3, 7)


def test_nothing_frequent(spark, empty):
    assert collocations(empty).count() == 0
    assert collocations(frame(spark, [("en", "a b c"), (None, None)])).count() == 0
    assert got(collocations(frame(spark, [("en", "a b c")]), 1)) == [("en", 1, "a b c", 1, 1, 1, 3, 3000)]


def test_long_text(spark):
    text = "one two three, " * 200_000
    assert got(collocations(frame(spark, [("en", text)]), 100)) == brute([("en", text)], 100)


def test_exact_beyond_64_bits(spark):
    from larkspur.llm.phrases import _cuts
    a, n, l, r = 9_007_199_254_740_993, 99_999_999_999_999_999, 900_719_925_474_099_300, 99_999_999_999_999_998
    row = spark.createDataFrame([(a, n, [l, a], [r, a])], "f bigint, n bigint, starts array<bigint>, ends array<bigint>").select(
        _cuts(2)[0]).first()[0]
    assert row["score"] == 1000 * a * n // (l * r)


def test_tiles_hold_every_pair_once():
    rng = np.random.default_rng(3)
    left, right = rng.zipf(1.3, 5000) % 40, rng.zipf(1.3, 5000) % 40
    found = Counter()
    for tile, codes, counts in tile_counts(left, right, 16, 4):
        for c, n in zip(codes.tolist(), counts.tolist()):
            found[(tile // 4 * 4 + c // 4, tile % 4 * 4 + c % 4) if tile >= 0 else (c >> 32, c & 0xFFFFFFFF)] += n
    assert found == Counter(zip(left.tolist(), right.tolist()))


def sent_to_python(df):
    """Bytes that each operator with Python workers was sent, by its name, once `df` has run."""
    found = Counter()

    def walk(node):
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            return walk(node.executedPlan())
        if "QueryStage" in name:
            return walk(node.plan())
        if node.metrics().contains("pythonDataSent"):
            found[name] += node.metrics().apply("pythonDataSent").value()
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return found


@pytest.mark.parametrize("blocks", [300, 600])
def test_ranks_of_a_tile_are_not_sent_for_every_block(spark, blocks):
    """what an answering task takes in, and holds, grew by all ranks of a tile for each block that asked for some."""
    dense, side, n = 256, 256, 20_000
    places = spark.range(0, blocks, 1, 4).select(
        F.col("id").alias("block"), F.col("id").alias("part"), F.lit(packed(np.array([0, 1, 1]))).alias("at"),
        F.array(F.lit(0), F.col("id") % 50, F.lit(2)).alias("s"))
    places = places.mapInArrow(lambda bs: (pa.RecordBatch.from_arrays([b["block"], b["part"], b["at"], pa.array(
        [packed(np.array(x)) for x in b["s"].to_pylist()], pa.binary())], names=["block", "part", "at", "symbol"]) for b in bs),
        "block bigint, part bigint, at binary, symbol binary").localCheckpoint()
    counted = spark.createDataFrame([(0, b, b, bytearray(packed(np.array([b % 50, b % 50 * 256 + 2]))), bytearray(packed(np.array([1, 1]))))
                                     for b in range(blocks)], "tile bigint, block bigint, part bigint, codes binary, counts binary")
    frequent = spark.range(0, n, 1, 4).select(F.lit(0).cast("bigint").alias("tile"), F.col("id").alias("code"),
                                              F.floor(F.col("id") / 256).alias("left"), (F.col("id") % 256).alias("right"), F.col("id"))
    told = phrases.joined_places(places, counted, frequent, dense, side)
    rows = told.collect()
    assert sorted((r["block"], tuple(np.cumsum(unpacked(r["at"]))), tuple(unpacked(r["symbol"]))) for r in rows) == [
        (b, (0, 1), (b % 50, b % 50 * 256 + 2)) for b in range(blocks)]
    assert 0 < sent_to_python(told)["MapInArrow"] < 1 << 20


def test_answers_are_handed_on_in_pieces(monkeypatch):
    """Also without a tile's ranks, and where a tile's rows come in several batches."""
    monkeypatch.setattr(phrases, "ANSWER_BYTES", 100)
    known = np.arange(0, 60, 3)
    rows = [(0, 0, None, packed(known), packed(known + 7))] + [(0, 0, b, packed(np.arange(b, b + 10)), None) for b in range(50)]
    rows += [(1, 0, b, packed(np.arange(5)), None) for b in range(3)]
    rows += [(-2, 0, None, packed(np.array([5 << 32 | 6])), packed(np.array([1]))), (-2, 0, 9, packed(np.array([5 << 32 | 6, 5 << 32 | 7])), None)]
    schema = pa.schema([("tile", pa.int64()), ("together", pa.int64()), ("block", pa.int64()), ("codes", pa.binary()), ("ids", pa.binary())])
    batches = pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema).to_batches(max_chunksize=7)
    out = list(phrases.answered(iter(batches), 16, 4))
    found = sorted((r["of"], x, i) for b in out for r in b.to_pylist()
                   for x, i in zip(unpacked(r["pairs"]).tolist(), unpacked(r["ids"]).tolist()))
    assert found == sorted([(b, (c // 4) << 32 | c % 4, c + 7) for b in range(50) for c in range(b, b + 10) if c % 3 == 0 and c < 60]
                           + [(9, 5 << 32 | 6, 1)])
    assert all(b.num_rows <= 7 for b in out) and len(out) > 10


def test_told_words_are_flat(spark, monkeypatch):
    """a million words as Python texts in dicts took some 200 MB of every worker."""
    n, kept = 20_000, []
    words = spark.range(0, n, 1, 2).select(F.lit("en").alias("lang"), F.concat(F.lit("word"), F.col("id")).alias("word"), "id")
    blocks = spark.createDataFrame([(0, 0, ["en", "de"], ["word7", "word7"], bytearray(packed(np.array([1, 0, 2, 1]))))],
                                   "block bigint, part bigint, langs array<string>, words array<string>, codes binary")
    kind = type(spark.sparkContext)
    with monkeypatch.context() as m:
        m.setattr(kind, "broadcast", lambda sc, x, own=kind.broadcast: (kept.append(x), own(sc, x))[1])
        row = phrases.told_words(blocks, words).first()
    assert (unpacked(row["at"]).tolist(), unpacked(row["symbol"]).tolist()) == ([0, 3], [7, 7])
    told, arrow = pickle.dumps(kept[0]), pa.total_allocated_bytes()
    tracemalloc.start()
    try:
        copy = pickle.loads(told)
        assert tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes() - arrow < 64 * n
    finally:
        tracemalloc.stop()
    assert copy
