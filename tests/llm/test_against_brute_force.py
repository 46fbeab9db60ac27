"""Queries on the given tables against plain Python, and against SQL where there is any."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import regex
import xxhash

import __spark_entry__ as entry_point
from compare import difference, oracle
from larkspur.llm.catalog import QUERIES, SQL, tokenizer_file

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORDS = re.compile(r"[^\x20\x09-\x0D]+").findall


@pytest.fixture(scope="module")
def result(spark, tables):
    cache = {}

    def get(name):
        if name not in cache:
            cache[name] = QUERIES[name](spark, tables).collect()
        return cache[name]
    return get


@pytest.mark.parametrize("name", list(SQL))
def test_equals_sql(spark, tables, name):
    assert difference(spark, oracle(tables), tables, name) is None


def test_all_operators_and_the_pipeline_are_registered():
    names = entry_point.queries()
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)} and "pipeline" in names


def test_packing(result, texts):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer_file("word_bpe_49k.json"))
    want = set()
    for i, t in texts.items():
        ids = np.array([*tok.encode(t, add_special_tokens=False).ids, 1], "<u4")
        for piece, start in enumerate(range(0, len(ids), 4096)):
            part = ids[start:start + 4096]
            want.add((i, piece, start, len(part), zlib.crc32(part.tobytes())))
    rows = result("op2_best_fit_packing")
    assert {(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows} == want and len(rows) == len(want)
    total = sum(r["length"] for r in rows)
    assert len({r["sequence_id"] for r in rows}) <= -(-total // 4096) + 1
    for r, s in zip(o := sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])), o[1:]):
        assert s["offset"] == (r["offset"] + r["length"] if s["sequence_id"] == r["sequence_id"] else 0)
        assert s["offset"] + s["length"] <= 4096


def test_chunk_ids_equal_the_library():
    from tokenizers import Tokenizer

    from larkspur.llm.packing import ChunkIds
    path = tokenizer_file("word_bpe_49k.json")
    tok, mine, draw = Tokenizer.from_file(path), ChunkIds(path, 50), random.Random(3)
    bits = ["A", "the", " ", "\n", "\t", "'re", "'", "!!", "\xa0", "\x1c", "é", "日本", "1", "<|endoftext|>", "<|end", "́",
            "\x85", "😀", "İ", "Σ", "ß", "\xad", "A\x7f"]
    for _ in range(600):
        s = "".join(draw.choice(bits) for _ in range(draw.randint(0, 10)))
        assert mine(s).tolist() == tok.encode(s, add_special_tokens=False).ids, repr(s)


def test_letters_and_marks_after_them_are_not_split_by_pattern():
    from tokenizers import Tokenizer

    from larkspur.llm.packing import ChunkIds
    path = tokenizer_file("word_bpe_49k.json")
    tok, mine, draw = Tokenizer.from_file(path), ChunkIds(path, 50), random.Random(4)
    bits = ["A", "the", "É", "ñ", "ß", "ǆ", "ª", "ı", "Ж", "日", "İ", "xYz"]
    marks = ["", ",", "...", "&&&", "_", "<", "'s", "'", ">|", "|>", "<|endoftext|>", "-a", "9", "\u0301", "=\u0338"]
    for _ in range(600):
        s = "".join(draw.choice(bits) for _ in range(draw.randint(0, 4))) + draw.choice(marks)
        assert mine(s).tolist() == tok.encode(s, add_special_tokens=False).ids, repr(s)
    mine = ChunkIds(path)
    mine.split = None
    for s in ("Thathesha", "osadoci.", "domicílio,$$$"):
        assert mine(s).tolist() == tok.encode(s, add_special_tokens=False).ids


def test_prefix_counts_equal_the_library(result, texts):
    from tokenizers import Tokenizer

    from larkspur.llm.token_counts import PrefixCounter
    path = tokenizer_file("byte_bpe_50k.json")
    tok, draw = Tokenizer.from_file(path), random.Random(5)
    for r in result("op5_token_counts"):
        n = len(tok.encode(texts[r["doc_id"]], add_special_tokens=False).ids)
        assert (r["n_tokens"], r["over_limit"], r["n_bytes"]) == (n, n > 1024, len(texts[r["doc_id"]].encode()))
    mine = PrefixCounter(path, 50)
    bits = ["a", "the", " ", "  ", "\n", "'re", "'s", "'", "!!", "\xa0", "\x1c", "é", "日本", "23", "<|endoftext|>", "<|endof",
            "😀", "x" * 30, "\r\n"]
    for _ in range(300):
        s = "".join(draw.choice(bits) for _ in range(draw.randint(0, 10)))
        want = [len(tok.encode(s[:i], add_special_tokens=False).ids) for i in range(len(s) + 1)]
        assert mine.table(s).tolist() == want, repr(s)
    assert all(mine.piece(t)[-1] == 1 for t in mine.tokens)


def test_line_dedup(result, texts):
    kept_sets, want = [], {}
    for i in sorted(texts):
        lines = []
        for line in texts[i].split("\n"):
            s = frozenset(WORDS(line.translate(AZ)))
            if s and any(len(s & x) >= 0.8 * len(s | x) - 1e-9 for x in kept_sets):
                kept_sets.append(s)
                continue
            if s:
                kept_sets.append(s)
            lines.append(line)
        want[i] = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    assert {r["doc_id"]: r["kept_sha256"] for r in result("op4_line_dedup")} == want


def test_line_join_with_one_partner_at_a_time(spark, texts):
    """Further rounds decide what the first partners do not."""
    from larkspur.llm.line_dedup import later_matches, numbered
    draw = random.Random(1)
    base = [f"w{i}" for i in range(40)]
    rows = []
    for i in range(150):
        words = base.copy()
        for _ in range(draw.randint(0, 9)):
            words[draw.randrange(40)] = f"x{draw.randrange(400)}"
        rows.append((i, " ".join(words)))
    sets = [set(t.split()) for _, t in rows]
    want = {i for i in range(150) if any(len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9 for j in range(i))}
    for first in (1, 4):
        docs = numbered(spark.createDataFrame(rows, "doc_id bigint, text string"))
        got = later_matches(docs, first=first).collect()
        assert {r["doc"] for r in got} == want


def test_scores(result, texts):
    tokens = {i: [*WORDS(t.translate(AZ)), None] for i, t in texts.items()}
    out = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in texts}
    c = Counter(w for i, ws in tokens.items() if not out[i] for w in ws)
    n, v = sum(c.values()), len(c)
    own = base = 0
    for r in result("op3_suffix_tree"):
        ws = tokens[r["doc_id"]]
        want = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (
            out[r["doc_id"]], len(ws), sum(c[w] > 0 for w in ws), n)
        assert abs(r["base_score"] - want) <= 1e-9 * abs(want)
        own, base = (own + r["score"], base + r["base_score"]) if r["held_out"] else (own, base)
    assert own > base


def test_language(result, spark, tables):
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{tables}/documents.parquet").collect()}
    held = [r for r in result("op7_language_id") if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in result("op7_language_id"))
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.95 * len(held)


def test_simhash(result, texts):
    fps = {}
    for i, t in texts.items():
        w = WORDS(t.translate(AZ))
        grams = [" ".join(w[k:k + 3]) for k in range(len(w) - 2)] if len(w) > 2 else [" ".join(w)] if w else []
        ones = [0] * 64
        for g in grams:
            x = xxhash.xxh64_intdigest(g.encode(), 42)
            for b in range(64):
                ones[b] += x >> b & 1
        fps[i] = sum(1 << b for b in range(64) if 2 * ones[b] > len(grams))
    assert {r["doc_id"]: r["fingerprint"] for r in result("op8_simhash")} == {i: f"{f:016x}" for i, f in fps.items()}
    assert {r["doc_id"]: r["component_id"] for r in result("op8_simhash")} == _components(fps)


def _components(fps):
    root = {i: i for i in fps}
    ids = sorted(fps)
    changed = True
    while changed:
        changed = False
        for i in ids:
            for j in ids:
                if (fps[i] ^ fps[j]).bit_count() <= 2 and root[i] != root[j]:
                    root[i] = root[j] = min(root[i], root[j])
                    changed = True
    return root


@pytest.mark.parametrize("cell_rows", [2, 8, 2048])
def test_links_in_crowded_cells(spark, cell_rows):
    """Many fingerprints around a few centres: cells are cut again and nothing is lost."""
    from pyspark.sql import functions as F

    from larkspur.llm.components import components
    from larkspur.llm.simhash import _signed, near_links
    draw = random.Random(7)
    fps = set()
    for _ in range(4):
        centre = draw.getrandbits(64)
        for _ in range(60):
            x = centre
            for _ in range(draw.randint(0, 4)):
                x ^= 1 << draw.randrange(64)
            fps.add(_signed(x))
    df = spark.createDataFrame([(x,) for x in fps], "fp bigint")
    roots = {r["u"]: r["root"] for r in components(near_links(df, cell_rows=cell_rows).select(F.col("u"), F.col("v"))).collect()}
    got = {x: roots.get(x, x) for x in fps}
    want = _components({x: x & (1 << 64) - 1 for x in fps})
    groups = lambda m: {frozenset(k for k in m if m[k] == r) for r in set(m.values())}
    assert groups(got) == groups(want)


def test_components_of_a_path_and_a_star(spark):
    from larkspur.llm.components import components
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5, 5)]
    got = {r["u"]: r["root"] for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {i: 0 for i in range(1, 201)} | {1000 + i: 1000 for i in range(1, 300)}


def test_spotsigs(result, texts):
    from larkspur.llm.spotsigs import ANCHORS, CHAIN
    ids = sorted(texts, reverse=True)

    def sigs(t):
        w = [x for x in regex.split(r"[^\p{L}\p{N}]+", t.lower()) if x]
        found = set()
        for i, x in enumerate(w):
            if x in ANCHORS:
                chain = [y for y in w[i + 1:i + 200] if y not in ANCHORS][:CHAIN]
                if len(chain) == CHAIN:
                    found.add((x, *chain))
        return found or {t}

    rows = {r["doc_id"]: r for r in result("op10_spotsigs")}
    like = lambda a, b: len(a & b) / len(a | b)
    for i, after in zip(ids, ids[1:] + ids[:1]):
        t, k = texts[i], len(texts[i]) // 3
        edited = t[:len(t) - k] + texts[after][:k]
        r = rows[i]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert len(r["fingerprint"]) == 8 * len(sigs(t))
        assert abs(r["near_edited"] - like(sigs(t), sigs(edited))) < 1e-9
        assert abs(r["near_next"] - like(sigs(t), sigs(texts[after]))) < 1e-9


def test_mix_comes_near_its_targets(result, spark, tables):
    source = {r["doc_id"]: r["source"] for r in spark.read.parquet(f"{tables}/documents.parquet").collect()}
    by, size = {}, {}
    for r in result("op1_source_mix"):
        s = source[r["doc_id"]]
        by.setdefault(s, [0, r["target"], r["source_size"]])[0] += r["taken"]
        size[s] = size.get(s, 0) + r["size"]
        assert r["taken"] <= 3 * r["size"]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sorted(by))}
    total, open_ = sum(size.values()), set(by)
    want = {}
    while True:  # reshare what is above the caps, as the contract words it
        left = total - sum(want.values())
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * size[s]}
        if not over:
            want |= share
            break
        want |= {s: 3.0 * size[s] for s in over}
        open_ -= over
    for s, (taken, target, source_size) in by.items():
        assert source_size == size[s] and abs(target - want[s]) < 1e-6 * total
        assert abs(taken - target) <= 0.1 * target
    lengths = [r["size"] for r in result("op1_source_mix")]
    assert len(lengths) == len(source)


def test_flight_keeps_totals():
    from larkspur.llm.mixing import flight, land
    rng = np.random.default_rng(1)
    for _ in range(20):
        size = rng.integers(0, 500, 300)
        size[:3] = 30_000
        pi = np.full(300, rng.random())
        moved = flight(pi, size, 7)
        assert ((moved > 0) & (moved < 1)).sum() <= 2 and abs(moved.sum() - pi.sum()) < 1e-6
        assert abs((moved * size).sum() - (pi * size).sum()) < 1e-3
        assert set(land(moved, size.astype(float))) <= {0.0, 1.0}
