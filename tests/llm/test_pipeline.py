"""The pipeline's stages and run() on planted copies, junk and clean documents, against plain Python."""

import itertools
import random
import re

import pytest
import xxhash

import corpus_pipeline
from larkspur.llm.catalog import tokenizer_file
from test_line_dedup import words

STAGES = dict(corpus_pipeline.STAGES)
LINE = "all rights reserved by the people who wrote this page long ago"


def made():
    """(doc_id, text, lang, source, n_chars) and the ids of rows planted as junk."""
    rng = random.Random(4)
    syllables = {"en": "the and ing ther ion ough sh wh ea", "de": "der ung sch ein ich ver keit lich au"}
    rows, junk = [], set()

    def text(lang, n):
        parts = syllables[lang].split()
        return "\n".join(" ".join("".join(rng.choices(parts, k=rng.randrange(1, 5))) for _ in range(12)) for _ in range(n))

    for i in range(60):
        lang = "en" if i % 3 else "de"
        t = text(lang, rng.randrange(4, 9))
        rows.append((i, t + (f"\n{LINE}" if i % 4 == 0 else ""), lang, f"s{i % 5 // 2}"))
    for i in range(60, 66):  # exact copies
        rows.append((i, rows[i - 60][1], rows[i - 60][2], "s1"))
    for i in range(66, 72):  # copies in other lines: what line dedup leaves may still be near
        rows.append((i, rows[i - 60][1].replace("\n", " "), rows[i - 60][2], None))
    for i, t in enumerate((None, "", "   ", "1234 5678 9012", "!!! ???", "42 * 42 = 1764"), 72):
        junk.add(i)
        rows.append((i, t, "en", "s0"))
    return [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows], junk


@pytest.fixture(scope="module")
def fixture(spark, tmp_path_factory):
    rows, junk = made()
    root = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(3).write.parquet(
        f"{root}/documents.parquet")
    return root, spark.read.parquet(f"{root}/documents.parquet"), rows, junk


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def lines_kept(rows):
    earlier, out = [], {}
    for i, text in sorted(rows):
        kept = []
        for line in text.split("\n"):
            w = words(line)
            if not w or not any(len(w & e) >= 0.8 * len(w | e) - 1e-9 for e in earlier):
                kept.append(line)
            earlier += [w] if w else []
        kept = "\n".join(kept)
        if kept == text or words(kept):
            out[i] = kept
    return out


def fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text.translate({c: c + 32 for c in range(65, 91)}))
    grams = [" ".join(w[k:k + 3]) for k in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def one_of_each(found):
    """The smallest id of every group that SimHashes within two bits link."""
    prints = {i: fingerprint(t) for i, t in found.items()}
    parent = {i: i for i in found}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in itertools.combinations(sorted(found), 2):
        if (prints[a] ^ prints[b]).bit_count() <= 2:
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    return {i: t for i, t in found.items() if root(i) == i}


def test_stages_one_by_one(spark, fixture):
    root, docs, rows, junk = fixture
    clean = {i: t for i, t, *_ in rows if i not in junk}
    after = STAGES["language_id"](spark, docs, root)
    assert texts(after) == clean and after.columns == docs.columns
    want = lines_kept(clean.items())
    assert len(want) < len(clean) and sum(LINE in t.split("\n") for t in want.values()) == 1
    after = STAGES["line_dedup"](spark, after, root)
    assert texts(after) == want and after.columns == docs.columns
    assert all(r["n_chars"] == len(r["text"]) for r in after.collect())
    given = docs.filter(docs.doc_id.isin([i for i in clean]))  # copies and all, for the stage on its own input
    assert texts(STAGES["simhash_near_dedup"](spark, given, root)) == one_of_each(clean)
    assert len(one_of_each(clean)) == 60  # the exact copies and those that differ in white space only are gone


def test_run(spark, fixture):
    """Every token of what the stages leave is in one sequence, in order, as often as the mix takes its document."""
    from tokenizers import Tokenizer
    root, docs, rows, junk = fixture
    got = [r.asDict() for r in corpus_pipeline.run(spark, root).collect()]
    left = one_of_each(lines_kept([(i, t) for i, t, *_ in rows if i not in junk]))
    taken = {}
    for r in got:
        taken[r["doc_id"]] = taken.get(r["doc_id"], 0) + (r["piece"] == 0)
    assert set(taken) <= set(left) and max(taken.values()) <= 3 and len(taken) > len(left) / 2
    tok = Tokenizer.from_file(tokenizer_file("word_bpe_49k.json"))
    for i, times in taken.items():
        n = len(tok.encode(left[i], add_special_tokens=False).ids) + 1
        assert sum(r["length"] for r in got if r["doc_id"] == i) == n * times
    sequences = {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 4096


def shuffled_bytes(df):
    """What the exchanges of an executed plan have written."""
    def under(node):
        nodes, name = [node], node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            nodes += under(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            nodes += under(node.plan())
        children = node.children()
        for k in range(children.size()):
            nodes += under(children.apply(k))
        return nodes
    return sum(n.metrics().apply("shuffleBytesWritten").value() for n in under(df._jdf.queryExecution().executedPlan())
               if n.getClass().getSimpleName() == "ShuffleExchangeExec")


def test_near_duplicates_leaves_texts_where_they_are(spark):
    """Only rows of which a bit table leaves open whether they stay are shuffled; ids may repeat or be null."""
    rng = random.Random(8)
    alphabet = [chr(c) for c in range(0x4E00, 0x9000)]

    def text():
        return " ".join("".join(rng.choices(alphabet, k=4)) for _ in range(120))

    rows = [(i, text()) for i in range(600)]
    rows += [(i + 1000, rows[i][1]) for i in range(20)] + [(7, rows[30][1]), (50, text()), (None, text()), (None, rows[40][1])]
    copy = text()
    rows += [(2000, copy), (2000, copy), (2001, copy), (None, copy)]
    docs = corpus_pipeline.written(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = corpus_pipeline.keep_one(docs)
        got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"]) for r in out.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # two rows of id 7, and of id 50, stay by their groups, of which either is kept; the group of id 30 is named by id 7
    own = {7: {rows[7][1], rows[30][1]}, 50: {rows[50][1], rows[621][1]}, 2000: {copy}}
    assert [(null, i) for null, i, _ in got] == [(False, i) for i in [*range(30), *range(31, 600), 2000]] + [(True, 0)]
    assert all(t in (own.get(i) or {rows[i][1]}) for null, i, t in got if not null) and got[-1][2] == rows[622][1]
    assert 0 < shuffled_bytes(out) < 0.2 * sum(len((t or "").encode()) for _, t in rows)


def test_workers_are_sent_every_text_once(spark, fixture):
    """the language stage's workers read the text inside the row, they get no copy beside it."""
    root, docs, *_ = fixture
    plan = STAGES["language_id"](spark, docs, root)._jdf.queryExecution().optimizedPlan()
    while plan.getClass().getSimpleName() != "MapInArrow":
        plan = plan.children().apply(0)
    assert plan.children().apply(0).output().size() == 1


def test_the_tokenizer_file_is_not_parsed_in_workers(monkeypatch):
    """of the tokenizer only its small parts become Python objects."""
    import json

    from larkspur.llm.packing import ChunkIds
    read = []
    monkeypatch.setattr(json, "load", lambda f, **k: pytest.fail("the whole file was parsed"))
    monkeypatch.setattr(json, "loads", lambda s, f=json.loads: (read.append(len(s)), f(s))[1])
    ids = ChunkIds(tokenizer_file("word_bpe_49k.json"))
    assert sum(read) < 10_000 and len(ids("some words")) >= 2
