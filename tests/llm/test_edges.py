"""Every operator and stage on odd rows and on an empty table."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import corpus_pipeline  # noqa: E402
from oddities import odd_rows  # noqa: E402
from larkspur.llm.catalog import tokenizer_file  # noqa: E402
from larkspur.llm.exact_dedup import exact_dedup  # noqa: E402
from larkspur.llm.language_id import language_of  # noqa: E402
from larkspur.llm.line_dedup import dedup_lines  # noqa: E402
from larkspur.llm.mixing import mix_sources, repeat_rows  # noqa: E402
from larkspur.llm.packing import pack_documents  # noqa: E402
from larkspur.llm.simhash import keep_one, near_duplicates  # noqa: E402
from larkspur.llm.spotsigs import fingerprint_edits  # noqa: E402
from larkspur.llm.suffix_tree import score_texts  # noqa: E402
from larkspur.llm.token_counts import prefix_token_counts  # noqa: E402

OPERATORS = {
    "mix": mix_sources, "pack": lambda d: pack_documents(d, tokenizer_file("word_bpe_49k.json")), "score": score_texts,
    "lines": dedup_lines, "tokens": lambda d: prefix_token_counts(d, tokenizer_file("byte_bpe_50k.json")),
    "exact": exact_dedup, "language": language_of, "simhash": near_duplicates, "spotsigs": fingerprint_edits}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(empty, name):
    assert OPERATORS[name](empty).count() == 0


@pytest.mark.parametrize("name", [n for n in OPERATORS if n != "pack"])
def test_one_row_per_row(odd, name):
    got = sorted(((r["doc_id"] is None, r["doc_id"] or 0) for r in OPERATORS[name](odd).collect()))
    assert got == sorted((r[0] is None, r[0] or 0) for r in odd_rows())


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stage_on_empty_table(spark, empty, tables, name, stage):
    assert stage(spark, empty, tables).count() == 0


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES[:-1])
def test_stage_keeps_columns(spark, odd, tables, name, stage):
    got = stage(spark, odd, tables)
    assert got.columns == odd.columns and 0 < got.count()


def test_exact(odd):
    rows = exact_dedup(odd).collect()
    cat = [r for r in rows if r["doc_id"] in (1, 2)]
    assert {r["keep_id"] for r in cat} == {2} and {r["group_size"] for r in cat} == {3} and sum(r["kept"] for r in cat) == 1
    nothing = [r for r in rows if r["group_size"] == 3 and r["keep_id"] == 4]  # empty and null texts
    assert len(nothing) == 3 and [r["doc_id"] for r in nothing if r["kept"]] == [4]
    nameless = [r for r in rows if r["group_size"] == 2 and r["doc_id"] is None]
    assert len(nameless) == 2 and sum(r["kept"] for r in nameless) == 1


def test_mix(odd):
    rows = mix_sources(odd).collect()
    by = {}
    for r in rows:
        assert r["taken"] <= 3 * r["size"]
        by.setdefault((r["s"], r["s_null"]), []).append(r)
    for group in by.values():
        assert sum(r["size"] for r in group) == group[0]["source_size"]
        assert group[0]["target"] <= 3 * group[0]["source_size"] + 1e-6
    assert abs(sum(g[0]["target"] for g in by.values()) - sum(r["size"] for r in rows)) < 1e-6
    assert sorted(map(repr, rows)) == sorted(map(repr, mix_sources(odd.repartition(5)).collect()))


def test_repeated_rows_share_their_copies(spark):
    rows = spark.createDataFrame([(1, "a b c", "x")] * 5 + [(2, "a b c d", "y")], "doc_id bigint, text string, source string")
    taken = {r["doc_id"]: r["n"] for r in mix_sources(rows).groupBy("doc_id").agg({"taken_times": "sum"}).toDF("doc_id", "n").collect()}
    got = {r["doc_id"]: r["count"] for r in repeat_rows(rows).groupBy("doc_id").count().collect()}
    assert got == {k: v for k, v in taken.items() if v}


def test_packing(odd):
    rows = pack_documents(odd, tokenizer_file("word_bpe_49k.json"), capacity=64).collect()
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 64


def test_tokens(odd):
    rows = {r["doc_id"]: r for r in prefix_token_counts(odd, tokenizer_file("byte_bpe_50k.json")).collect()}
    assert rows[3]["n_tokens"] == rows[4]["n_tokens"] == 0 and not rows[3]["over_limit"] and rows[6]["over_limit"]


def test_language(odd):
    rows = {r["doc_id"]: r for r in language_of(odd).collect()}
    assert all(rows[k]["lang_pred"] == "und" and rows[k]["score"] == 0 for k in (3, 4, 5, 9))


def test_lines(odd):
    rows = {r["doc_id"]: r for r in dedup_lines(odd).collect() if r["doc_id"] is not None}
    assert rows[2]["n_removed"] == 1 and rows[2]["text"] == "" and rows[1]["n_removed"] == 0
    assert rows[11]["text"] == "ééé\nsame line here now" and rows[12]["text"] == "<|endoftext|> THE END"
    assert rows[3]["text"] is None and rows[5]["n_removed"] == 0


def test_simhash(odd):
    rows = near_duplicates(odd).collect()
    assert {r["component_id"] for r in rows if r["doc_id"] in (1, 2)} == {1}
    assert {r["component_id"] for r in rows if r["fp"] == 0} == {3}
    kept = keep_one(odd).collect()
    assert sum(r["doc_id"] is None for r in kept) == 1 and sorted(r["doc_id"] for r in kept if r["doc_id"]) == [
        1, 3, 6, 7, 8, 9, 10, 11, 12]


def test_spotsigs(spark, odd):
    rows = fingerprint_edits(odd).collect()
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in rows)
    cat = [r for r in rows if r["doc_id"] in (1, 2)]
    assert len({r["fingerprint"] for r in cat}) == 1
    pages = spark.createDataFrame([(1, "the " * 200_000), (2, "of the sea, " * 50_000)], "doc_id bigint, text string")
    assert fingerprint_edits(pages).count() == 2
    one = fingerprint_edits(odd.filter("doc_id = 7")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1


def test_scores(odd):
    rows = {r["doc_id"]: r for r in score_texts(odd).collect()}
    assert rows[3]["n_tokens"] == rows[4]["n_tokens"] == 1 and rows[3]["train_tokens"] == rows[1]["train_tokens"] > 0
    assert all(r["score"] <= 0 for r in rows.values())
