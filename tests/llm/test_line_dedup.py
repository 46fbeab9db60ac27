"""Line dedup against comparing every pair of lines."""

import random
import re

import numpy as np
import pytest

from larkspur.llm.common import written
from larkspur.llm.line_dedup import FINE, Lines, dedup_lines, digests, verified
from larkspur.llm.words import mix, set_bits


def words(line):
    return frozenset(re.findall(r"[^\x20\x09-\x0D]+", line.translate({c: c + 32 for c in range(65, 91)})))


def brute(rows):
    """{row number: text} after dedup; rows (doc_id, text) come in order. A line counts as earlier whether it stays or not."""
    earlier, out = [], {}
    for k, (_, text) in enumerate(rows):
        kept = []
        for line in text.split("\n"):
            w = words(line)
            if not w or not any(len(w & e) >= 0.8 * len(w | e) - 1e-9 for e in earlier):
                kept.append(line)
            if w:
                earlier.append(w)
        out[k] = "\n".join(kept)
    return out


def run(spark, rows, **kwargs):
    df = spark.createDataFrame([(i, t, k, "x") for k, (i, t) in enumerate(rows)], "doc_id bigint, text string, number int, doc string")
    return {r["number"]: r["text"] for r in dedup_lines(df.repartition(5), **kwargs).collect()}


def test_words_of_equal_hash_parts_stay(spark):
    """One-word lines whose list word and 32 bits of hash agree are different lines."""
    for a, b in (("item6632724", "item7204365"), ("item6496354", "item7986785")):
        assert run(spark, [(1, a), (2, b), (3, a)]) == {0: a, 1: b, 2: ""}


def test_rows_that_share_an_id_are_documents_of_their_own(spark):
    rows = [(1, "one common line of eight words right here\nalpha beta"), (7, "one common line of eight words right here\nown text"),
            (7, "something fully different here\nmore of it")]
    got = run(spark, rows)
    assert got[0] == rows[0][1] and got[1] == "own text" and got[2] == rows[2][1]
    assert sorted(run(spark, [(5, "a b c"), (5, "a b c"), (5, "d e f")]).values()) == ["", "a b c", "d e f"]


@pytest.mark.parametrize("first", [1, 4])
def test_near_lines(spark, first):
    rng = random.Random(first)
    vocabulary = [f"w{k}" for k in range(400)]
    template = rng.sample(vocabulary, 30)
    rows = []
    for i in range(120):
        lines = []
        for _ in range(rng.randrange(1, 5)):
            kind = rng.random()
            if kind < 0.4:  # variants of one template, around the bar
                line = [w if rng.random() > rng.choice([0.02, 0.1, 0.2]) else rng.choice(vocabulary) for w in template]
            elif kind < 0.5:
                line = ["same", "Line", "here"]
            else:
                line = rng.choices(vocabulary, k=rng.randrange(0, 25))
            lines.append(" ".join(line))
        rows.append((i, "\n".join(lines)))
    assert run(spark, rows, first=first) == brute(rows)


def test_ids_of_any_size(spark):
    rows = [(-(1 << 62), "far away line of words"), (5, "Far away line of words"), (1 << 62, "far away LINE of words\nelse")]
    assert run(spark, rows) == {0: rows[0][1], 1: "", 2: "else"}


def test_verified_lines_are_stored_once(spark):
    """The pairs' lines are a table of strings of distinct words, A-Z lower-cased, that no join shuffles again."""
    lines = ["a b c d e f g h i", "A b\tc d e f g h j j", "a b c d e f g h x y", "Ä b c"]
    known = spark.createDataFrame([(k, t) for k, t in enumerate(lines)], "doc bigint, text string")
    pairs = spark.createDataFrame([(1, 0, 0, 0, False), (2, 0, 0, 0, True), (2, 0, 1, 0, False), (3, 0, 0, 0, True)],
                                  "doc bigint, line bigint, by_doc bigint, by_line bigint, more boolean")
    judged, texts = verified(known, written(pairs), 0.8)
    want = {0: lines[0], 1: "a b c d e f g h j", 2: lines[2], 3: "Ä b c"}
    assert {r["doc"]: r["words"] for r in texts.collect()} == want
    join = texts.hint("merge").join(pairs, ["doc", "line"])
    assert join._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert {r["doc"]: (r["match"], r["more"]) for r in judged.collect()} == {1: (True, False), 2: (False, True), 3: (False, True)}


def test_lines_without_wanted_words_are_left_out_early():
    """What the second round makes of a block holds the lines with wanted words only, and these as the first round has them."""
    rng = random.Random(2)
    raws = ["\n".join(" ".join(rng.choices([f"w{k}" for k in range(3000)], k=rng.randrange(0, 9))) for _ in range(40)).encode()
            for _ in range(30)]
    rarity = np.zeros(1 << 16, np.uint8)
    whole = Lines(raws, rarity, FINE)
    table = np.zeros(1 << 21, np.uint8)
    set_bits(table, (mix(whole.word[::500]) >> np.uint64(40)).astype(np.int64))
    some = Lines(raws, rarity, FINE, table)
    assert 0 < len(some.size) < len(whole.size) / 5
    at = np.searchsorted(whole.number, some.number)
    for name in ("number", "doc", "line", "size"):
        assert (getattr(some, name) == getattr(whole, name)[at]).all()
    assert (digests(raws, some.number) == digests(raws, whole.number)[at]).all()
    pick = np.concatenate([np.arange(whole.start[k], whole.start[k] + whole.size[k]) for k in at])
    assert (some.word == whole.word[pick]).all()
