"""The suffix tree against one made of Python dicts, its growth, and how its texts are dealt out."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

from larkspur.llm.suffix_tree import DIVERGENCE, PRIOR, SPREAD, block_table, grow, score_texts

END = None
WORDS = re.compile(r"[^\x20\x09-\x0D]+").findall


def prose(n: int, seed: int = 5) -> list[tuple[int, str]]:
    """Texts in which the next word depends on one, two or three words before it."""
    draw = random.Random(seed)
    out = []
    for i in range(n):
        words = []
        for _ in range(draw.randrange(0, 60)):
            last = tuple(words[-draw.choice((1, 2, 3)):])
            fixed = draw.random() < 0.6 and last
            words.append(f"w{random.Random(repr(last)).randrange(25) if fixed else draw.randrange(25)}")
        out.append((i, " ".join(words).upper() if i % 7 == 0 else "\n".join(words)))
    return out


class Tree:
    def __init__(self, rows, depth, least):
        self.rows = {i: [*WORDS((t or "").lower()), END] for i, t in rows}
        self.held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in self.rows}
        train = [ws for i, ws in self.rows.items() if not self.held[i]]
        self.c = Counter(w for ws in train for w in ws)
        self.n = sum(self.c.values())
        once, twice = (sum(x == k for x in self.c.values()) for k in (1, 2))
        self.discount = once / (once + 2 * twice) if once and twice else 0.5
        follow = defaultdict(Counter)
        for ws in train:
            before = [END, *ws]
            for k, w in enumerate(ws):
                for d in range(1, depth + 1):
                    if k >= d - 1:
                        follow[tuple(before[k + 1 - d:k + 1])][w] += 1
        self.follow, self.kept = follow, set()
        for run in sorted((r for r in follow if sum(follow[r].values()) >= least), key=len):
            total, gain = sum(follow[run].values()), 0.0
            for w, n in follow[run].items():
                p = self.p(run[1:], w)
                gain += n * (math.log((n - 1 + PRIOR * p) / (total - 1 + PRIOR)) - math.log(p))
            if gain > DIVERGENCE:
                self.kept.add(run)

    def p(self, run, w):
        if not run:
            return (self.c[w] - self.discount if self.c[w] else self.discount * len(self.c)) / self.n
        p = self.p(run[1:], w)
        if run not in self.kept:
            return p
        return (self.follow[run][w] + PRIOR * p) / (sum(self.follow[run].values()) + PRIOR)

    def score(self, i, depth):
        before = [END, *self.rows[i]]
        return sum(math.log10(self.p(tuple(before[max(0, k + 1 - depth):k + 1]), w)) for k, w in enumerate(self.rows[i]))


def test_scores_are_those_of_a_plain_tree(spark):
    rows = prose(1500)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    tree = Tree(rows, 3, 20)
    assert {len(r) for r in tree.kept} == {1, 2, 3}
    got = {r["doc_id"]: r for r in score_texts(docs, 3, 20, block_bytes=4000).collect()}
    assert set(got) == set(tree.rows)
    for i, r in got.items():
        want = tree.score(i, 3)
        assert abs(r["score"] - want) <= 1e-9 * max(1, abs(want)), i
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (tree.held[i], len(tree.rows[i]), tree.n)


def test_every_state_of_the_plain_tree_is_a_distribution():
    tree = Tree(prose(600), 3, 20)
    for run in tree.kept:
        assert abs(sum(tree.p(run, w) for w in [*tree.c, "unknown"]) - 1) < 1e-9


def test_blocks_do_not_change_scores(spark):
    docs = spark.createDataFrame(prose(800), "doc_id long, text string")
    few, many = ({r["doc_id"]: r["score"] for r in score_texts(d, least_context=20, block_bytes=size).collect()}
                 for d, size in ((docs.coalesce(1), 1 << 24), (docs.repartition(9), 1500)))
    assert all(abs(few[i] - many[i]) < 1e-9 * max(1, abs(few[i])) for i in few)


def test_contexts_grow_with_the_corpus(spark, tables):
    """The floor is a number of occurrences: more texts, more runs asked for at every level."""
    docs = spark.read.parquet(f"{tables}/documents.parquet")

    def levels(part):
        _, told = grow(block_table(part, 10, 1 << 24, 4), 2, 32, DIVERGENCE, 2)
        return {r["kind"]: r["words"] for r in told.groupBy("kind").agg({"words": "sum"}).toDF("kind", "words").collect()}

    half, whole = levels(docs.filter("doc_id % 2 = 0")), levels(docs)
    assert all(whole[k] > 1.2 * half[k] for k in (0, 2, 4))


def test_one_far_off_id_and_equal_rows_are_dealt_out(spark):
    """Blocks are filled row by row, whatever ids and texts are."""
    rows = [(None, "the same words over and over")] * 3000 + [(i, f"text {i}") for i in range(100)] + [(1 << 60, "far")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(20)
    state = block_table(docs, 10, 4000, 4)
    sizes = [len(r["doc_ids"]) for r in state.select("doc_ids").collect()]
    assert sum(sizes) == len(rows) and max(sizes) < len(rows) / 10
    assert state.select("block").distinct().count() == len(sizes)
    assert score_texts(docs, block_bytes=4000).count() == len(rows)


def test_only_answers_are_shuffled(spark):
    from larkspur.llm.suffix_tree import meeting
    docs = spark.createDataFrame(prose(50), "doc_id long, text string")
    state = block_table(docs, 10, 1 << 20, 4)
    told = spark.createDataFrame([], "block long, kind int, range long, told binary")
    plan = meeting(state, told, lambda a, b: a, "block long")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_askings_of_runs_are_small(spark):
    """a run costs its word's number and a share of its context's hash; hot contexts are dealt to several ranges."""
    from larkspur.llm.suffix_tree import ask, asked_keys, followed, mix, runs_of, whole
    rng = np.random.default_rng(3)
    contexts = mix(np.arange(1, 3001, dtype=np.uint64))
    which = np.minimum(rng.zipf(1.3, 200_000) - 1, 2999)
    word = np.minimum(rng.zipf(1.3, 200_000) - 1, 99_999)
    total = np.where(which == 0, 5 * SPREAD, 1000)
    runs, at = runs_of(contexts[which], word, total)
    out = ask(2, 7, runs.one_of(at), runs.total(np.ones(len(word), np.int64)), 3, runs.one_of(word))
    keys = np.concatenate([asked_keys(x.as_py()) for x in out.column(3)])
    assert (keys == followed(runs.one_of(at), runs.one_of(word).astype(np.uint64))).all() and len(np.unique(keys)) == len(keys)
    pairs = Counter(zip(which.tolist(), word.tolist()))
    counted = np.concatenate([whole(x.as_py())[0] for x in out.column(4)])
    assert sorted(counted.tolist()) == sorted(pairs.values())
    assert len(set(at[which == 0].tolist())) == 6 and all((at[which == k] == contexts[k]).all() for k in range(1, 50))
    assert sum(len(x.as_py()) for c in (3, 4) for x in out.column(c)) < 5 * len(keys)  # 12 bytes as a hash and a count


def test_runs_whose_order_is_equal_stay_apart():
    """Hashes that differ in low bits only, with the same word: counts are of either run."""
    from larkspur.llm.suffix_tree import ask, asked_keys, runs_of, whole
    context = np.array([1 << 40, (1 << 40) + 1, 1 << 40, (1 << 40) + 1], np.uint64)
    runs, at = runs_of(context, np.array([9, 9, 9, 200]), np.full(4, 40))
    out = ask(2, 0, runs.one_of(at), runs.total(np.ones(4, np.int64)), 0, runs.one_of(np.array([9, 9, 9, 200])))
    found = Counter()
    for k, n in zip(asked_keys(out.column(3)[0].as_py()).tolist(), whole(out.column(4)[0].as_py())[0].tolist()):
        found[k] += n
    assert sorted(found.values()) == [1, 1, 2]


def test_told_answers_are_not_shuffled_again(spark):
    """blocks and answers are bucketed alike, so a step's meeting has no exchange."""
    from larkspur.llm.suffix_tree import meeting
    state = block_table(spark.createDataFrame(prose(200), "doc_id long, text string"), 10, 1000, 4)
    _, told = grow(state, 1, 20, DIVERGENCE, 2, 4)
    plan = meeting(state, told, lambda a, b: a, "block long")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_contexts_are_told_by_their_places(spark, tables):
    """a context costs its place in a range, not a hash, and only runs seen twice cost a number for the gain."""
    from larkspur.llm.suffix_tree import _met, ask, visit
    state = block_table(spark.read.parquet(f"{tables}/documents.parquet"), 10, 1 << 20, 4)
    root, told = grow(state, 2, 16, DIVERGENCE, 2, 4)
    mine = state.toArrow().slice(0, 1)
    number, block, known = _met(mine, told.filter(told["block"] == mine["block"][0].as_py()).toArrow())

    def asked(step):
        out = {}
        for kind, keys, amounts, word in visit(block, known, step, 2, 16, root, 2):
            got = ask(kind, number, keys, amounts, 2, word)
            out[kind] = len(keys), *(sum(len(x.as_py()) for x in got.column(c)) for c in (3, 4))
        return out

    n, keys, _ = asked(2)[3]
    assert n > 300 and keys < 4 * n  # 756 bytes for 417 contexts; 3,628 as hashes
    n, keys, _ = asked(3)[5]
    assert n > 80 and keys < 10 * n  # with what four small rows cost besides: 780 bytes for 107; 1,356 as hashes


def test_keys_of_places_are_distinct():
    """Places that do not fit their bits of a key are told apart by a hash, and ranges are the top bits of the others."""
    from larkspur.llm.suffix_tree import PLACE_BITS, numbered
    for bits in (0, 3, 12):
        part = np.repeat(np.arange(1 << bits), 4)
        place = np.tile([0, 1, (1 << PLACE_BITS) - 1, 1 << PLACE_BITS], 1 << bits)
        keys = numbered(part, place, bits)
        assert len(np.unique(keys)) == len(keys)
        near = place >> PLACE_BITS == 0
        assert not bits or ((keys >> np.uint64(64 - bits)).astype(int) == part)[near].all()
        assert (np.diff(keys[near].astype(object)) > 0).all()


def test_gains_are_sums_over_all_blocks():
    """Runs seen once are only counted; one block tells how often the context occurs."""
    from larkspur.llm.suffix_tree import ask, asked_gains
    amounts = np.array([[3, 0, 1, 0], [40, 0, 0, 7], [0, 2.5, -1.25, 0]])
    out = ask(3, 0, np.arange(4, dtype=np.uint64), amounts, 0)
    assert (asked_gains(out.column(4)[0].as_py()) == amounts).all()
