"""Cross-tokenizer alignment against two plain pointers and the tokenizers' own libraries."""

import hashlib
from collections import Counter, defaultdict

import pytest

from larkspur.llm.alignment import align_digests, align_tokens
from larkspur.llm.catalog import QUERIES, tokenizer_file

A, B = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def spell():
    """Of a text: ids and bytes of the tokens of A and B; no tokens where they do not spell it."""
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letter = {chr(x): x for x in plain} | {chr(256 + k): x for k, x in enumerate(x for x in range(256) if x not in plain)}

    def piece(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()

    def both(text):
        if not text:
            return [], []
        ids = a.encode(" " + text, add_special_tokens=False).ids
        x = [(i, bytes(letter[c] for c in a.id_to_token(i))) for i in ids]
        y = [(i, piece(i)) for i in b.encode(text)]
        raw = (" " + text).encode()
        return (x, y) if b"".join(t for _, t in x) == raw == b"".join(t for _, t in y) else ([], [])
    return both


def plain(both, texts):
    """Rows of the contract for texts, one by one."""
    done, holders = [], defaultdict(set)
    for k, text in enumerate(texts):
        x, y = both(text)
        spans = []
        for tokens in (x, y):
            at, own = 0, []
            for i, t in tokens:
                own.append((i, at, at + len(t)))
                at += len(t)
            spans.append(own)
        links, i, j = [], 0, 0
        while i < len(x) and j < len(y):
            links.append((spans[0][i][0], spans[1][j][0]))
            end_a, end_b = spans[0][i][2], spans[1][j][2]
            i, j = i + (end_a <= end_b), j + (end_b <= end_a)
        cuts = sorted({s[2] for s in spans[0]} & {s[2] for s in spans[1]})
        groups = []
        for low, high in zip([0, *cuts], cuts):
            groups.append("|".join(",".join(str(t) for t, a, b in own if low <= a and b <= high) for own in spans))
        done.append((len(x), len(y), len(cuts), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if x else ""))
        for link in set(links):
            holders[link].add(k)
    count = {link: len(h) for link, h in holders.items()}
    best = Counter()
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    return [(n_a, n_b, n_g, len(links), sum(count[x] == best[x[0]] for x in links), sum(count[x] for x in links), sha)
            for n_a, n_b, n_g, links, sha in done]


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def test_query(spark, tables, texts, spell):
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in QUERIES["op13_token_alignment"](spark, tables).collect()}
    assert got == dict(zip(texts, plain(spell, texts.values())))


ODD = ["", None, "a", " ", "  two  spaces ", "a▁b", "café ééé \U0001f600\U0001f600 naïve", "tab\there\nand\r\nthere\n\n\n",
       "<s> </s> <unk> <0x41> <|endoftext|>", "x" * 3000, "nul \x00 byte", "　wide", "你好世界", "1234567890 " * 50,
       "the same words", "the same words", "\n" * 12000 + "x", "don't can't we'll I'm", " sep\u0085", "á̀"]


@pytest.mark.parametrize("block_bytes", [1, 60, 1 << 20])
def test_odd_texts(spark, spell, block_bytes):
    rows = [(k, t, "x", 1) for k, t in enumerate(ODD)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, pairs string, block int").repartition(2)
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in align_digests(docs, A, B, block_bytes).collect()}
    assert got == dict(enumerate(plain(spell, ODD)))


def test_links_and_cuts(spark, spell):
    docs = spark.createDataFrame(list(enumerate(ODD)), "doc_id int, text string").repartition(2)
    for r in align_tokens(docs, A, B).collect():
        x, y = spell(ODD[r["doc_id"]])
        assert (r["a_ids"], r["b_ids"]) == ([i for i, _ in x], [i for i, _ in y])
        start_a, start_b = [0, *r["a_ends"]], [0, *r["b_ends"]]
        assert r["cuts"] == sorted(set(r["a_ends"]) & set(r["b_ends"]))
        if len(x) > 1000:
            continue
        overlap = [(i, j) for i in range(len(x)) for j in range(len(y))
                   if start_a[i] < r["b_ends"][j] and start_b[j] < r["a_ends"][i]]
        assert list(zip(r["link_a"], r["link_b"])) == overlap


def test_repeated_and_missing_ids(spark, spell):
    rows = [(1, "one two"), (1, "three"), (None, "one two"), (None, None)]
    got = align_digests(spark.createDataFrame(rows, "doc_id bigint, text string"), A, B).collect()
    want = plain(spell, [t for _, t in rows])
    assert sorted(((r["doc_id"], *(r[c] for c in COLUMNS)) for r in got), key=repr) == sorted(
        ((i, *w) for (i, _), w in zip(rows, want)), key=repr)


def test_empty(spark, empty):
    assert align_digests(empty, A, B).count() == 0
