"""The registered queries of this subpackage, each over whole given tables, and their SQL where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.llm.common import documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql.strip()
        return fn
    return register


@query("op6_exact_dedup", """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)
""")
def op6_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    from larkspur.llm.exact_dedup import exact_dedup
    return exact_dedup(documents(spark, sf))


#: pages of hosts that carry one of these words make the list of the URL query
LISTED_HOSTS = r"pills|casino|bets|spam"


@query("op9_url_filter", r"""
WITH a AS (
  SELECT page_id, url,
    coalesce(translate(regexp_extract(url, '^[\s\S]*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '^[\s\S]*?://[^/?#]*([^?#]*)', 1), '') AS path,
    coalesce(regexp_extract(url, '^[^?#]*\?([^#]*)', 1), '') AS q
  FROM pages),
b AS (
  SELECT page_id, host, path,
    array_to_string(list_filter(string_split(q, '&'), lambda x: NOT regexp_matches(x, '^((utm_[^=]*|ref)(=|$)|$)')), '&') AS kept
  FROM a),
c AS (
  SELECT page_id, host, path, CASE WHEN host <> '' THEN regexp_replace(host, '^(www|m)\.', '')
    || regexp_replace(path, '/+$', '') || CASE WHEN kept <> '' THEN '?' || kept ELSE '' END END AS canon
  FROM b),
r(rh, rp, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
  ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
f AS (
  SELECT page_id, host, path, canon,
    (SELECT arg_max(rh || rp, length(rh || rp)) FROM r
     WHERE (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)) AS rule
  FROM c)
SELECT page_id, host, path, rule, coalesce(r.v,
  CASE WHEN canon IN (SELECT canon FROM c WHERE regexp_matches(host, 'pills|casino|bets|spam')) THEN 'block' ELSE 'allow' END) AS verdict
FROM f LEFT JOIN r ON f.rule = r.rh || r.rp
""")
def op9_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    from larkspur.llm.url_filter import host_of, judge_urls
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    return judge_urls(pages, pages.filter(host_of(F.col("url")).rlike(LISTED_HOSTS)).select("url"))


def tokenizer_file(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@query("op5_token_counts")
def op5_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    from larkspur.llm.token_counts import prefix_token_counts
    return prefix_token_counts(documents(spark, sf), tokenizer_file("byte_bpe_50k.json"), limit=1024, stored=False)


@query("op2_best_fit_packing")
def op2_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    from larkspur.llm.packing import pack_documents
    return pack_documents(documents(spark, sf), tokenizer_file("word_bpe_49k.json"))


@query("op7_language_id")
def op7_language_id(spark: SparkSession, sf: str) -> DataFrame:
    from larkspur.llm.language_id import language_of
    return language_of(documents(spark, sf))


@query("op1_source_mix")
def op1_source_mix(spark: SparkSession, sf: str) -> DataFrame:
    from larkspur.llm.mixing import mix_sources
    return mix_sources(documents(spark, sf)).select("doc_id", "size", "source_size", "target", "taken")


@query("op8_simhash")
def op8_simhash(spark: SparkSession, sf: str) -> DataFrame:
    from larkspur.llm.simhash import near_duplicates
    return near_duplicates(documents(spark, sf)).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query("op10_spotsigs")
def op10_spotsigs(spark: SparkSession, sf: str) -> DataFrame:
    from larkspur.llm.spotsigs import fingerprint_edits
    return fingerprint_edits(documents(spark, sf))


@query("op4_line_dedup", r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
s AS (
  SELECT doc_id, pos, list_distinct(regexp_extract_all(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+')) AS ws FROM l),
w AS (SELECT doc_id, pos, len(ws) AS n, unnest(ws) AS word FROM s),
c AS (SELECT *, count(*) OVER (PARTITION BY word) AS often FROM w),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, pos ORDER BY often, word) AS rn FROM c),
p AS (SELECT doc_id, pos, n, word FROM r WHERE rn <= n - ceil(n * 0.8 - 1e-9) + 1),
pairs AS (
  SELECT DISTINCT a.doc_id, a.pos, b.doc_id AS by_doc, b.pos AS by_pos FROM p a JOIN p b ON a.word = b.word
    AND (b.doc_id < a.doc_id OR (b.doc_id = a.doc_id AND b.pos < a.pos)) AND least(a.n, b.n) >= 0.8 * greatest(a.n, b.n) - 1e-9),
gone AS (
  SELECT DISTINCT x.doc_id, x.pos FROM (
    SELECT a.doc_id, a.pos, len(list_intersect(a.ws, b.ws)) AS shared, len(a.ws) + len(b.ws) AS n
    FROM pairs JOIN s a ON a.doc_id = pairs.doc_id AND a.pos = pairs.pos JOIN s b ON b.doc_id = by_doc AND b.pos = by_pos) x
  WHERE shared >= 0.8 * (n - shared) - 1e-9),
k AS (
  SELECT l.doc_id, count(*) AS n_lines, count(gone.pos) AS n_removed,
    coalesce(string_agg(line, chr(10) ORDER BY l.pos) FILTER (gone.pos IS NULL), '') AS kept
  FROM l LEFT JOIN gone ON l.doc_id = gone.doc_id AND l.pos = gone.pos GROUP BY l.doc_id)
SELECT doc_id, n_lines, n_removed, length(kept) AS kept_chars, sha256(kept) AS kept_sha256 FROM k
""")
def op4_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    from larkspur.llm.line_dedup import dedup_lines
    text = F.coalesce("text", F.lit(""))
    return dedup_lines(documents(spark, sf).select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_removed", F.length(text).cast("bigint").alias("kept_chars"),
        F.sha2(text, 256).alias("kept_sha256"))


@query("op3_suffix_tree")
def op3_suffix_tree(spark: SparkSession, sf: str) -> DataFrame:
    from larkspur.llm.suffix_tree import score_texts
    return score_texts(documents(spark, sf))


@query("op12_embedding_near", """
WITH RECURSIVE e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
ok AS (SELECT * FROM e WHERE len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  AND len(list_filter(v, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  AND list_cosine_similarity(a.v, b.v) >= 0.9),
r AS (SELECT vec_id, vec_id AS root FROM e UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.vec_id),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM l GROUP BY a),
c AS (SELECT vec_id, min(root) AS component_id FROM r GROUP BY vec_id)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept FROM c LEFT JOIN n USING (vec_id)
""")
def op12_embedding_near(spark: SparkSession, sf: str) -> DataFrame:
    from larkspur.llm.embedding_near import near_embeddings
    return near_embeddings(spark.read.parquet(f"{sf}/embeddings.parquet"))


@query("op13_token_alignment")
def op13_token_alignment(spark: SparkSession, sf: str) -> DataFrame:
    from larkspur.llm.alignment import align_digests
    return align_digests(documents(spark, sf), tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"))


@query("op11_collocations", r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
p AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
s AS (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM w, (VALUES (1), (2), (3), (4), (5)) v(k)),
f AS (SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase, count(*) AS f FROM s GROUP BY ALL),
n AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1 AND f >= 100),
cuts AS (SELECT lang, k, phrase, a, ws, unnest(range(1, k)) AS j FROM c),
sides AS (
  SELECT cuts.lang, cuts.phrase, a, j, x.f AS l, y.f AS r, n.n, (1000::HUGEINT * a * n.n) // (x.f::HUGEINT * y.f) AS score
  FROM cuts JOIN n ON n.lang = cuts.lang
  JOIN f x ON x.lang = cuts.lang AND x.phrase = array_to_string(ws[1:j], ' ')
  JOIN f y ON y.lang = cuts.lang AND y.phrase = array_to_string(ws[j + 1:], ' ')),
best AS (SELECT lang, phrase, a, l, r, n, score FROM sides
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
inner_words AS (SELECT lang, k, a, ws, unnest(range(1, k + 1)) AS i FROM c),
parts AS (SELECT lang, a, array_to_string(ws[i:i + m - 1], ' ') AS phrase FROM inner_words, (VALUES (2), (3), (4)) v(m)
  WHERE m < k AND i + m - 1 <= k),
held AS (SELECT lang, phrase, max(a) AS longer FROM parts GROUP BY ALL),
ranks AS (
  SELECT best.*, row_number() OVER (PARTITION BY best.lang ORDER BY score DESC, a DESC, best.phrase) AS rank
  FROM best LEFT JOIN held ON held.lang = best.lang AND held.phrase = best.phrase
  WHERE longer IS NULL OR 100 * longer < 100 * a)
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM ranks WHERE rank <= 2000
""")
def op11_collocations(spark: SparkSession, sf: str) -> DataFrame:
    from larkspur.llm.phrases import collocations
    return collocations(documents(spark, sf))
