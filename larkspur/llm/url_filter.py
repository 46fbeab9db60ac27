"""URL verdicts: prefix rules first, then a list of URLs behind a blocked Bloom filter.

The filter is an array of 64-bit words, one word a block: a canonical URL
belongs to one word and sets PROBES bits in it. Its size is bounded by
`max_words`, whatever the list; a fuller filter only passes more candidates.
URLs that it passes meet the list in an exact hash join, so no false positive
is left. Everything is DataFrame functions.

Defined results: a null URL, or one without "://", has an empty host and path,
fits no rule and is not listed; repeated pages give repeated rows; an empty
table gives no rows; nulls in the list are skipped; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import attach_weighted, lower_az, written

#: (host, path, verdict); a rule fits its host and all subdomains
RULES = [
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"), ("com", "/de/", "block")]
PROBES = 6
BITS_A_KEY = 16
MAX_WORDS = 1 << 17  # 1 MB


def host_of(url: Column) -> Column:
    return F.coalesce(lower_az(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without a www. or m. label, path without closing slashes, query without tracking keys; null if there is no host."""
    host = F.regexp_replace(host_of(url), r"^(www|m)\.", "")
    path = F.regexp_replace(path_of(url), r"/+$", "")
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    kept = F.array_join(F.filter(F.split(query, "&"), lambda p: ~p.rlike(r"^((utm_[^=]*|ref)(=|$)|$)")), "&")
    return F.when(host != "", F.concat(host, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(F.lit(""))))


def _word_and_mask(url: Column, words: int) -> tuple[Column, Column]:
    h, g = F.xxhash64(url, F.lit(1)), F.xxhash64(url, F.lit(2))
    bits = [F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftrightunsigned(g, 6 * i).bitwiseAND(F.lit(63)).cast("int"))
            for i in range(PROBES)]
    return F.pmod(h, F.lit(words)).cast("int"), reduce(lambda a, b: a.bitwiseOR(b), bits)


def bloom_words(urls: DataFrame, words: int) -> DataFrame:
    """One row `filter`: the words of the filter over the column `canon`, first to last. At most MAX_WORDS longs."""
    word, mask = _word_and_mask(F.col("canon"), words)
    set_words = urls.select(word.alias("word"), mask.alias("mask")).groupBy("word").agg(F.bit_or("mask").alias("mask"))
    every = urls.sparkSession.range(words).select(F.col("id").cast("int").alias("word"), F.lit(0).cast("bigint").alias("mask"))
    full = set_words.union(every).groupBy("word").agg(F.bit_or("mask").alias("mask"))
    return full.agg(F.array_sort(F.collect_list(F.struct("word", "mask"))).alias("w")).select(F.col("w.mask").alias("filter"))


def listed(pages: DataFrame, urls: DataFrame, bits_a_key: int = BITS_A_KEY, max_words: int = MAX_WORDS) -> DataFrame:
    """`pages` (with a column `canon`) plus `listed`: whether canon is among the distinct rows of `urls.canon`."""
    urls = written(urls.filter("canon IS NOT NULL").select("canon").distinct())
    words = min(max_words, max(64, 1 << (urls.count() * bits_a_key // 64).bit_length()))
    table = written(bloom_words(urls, words))
    word, mask = _word_and_mask(F.col("canon"), words)
    probe = table.scalar()
    hit = F.element_at(probe, word + 1).bitwiseAND(mask) == mask
    flagged = written(pages.withColumn("maybe", F.coalesce(hit, F.lit(False))))
    maybe = flagged.filter("maybe")
    # the exact join runs on distinct candidates; the rows then meet verdicts that are one row per URL
    found = (maybe.groupBy("canon").agg(F.count(F.lit(1)).alias("n"))
             .join(urls.withColumn("listed", F.lit(True)), "canon", "left"))
    verdicts = written(found.select("canon", "n", F.coalesce("listed", F.lit(False)).alias("listed")))
    sure = attach_weighted(maybe, verdicts, ["canon"], "n").drop("n", "maybe")
    return flagged.filter("NOT maybe").drop("maybe").withColumn("listed", F.lit(False)).unionByName(sure)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule as text, and its verdict; nulls if none fits. Of equally long rules a block comes first."""
    rule = verdict = F.lit(None).cast("string")
    ranked = sorted(rules, key=lambda r: (len(r[0] + r[1]), r[2] == "block", r[0] + r[1]))
    for h, p, v in ranked:
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, F.lit(h + p)).otherwise(rule)
        verdict = F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def judge_urls(pages: DataFrame, urls: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict. `urls` has a column url: what no rule judges is blocked if it is listed there."""
    url = F.col("url")
    seen = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), canonical(url).alias("canon"))
    marked = listed(seen, urls.select(canonical(F.col("url")).alias("canon")))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))
    return marked.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"))
