"""SpotSigs document fingerprints: chains of content words that follow common words.

Every common word (an anchor) is a spot; its signature is the anchor with the
next CHAIN content words, common words between them skipped. A fingerprint is the
sorted set of 32-bit signature hashes as hexadecimal text, so it holds the whole
set. Likeness is the Jaccard coefficient of two sets. Two sets can only be alike
by the ratio of their sizes, so sets are put into size classes; `likeness` with a
bar first compares that ratio and leaves the sets alone if it is below.
Everything is DataFrame functions.

Defined results: a null text counts as empty; a text without a signature has one
signature, the hash of all of it, so equal texts stay alike and no others do;
of documents with equal ids the one with the larger text hash comes first, null
ids come last; repeated rows follow one another as documents of their own; a
table of one row is followed by itself; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.llm.common import id_bucket, text_of, written

#: common words of English, German, French and Spanish
ANCHORS = ("a", "and", "are", "as", "be", "by", "for", "from", "in", "is", "it", "of", "on", "that", "the", "this", "to",
           "was", "with", "das", "den", "der", "die", "ist", "und", "von", "zu", "au", "de", "des", "du", "en", "est", "et",
           "la", "le", "les", "pour", "que", "un", "une", "con", "el", "los", "por", "se", "y")
CHAIN = 2
ROWS_A_BUCKET = 2000
MOST_BUCKETS = 100_000


def signatures(text: Column, anchors: Sequence[str] = ANCHORS, chain: int = CHAIN) -> Column:
    """Sorted distinct signature hashes of a text, 0 to 2^32 - 1; never empty."""
    words = F.concat(F.lit(" "), F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "), F.lit(" "))
    marked = F.regexp_replace(words, f" (?=(?:{'|'.join(anchors)}) )", " *")
    # possessive quantifiers: the engine recurses for others, and a text may be anchors for pages
    spots = F.regexp_extract_all(
        marked, F.lit(r"(?=( \*[^ ]++(?:(?: \*[^ ]++)*+ [^ *][^ ]*+){%d}+ )) " % chain), F.lit(1))
    low = lambda c: F.xxhash64(c).bitwiseAND(F.lit(0xFFFFFFFF))
    found = F.transform(spots, lambda m: low(F.regexp_replace(m, r"(?<=[^ ]) \*[^ ]+", "")))
    return F.array_sort(F.array_distinct(F.when(F.size(spots) > 0, found).otherwise(F.array(low(F.concat(F.lit("*"), text))))))


def as_text(sigs: Column) -> Column:
    return F.array_join(F.transform(sigs, lambda x: F.lower(F.lpad(F.hex(x), 8, "0"))), "")


def size_class(sigs: Column, bar: float = 0.8) -> Column:
    """Sets with a likeness of `bar` or more are in the same class or in neighbouring ones."""
    return F.floor(F.ln(F.size(sigs).cast("double")) / -math.log(bar)).cast("int")


def likeness(a: Column, b: Column, bar: float = 0.0) -> Column:
    """Jaccard coefficient; if the sizes show that it is below `bar`, 0 without looking at the sets."""
    n, m = F.size(a), F.size(b)
    both = F.size(F.array_intersect(a, b))
    return F.when(F.least(n, m) < F.greatest(n, m) * bar, F.lit(0.0)).otherwise(both / (n + m - both))


def with_next(docs: DataFrame, rows_a_bucket: int = ROWS_A_BUCKET, most_buckets: int = MOST_BUCKETS) -> DataFrame:
    """doc_id, text, next_text: the text of the next document in descending order of ids, after the last the first.

    Ids are cut into buckets of even width, so that one shuffle of the texts
    does; only the last document of a bucket looks into another one. Null ids
    have buckets of their own, spread by the text.
    """
    buckets = max(1, min(most_buckets, math.ceil(docs.count() / rows_a_bucket)))
    text = text_of(docs)
    h, bucket = F.xxhash64(text), id_bucket(docs, buckets)
    rows = docs.select(docs["doc_id"].alias("doc_id"), text.alias("text"), h.alias("h"), bucket.alias("bucket"))
    order = Window.partitionBy("bucket").orderBy(F.col("doc_id").desc_nulls_last(), F.col("h").desc())
    staged = rows.select("doc_id", "bucket", "text", F.lead("text").over(order).alias("next_text"),
                         F.row_number().over(order).alias("turn"))
    # at most `most_buckets` rows, twice that with null ids
    known = rows.select("bucket").distinct()
    after = written(known.select("bucket", F.coalesce(
        F.lead("bucket").over(Window.partitionBy().orderBy(F.col("bucket").desc())),
        F.max("bucket").over(Window.partitionBy())).alias("after")))
    firsts = staged.filter("turn = 1").select(F.col("bucket").alias("after"), F.col("text").alias("first_text"))
    crossing = (staged.filter("next_text IS NULL").select("doc_id", "bucket", "text")
                .join(after, "bucket").join(firsts, "after").select("doc_id", "text", F.col("first_text").alias("next_text")))
    return staged.filter("next_text IS NOT NULL").select("doc_id", "text", "next_text").unionByName(crossing)


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, size_class.

    The edited text ends, in its last third, with the beginning of the next document.
    """
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - third), F.substring("next_text", F.lit(1), third))
    rows = with_next(docs).select("doc_id", "text", edited.alias("edited"), "next_text")
    sigs = rows.select("doc_id", n.cast("bigint").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
                       signatures(F.col("text")).alias("a"), signatures(F.col("edited")).alias("b"),
                       signatures(F.col("next_text")).alias("c"))
    return sigs.select("doc_id", "n_chars", "edited_sha256", as_text(F.col("a")).alias("fingerprint"),
                       as_text(F.col("b")).alias("edited_fingerprint"),
                       likeness(F.col("a"), F.col("b")).alias("near_edited"),
                       likeness(F.col("a"), F.col("c")).alias("near_next"), size_class(F.col("a")).alias("size_class"))
