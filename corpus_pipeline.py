"""From documents to packed training sequences, stage by stage, with the operators of larkspur.llm.

Each stage gets a table with the columns of `documents`, works on all of it, and
leaves a table of the same columns; the last leaves packed pieces. Between two
stages the table is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.llm.catalog import tokenizer_file
from larkspur.llm.common import WORD, documents, written
from larkspur.llm.language_id import identify, learn
from larkspur.llm.line_dedup import dedup_lines
from larkspur.llm.mixing import repeat_rows
from larkspur.llm.packing import CAPACITY, pack_pieces, pieces_of
from larkspur.llm.simhash import keep_one
from larkspur.plans.shared import scratch_path, scratch_scope

#: share of a text's n-grams that its language has to explain; clean texts are far above it
LEAST_SCORE = 0.25
#: words whose ids a worker keeps; fewer than by default, for its process has served the stages before
CACHE_ROWS = 150_000


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a letter (null text included) and those that resemble no language in `lang`."""
    model = learn(docs.filter("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text"))
    known = identify(docs.select(F.struct(*docs.columns).alias("row")), model, ["row"], "row")
    return known.filter((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE)).select("row.*")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out lines that match an earlier one, and documents of which no word is left; n_chars follows the text."""
    out = dedup_lines(docs)
    cut = F.col("n_removed") > 0
    n_chars = F.when(cut, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return out.filter(~cut | F.col("text").rlike(WORD)).withColumn("n_chars", n_chars).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, that of the smallest doc_id, of all whose SimHashes two bits at most link."""
    return keep_one(docs).select(docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Brings sources to their target weights; a document that is taken twice is two rows."""
    return repeat_rows(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of every row."""
    return pack_pieces(written(pieces_of(docs, tokenizer_file("word_bpe_49k.json"), cache_rows=CACHE_ROWS)), CAPACITY)


STAGES = [("language_id", language), ("line_dedup", lines), ("simhash_near_dedup", near_duplicates),
          ("source_mix", mix), ("best_fit_packing", pack)]

#: tokenisers, components and the cube method are beyond SQL; tests/llm/test_pipeline.py holds stages and run() against plain Python
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. What a stage writes on its way is deleted when its own result is written."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        with scratch_scope(spark):
            out = stage(spark, docs, sf_dir)
            out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
