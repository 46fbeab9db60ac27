"""Exact duplicates by a tree merge of sorted digest runs.

Every scan task makes runs of (digest, best id, count). A task's place is a
number in base FAN; in round r the tasks whose places differ in digit r only
exchange their runs, each keeping the digests whose r-th digit is its own. A
task merges what it receives, so after the last round it alone holds its slice
of the digests, and a digest that fills a third of all rows arrives as at most
FAN entries per merge, never as its rows.

Verification: entries are merged only if SHA-256, byte length and a second,
independent 64-bit hash all agree; entries that agree in SHA-256 alone stay apart.

Defined results: a null text counts as empty; a null doc_id is smaller than any
other; of repeated rows with the winning doc_id exactly one is kept; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import attach_weighted, split_for, text_of, written

FAN = 8
ROWS_A_TASK = 2_000_000
_KEY = ["digest", "n_bytes", "check"]
_RUN = "slot int, digest binary, n_bytes bigint, check bigint, id bigint, tag bigint, n bigint"
_ARROW = pa.schema([("slot", pa.int32()), ("digest", pa.binary()), ("n_bytes", pa.int64()), ("check", pa.int64()),
                    ("id", pa.int64()), ("tag", pa.int64()), ("n", pa.int64())])


def _merge_sorted(t: pa.Table) -> pa.Table:
    """One row per slot and key of a sorted table: its largest (id, tag), null ids last, and the sum of n."""
    if t.num_rows < 2:
        return t
    differs = np.zeros(t.num_rows - 1, bool)
    for name in ("slot", *_KEY):
        c = t[name].combine_chunks()
        differs |= pa.compute.not_equal(c[1:], c[:-1]).to_numpy(zero_copy_only=False)
    last = np.append(np.flatnonzero(differs), t.num_rows - 1)
    total = np.cumsum(t["n"].to_numpy())[last]
    out = t.take(pa.array(last))  # sorted by id and tag within a key, so the last is the best
    return out.set_column(out.schema.get_field_index("n"), "n", pa.array(np.diff(total, prepend=0)))


def _in_order(t: pa.Table) -> pa.Table:
    """Arrow sorts nulls to the end; within a key null ids have to come first."""
    keys = ["slot", *_KEY, "known", "id", "tag"]
    return t.append_column("known", pa.compute.is_valid(t["id"])).sort_by(
        [(k, "ascending") for k in keys]).drop_columns(["known"])


def _local_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield from _merge_sorted(_in_order(pa.Table.from_batches([b]).cast(_ARROW))).to_batches()


def _merge_stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merges runs that Spark's external sort has interleaved, holding one batch and one open key."""
    held = None
    for b in batches:
        t = pa.Table.from_batches([b]).cast(_ARROW)
        t = _merge_sorted(t if held is None else pa.concat_tables([held, t]))
        if t.num_rows:
            held = t.slice(t.num_rows - 1)
            yield from t.slice(0, t.num_rows - 1).to_batches()
    if held is not None:
        yield from held.to_batches()


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, tag (a number of the row), digest, n_bytes and a second hash of each text."""
    text = text_of(docs)
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.monotonically_increasing_id().alias("tag"),
        F.unhex(F.sha2(text, 256)).alias("digest"), F.octet_length(text).cast("bigint").alias("n_bytes"),
        F.xxhash64(text).alias("check"))


def merge_runs(rows: DataFrame, fan: int = FAN, rows_a_task: int = ROWS_A_TASK) -> DataFrame:
    """digest, n_bytes, check, id (the largest), tag and n: one row per distinct text."""
    spark = rows.sparkSession
    wanted = split_for(spark, rows.count(), rows_a_task)
    rounds = max(1, math.ceil(math.log(wanted, fan)))
    slots = fan ** rounds
    runs = rows.select(
        F.pmod(F.spark_partition_id(), F.lit(slots)).alias("slot"), *_KEY,
        F.col("doc_id").alias("id"), "tag", F.lit(1).cast("bigint").alias("n")).mapInArrow(_local_runs, _RUN)
    for r in range(rounds):
        step = fan ** r
        # the digest's own digits, from a part of it that is evenly spread
        digit = F.pmod(F.floor(F.conv(F.substring(F.hex("digest"), 1, 12), 16, 10).cast("bigint") / step), F.lit(fan))
        mine = F.pmod(F.floor(F.col("slot") / step), F.lit(fan))
        runs = (runs.withColumn("slot", (F.col("slot") + (digit - mine) * step).cast("int"))
                .repartition(slots, "slot")
                .sortWithinPartitions("slot", *_KEY, "id", "tag")
                .mapInArrow(_merge_stream, _RUN))
    return runs.drop("slot")


def exact_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row per document; of equal texts the largest doc_id stays."""
    rows = written(digests(docs))
    groups = written(merge_runs(rows).select(
        *_KEY, F.col("id").alias("keep_id"), F.col("tag").alias("keep_tag"), F.col("n").alias("group_size")))
    return attach_weighted(rows, groups, _KEY, "group_size").select(
        "doc_id", "keep_id", "group_size", (F.col("tag") == F.col("keep_tag")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))
