"""What the operators of this subpackage share: inputs, sizes and a join that hot keys cannot hurt."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.plans.shared import cut

WORD = r"[^\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: bytes.translate table that lower-cases A-Z and leaves every other byte alone
LOWER_AZ = bytes.maketrans(_UPPER.encode(), _LOWER.encode())


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def lower_az(c: Column) -> Column:
    return F.translate(c, _UPPER, _LOWER)


def text_of(df: DataFrame) -> Column:
    return F.coalesce(df["text"], F.lit(""))


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def split_for(spark: SparkSession, amount: float, each: float) -> int:
    """Tasks for `amount` of work at `each` a task, never under the session's own number."""
    return max(parts(spark), math.ceil(amount / each))


def hash01(*cols) -> Column:
    """A number in [0, 1) that depends on the columns only."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 11) / F.lit(float(1 << 53))


def attach_weighted(rows: DataFrame, facts: DataFrame, key: list[str], weight: str, share: int = 1000) -> DataFrame:
    """Inner join on unique `facts.key` where `weight` is the number of rows that carry the key.

    Keys with over 1/`share` of all weight number under `share`, whatever the
    data, so these are broadcast; the rest goes through an ordinary join in
    which no key has more than that share. Key columns hold no nulls.
    Both inputs are read twice: pass written tables.
    """
    total = facts.agg(F.coalesce(F.sum(weight), F.lit(0)).alias("total")).scalar()
    heavy = F.col(weight) * share > total
    hot = F.broadcast(facts.filter(heavy))
    on_hot = rows.join(hot, key)
    rest = rows.join(hot.select(*key), key, "left_anti").join(facts.filter(~heavy), key)
    return on_hot.unionByName(rest)


def held_out(doc_id: Column, folds: int) -> Column:
    """Whether crc32(doc_id as text) mod folds is 0; a null id counts as the empty text, which is held out."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(folds)) == 0


def id_bucket(docs: DataFrame, buckets: int) -> Column:
    """Ranges of doc_id of even width, 0 and up; null ids have as many buckets of their own, by text, below 0.

    Tables that are written in order of ids keep most of a bucket in one scan task.
    """
    span = docs.agg(F.min("doc_id").cast("bigint").alias("lo"), F.max("doc_id").cast("bigint").alias("hi")).first()
    low, width = span["lo"] or 0, ((span["hi"] or 0) - (span["lo"] or 0)) // buckets + 1
    return F.coalesce(F.floor((docs["doc_id"].cast("decimal(20,0)") - F.lit(low)) / F.lit(width)).cast("bigint"),
                      -1 - F.pmod(F.xxhash64(text_of(docs)), F.lit(buckets)))


class Memo(dict):
    """`fn(key)` for every key looked up, kept until `most` are there; then it starts anew."""

    def __init__(self, fn, most: int):
        super().__init__()
        self.fn, self.most = fn, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        self[key] = value = self.fn(key)
        return value


def written(df: DataFrame) -> DataFrame:
    """`df` as a table in the shared folder: no lineage, and safe when executors go."""
    return cut(df)
