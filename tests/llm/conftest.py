import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oddities import odd_rows  # noqa: E402

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]

SF = os.environ.get("LARKSPUR_SF_DIR", "/root/testdata/sf0.001")
SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, size bigint, h bigint, fp bigint, "
          "bucket int, block int, n bigint, words string, tag string, row string, line string, doc string, s string, "
          "slot int, next_text string, score double, _text string")


@pytest.fixture(scope="session")
def tables():
    if not os.path.isdir(SF):
        pytest.skip("no test tables")
    return SF


@pytest.fixture(scope="session")
def texts(spark, tables):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{tables}/documents.parquet").collect()}


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
