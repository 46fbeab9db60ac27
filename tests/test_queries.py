"""Every registered query against its SQL, and the driver contract."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as entry_point  # noqa: E402
from compare import difference, oracle  # noqa: E402
from larkspur.catalog import QUERIES  # noqa: E402

SF = os.environ.get("LARKSPUR_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return oracle(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert difference(spark, con, SF, name) is None


def test_every_sql_has_a_query():
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.columns[:2] == ["version_id", "label"] and df.count() > 0


@pytest.mark.parametrize("name", ["allocate_budget", "stratified_split", "quota_sample", "default_threshold",
                                  "status_transitions", "mine_similar"])
@pytest.mark.parametrize("partitions", ["1", "200"])
def test_results_do_not_depend_on_partitioning(spark, con, name, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        assert difference(spark, con, SF, name) is None
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
