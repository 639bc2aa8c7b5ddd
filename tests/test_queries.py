"""Every registered query against its SQL twin, and layout independence."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import check

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def database():
    return check.database(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, database, name):
    got = QUERIES[name](spark, SF_DIR).toPandas()
    if name in ORACLES:
        assert check.differences(got, database.execute(ORACLES[name]).df()) is None
    else:
        assert len(got)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", ["global_split", "masked_sequences", "item_transitions", "next_item_recs", "drift_ks"])
def test_result_does_not_depend_on_the_partition_count(spark, name):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    results = []
    try:
        for count in ("1", "8"):
            spark.conf.set("spark.sql.shuffle.partitions", count)
            results.append(QUERIES[name](spark, SF_DIR).toPandas())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert check.differences(*results) is None


def test_entry(spark):
    assert entry.entry(spark).filter(F.col("split") == "test").count() > 0
    assert duckdb.__version__
