"""Exchanges of a query do not stay on disk once it has ended."""

from pathlib import Path

from pyspark.sql import functions as F

from tidemark.session import configure, work_path


def _exchanges(spark):
    root = Path(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()[0])
    return {p.name for p in root.rglob("shuffle_*.data")}


def test_a_stored_table_leaves_no_exchange(spark):
    configure(spark)
    before = _exchanges(spark)
    counted = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    counted.write.parquet(work_path(spark, "counted"))
    assert not _exchanges(spark) - before


def test_a_query_can_be_run_again(spark):
    counted = configure(spark).range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    assert sorted(counted.collect()) == sorted(counted.collect()) and counted.count() == 7
