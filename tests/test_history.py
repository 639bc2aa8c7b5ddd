import pytest
from pyspark.sql import functions as F

from tidemark.operators import quality
from tidemark.operators.delta import snapshot_diff
from tidemark.sources.history import BucketedHistory, bucket_key

ROWS = [(1, 10, 4.0, 100), (2, 20, 3.0, 200), (None, 10, 4.0, 300), (3, None, 4.0, 400), (4, 40, 4.0, None), (None, None, 1.0, None)]
SCHEMA = "user_id long, item_id long, rating double, ts long"


@pytest.fixture
def rows(spark):
    return lambda values: spark.createDataFrame(values, SCHEMA)


def test_null_keys_match_and_repeats_stay(spark, rows, tmp_path):
    history = BucketedHistory(spark, str(tmp_path / "h"), rows(ROWS).schema, buckets=4)
    assert history.lacks(rows(ROWS)).count() == len(ROWS)  # nothing stored yet
    history.write(rows(ROWS[:4]), 1)
    history.write(rows(ROWS[4:]), 2)
    new = [(1, 10, 5.0, 101), (None, 10, 1.0, 301), (1, None, 1.0, 100), (1, None, 1.0, 100)]
    got = sorted(map(str, history.lacks(rows([*ROWS, *new])).collect()))
    assert got == sorted(map(str, snapshot_diff(rows([*ROWS, *new]), rows(ROWS)).collect())) and len(got) == 4
    assert history.lacks(rows(ROWS), before=2).count() == 2


def test_a_batch_is_replaced_and_opened_again(spark, rows, tmp_path):
    path, schema = str(tmp_path / "h"), rows(ROWS).schema
    history = BucketedHistory(spark, path, schema, buckets=3)
    history.write(rows(ROWS), 1)
    history.write(rows(ROWS[:2]), 2)
    history.write(rows(ROWS[:1]), 2)
    assert {r.batch_id: r["count"] for r in history.rows().groupBy("batch_id").count().collect()} == {1: 6, 2: 1}
    spark.sql(f"drop table {history.name}")  # as another session, which knows nothing of it
    again = BucketedHistory(spark, path, schema, buckets=3)
    assert again.rows().count() == 7 and again.lacks(rows(ROWS)).count() == 0


def test_the_diff_moves_only_the_batch(spark, rows, tmp_path):
    history = BucketedHistory(spark, str(tmp_path / "h"), rows(ROWS).schema, buckets=4)
    many = spark.range(5000).select(F.col("id").alias("user_id"), F.col("id").alias("item_id"), F.lit(4.0).alias("rating"), F.col("id").alias("ts"))
    history.write(many, 1)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        diff = history.lacks(many.filter("user_id < 50").withColumn("item_id", F.when(F.col("ts") == 7, 1).otherwise(F.col("item_id"))))
        assert [r.user_id for r in diff.collect()] == [7]
        plan = diff._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    final = plan.split("== Initial Plan ==")[0]
    assert "Bucketed: true" in final or "SelectedBucketsCount: 4 out of 4" in final
    assert final.count("Exchange hashpartitioning") == 1 and "ReadSchema: struct<ts:bigint,bucket_key:string>" in final


def test_keys_differ_where_their_text_would_not(spark):
    df = spark.createDataFrame([("1", "23"), ("12", "3"), (None, "-"), ("-", None), (None, None), ("", None)], "a string, b string")
    assert df.select(bucket_key(("a", "b")).alias("k")).distinct().count() == 6


DIRTY = [("1", "10", "4.0", "5"), ("1", "10", "4.0", "5"), ("x", "1", "9.0", "7"), (None, "1", "y", None)]


@pytest.mark.parametrize("columns", [("user_id", "item_id", "rating", "ts"), ("user_id", "item_id", "ts"), ("user_id",)])
def test_watched_checks_say_what_validate_says(spark, tmp_path, columns):
    batch = spark.createDataFrame(DIRTY, "user_id string, item_id string, rating string, ts string").select(*columns)
    watched = quality.WatchedBatch(batch)
    watched.rows.write.parquet(str(tmp_path / "b"))
    report = watched.report(spark.read.parquet(str(tmp_path / "b")))
    assert sorted(map(tuple, report.collect())) == sorted(map(tuple, quality.validate(batch).collect()))


def test_the_batch_is_computed_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(frames):
        for frame in frames:
            seen.add(len(frame))
            yield frame

    batch = spark.createDataFrame([(k, k, 4.0, k) for k in range(100)], SCHEMA).mapInPandas(count, SCHEMA)
    watched = quality.WatchedBatch(batch)
    watched.rows.write.parquet(str(tmp_path / "b"))
    quality.require_valid(watched.report(spark.read.parquet(str(tmp_path / "b"))))
    assert seen.value == 100
