"""Interaction views over the supplied star-schema and event tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.session import configure
from tidemark.sources.schemas import KEY

EVENT_ORDER = ("ts", "tie")
# A user may meet an item twice in a second; these are two events, told apart by their ids.
EVENT_KEY = (*KEY, "tie")
LINE_TIE = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
LINE_ORDER = ("ts", *LINE_TIE)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_columns() -> list:
    return [
        F.col("event_id").alias("tie"),
        F.col("user_id"),
        F.get_json_object("props", "$.k").cast("bigint").alias("item_id"),
        (F.least(F.lit(10.0), F.greatest(F.lit(1.0), F.ceil(F.col("value") / 10).cast("double"))) / 2).alias("rating"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("ts"),
    ]


def event_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(tie, user_id, item_id, rating, ts) from ``events``; (ts, tie) is a total order."""
    return table(spark, sf_dir, "events").select(*event_columns())


def line_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The larger view, from ``lineitem`` and ``orders``; LINE_ORDER is a total order."""
    lines = table(spark, sf_dir, "lineitem").select(*LINE_TIE, "l_shipdate")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    return lines.join(orders, "l_orderkey").select(
        *LINE_TIE,
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("item_id"),
        (F.ceil(F.col("l_quantity") / 5).cast("double") / 2).alias("rating"),
        F.unix_seconds(F.col("l_shipdate").cast("timestamp")).alias("ts"),
    )


def part_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("item_id"),
        F.concat(F.col("p_name"), F.lit(" ("), (F.lit(1950) + F.col("p_size")).cast("string"), F.lit(")")).alias("title"),
        F.col("p_type").alias("genres"),
    )
