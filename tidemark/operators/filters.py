"""Row filters over interactions and items."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.columns import release_year


def positive(df: DataFrame, min_rating: float = 3.5) -> DataFrame:
    return df.filter(F.col("rating") >= F.lit(min_rating))


def with_release_year(items: DataFrame, min_year: int = 1970) -> DataFrame:
    """Items whose title ends in a year of at least ``min_year``."""
    return items.withColumn("year", release_year(F.col("title"))).filter(F.col("year") >= min_year)


def in_catalog(df: DataFrame, items: DataFrame) -> DataFrame:
    """Rows whose item is in ``items``; Spark broadcasts the key column if it is small."""
    return df.join(items.select("item_id"), "item_id", "left_semi")


def complete_rows(df: DataFrame, columns: Sequence[str] = ("rating", "ts")) -> DataFrame:
    """Project to ``columns`` and drop rows with any NULL."""
    return df.select(*columns).na.drop()


def of_users(df: DataFrame, users: DataFrame) -> DataFrame:
    """Histories of the requested users."""
    return df.join(users.select("user_id"), "user_id", "left_semi")


def active_users(df: DataFrame, min_count: int = 5) -> DataFrame:
    """Rows of users with at least ``min_count`` rows.

    Counts are pre-aggregated and joined back, so a hot user's rows need not meet in
    one task: adaptive execution splits that join.
    """
    sizes = df.groupBy("user_id").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= min_count)
    return df.join(sizes.select("user_id"), "user_id", "left_semi")
