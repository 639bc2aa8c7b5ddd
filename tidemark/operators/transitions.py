"""Next-item scoring from ordered histories: a first-order transition model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.order import following
from tidemark.operators.recommend import top_n, unseen
from tidemark.operators.sequences import last_n_per_user


def item_transitions(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """(item_id, next_item, moves, prob): how often users went from one item to the next."""
    steps = following(df.select("user_id", "item_id", *order), "user_id", order, ["item_id"])
    moves = (
        steps.filter(F.col("next_item_id").isNotNull())
        .groupBy("item_id", F.col("next_item_id").alias("next_item"))
        .agg(F.count(F.lit(1)).alias("moves"))
    )
    totals = moves.groupBy("item_id").agg(F.sum("moves").alias("_total"))
    return moves.join(totals, "item_id").withColumn("prob", F.col("moves") / F.col("_total")).drop("_total")


def next_item_scores(
    df: DataFrame, transitions: DataFrame, order: Sequence[str], max_len: int = 50, decay: float = 0.8
) -> DataFrame:
    """(user_id, item_id, score): sum of decay^age * prob over the user's last items.

    Only pairs some user moved between are touched. Scores are rounded to nine places
    so that the order of summation cannot change a rank.
    """
    tail = last_n_per_user(df.select("user_id", "item_id", *order), max_len, order)
    # A user's repeats of an item collapse to one weight before the fan-out.
    weights = tail.groupBy("user_id", "item_id").agg(F.sum(F.pow(F.lit(decay), F.col("age"))).alias("weight"))
    parts = weights.join(transitions.select("item_id", "next_item", "prob"), "item_id")
    return parts.groupBy("user_id", F.col("next_item").alias("item_id")).agg(
        F.round(F.sum(F.col("weight") * F.col("prob")), 9).alias("score")
    )


def next_item_recs(
    df: DataFrame,
    transitions: DataFrame,
    order: Sequence[str],
    n: int = 10,
    max_len: int = 50,
    decay: float = 0.8,
    users: DataFrame | None = None,
) -> DataFrame:
    """(user_id, rank, item_id, score) of unseen items, for all or the requested users."""
    wanted = df if users is None else df.join(users.select("user_id"), "user_id", "left_semi")
    scores = next_item_scores(wanted, transitions, order, max_len, decay)
    return top_n(unseen(scores, wanted), n)
