"""Per-batch volume, audience and novelty, and the retraining decision."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.functions.columns import DAY_SECONDS


def batch_monitoring(batches: DataFrame) -> DataFrame:
    """Per ``batch_id``: interactions, active users and items, and those seen first there.

    Everything is counted from (batch, user) and (batch, item) groups that combine
    before the shuffle, so a hot user or item is one row per task.
    """
    volume = batches.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("num_interactions"), F.avg("rating").alias("mean_rating")
    )
    out = volume
    for key, name in (("user_id", "users"), ("item_id", "items")):
        present = batches.select("batch_id", key).distinct()
        active = present.groupBy("batch_id").agg(F.count(F.lit(1)).alias(f"active_{name}"))
        first = present.groupBy(key).agg(F.min("batch_id").alias("batch_id"))
        new = first.groupBy("batch_id").agg(F.count(F.lit(1)).alias(f"new_{name}"))
        # One row per batch on every side.
        out = out.join(active, "batch_id", "left").join(new, "batch_id", "left")
    return out.na.fill(0, ["active_users", "new_users", "active_items", "new_items"])


def rating_histogram(batches: DataFrame) -> DataFrame:
    return batches.groupBy("batch_id", "rating").agg(F.count(F.lit(1)).alias("num_ratings"))


def retrain_trigger(
    monitoring: DataFrame,
    metadata: DataFrame,
    drift: DataFrame,
    degraded: DataFrame,
    schedule_days: int = 14,
    min_new_rows: int = 1000,
) -> DataFrame:
    """Per batch: due by schedule, enough new rows, drift, degradation, and any of them.

    Inputs have one row per batch. A batch is due when its data starts at least
    ``schedule_days`` after the previous batch started; the first one always is.
    """
    in_time = Window.orderBy("batch_id")
    started = F.col("earliest_timestamp")
    waited = started - F.lag(started).over(in_time)
    due = metadata.select(
        "batch_id", F.coalesce(waited >= schedule_days * DAY_SECONDS, F.lit(True)).alias("schedule_due")
    )
    joined = (
        monitoring.select("batch_id", (F.col("num_interactions") >= min_new_rows).alias("enough_rows"))
        .join(due, "batch_id", "left")
        .join(drift.select("batch_id", "drift_detected"), "batch_id", "left")
        .join(degraded.select("batch_id", "degraded"), "batch_id", "left")
        .na.fill(False, ["schedule_due", "drift_detected", "degraded"])
    )
    any_of = F.col("schedule_due") | F.col("enough_rows") | F.col("drift_detected") | F.col("degraded")
    return joined.withColumn("retrain", any_of)
