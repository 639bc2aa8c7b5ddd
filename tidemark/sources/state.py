"""One-row release state and the append-only metric log, kept as small tables."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.sources.files import path_exists
from tidemark.sources.schemas import METRIC_LOG, RELEASE_STATE


@dataclass(frozen=True)
class ReleaseState:
    last_released_batch: int = 0
    last_released_timestamp: str = ""
    total_ratings_released: int = 0
    dataset_version: str = "ml-latest-small"

    def high_water_mark(self, spark: SparkSession) -> int | None:
        """Last released time as epoch seconds, None before the first release."""
        if not self.last_released_timestamp:
            return None
        text = F.lit(self.last_released_timestamp)
        return spark.range(1).select(F.unix_seconds(text.cast("timestamp"))).first()[0]


def load_state(spark: SparkSession, path: str) -> ReleaseState:
    """The latest state; the default state when none was saved.

    States are appended, not overwritten, so a lost driver never leaves a half-written one.
    """
    if not path_exists(spark, path):
        return ReleaseState()
    rows = spark.read.schema(RELEASE_STATE).json(path)
    latest = rows.orderBy(F.desc("last_released_batch")).first()
    return ReleaseState(**latest.asDict()) if latest else ReleaseState()


def save_state(spark: SparkSession, state: ReleaseState, path: str) -> None:
    row = spark.createDataFrame([tuple(asdict(state).values())], RELEASE_STATE)
    row.coalesce(1).write.mode("append").json(path)


def log_metrics(records: DataFrame, path: str) -> None:
    """Append records of (batch_id, model_type, metrics, promoted) with the time of logging."""
    stamped = records.select(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("timestamp"),
        F.col("batch_id").cast("int").alias("batch_id"),
        "model_type",
        "metrics",
        "promoted",
    )
    stamped.write.mode("append").json(path)


def load_metric_log(spark: SparkSession, path: str) -> DataFrame:
    """All records; the JSON reader skips blank lines. Empty when nothing was logged."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], METRIC_LOG)
    return spark.read.schema(METRIC_LOG).json(path)
