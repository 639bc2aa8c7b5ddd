"""Champion / challenger promotion and degradation over metric history.

A metric log has one row per retraining cycle and model type, so a series is short
and may be folded in one row; the work that grows with the data is upstream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.columns import map_value, rises_when_worse

RATING, SEQUENCE = "rating", "sequence"


def gate_value(k: int = 10) -> Column:
    """The deciding metric of a log row; a missing one is inf (error) or 0.0 (quality)."""
    return (
        F.when(F.col("model_type") == RATING, map_value(F.col("metrics"), "test_rmse", float("inf")))
        .when(F.col("model_type") == SEQUENCE, map_value(F.col("metrics"), f"ndcg@{k}", 0.0))
        .otherwise(F.raise_error(F.concat(F.lit("unknown model_type: "), F.coalesce("model_type", F.lit("NULL")))))
    )


def promotion_history(
    log: DataFrame, k: int = 10, min_rmse_gain: float = 0.005, min_ndcg_gain: float = 0.001
) -> DataFrame:
    """(model_type, batch_id, value, champion_before, promoted) for every cycle.

    The champion depends on earlier decisions, so each series is folded in order. The
    first candidate wins; later ones must beat the champion by more than the gain.
    """
    entries = log.select("model_type", "batch_id", gate_value(k).alias("value"))
    series = entries.groupBy("model_type").agg(F.array_sort(F.collect_list(F.struct("batch_id", "value"))).alias("s"))
    beats = lambda value, champion: F.when(
        F.col("model_type") == RATING, value < champion - F.lit(min_rmse_gain)
    ).otherwise(value > champion + F.lit(min_ndcg_gain))

    step_type = "array<struct<batch_id:int,value:double,champion_before:double,promoted:boolean>>"
    start = F.struct(F.lit(None).cast("double").alias("champion"), F.array().cast(step_type).alias("steps"))

    def step(state: Column, entry: Column) -> Column:
        champion = state["champion"]
        wins = champion.isNull() | beats(entry["value"], champion)
        record = F.struct(
            entry["batch_id"].cast("int").alias("batch_id"),
            entry["value"].alias("value"),
            champion.alias("champion_before"),
            F.coalesce(wins, F.lit(False)).alias("promoted"),
        )
        return F.struct(
            F.when(wins, entry["value"]).otherwise(champion).alias("champion"),
            F.concat(state["steps"], F.array(record)).alias("steps"),
        )

    folded = series.select("model_type", F.aggregate("s", start, step)["steps"].alias("steps"))
    return folded.select("model_type", F.explode("steps").alias("e")).select("model_type", "e.*")


def strict_gate(log: DataFrame) -> DataFrame:
    """The older rule over (series, batch_id, rmse): strictly below the best so far."""
    earlier = Window.partitionBy("series").orderBy("batch_id").rowsBetween(Window.unboundedPreceding, -1)
    best = F.min("rmse").over(earlier)
    return log.select(
        "series",
        "batch_id",
        "rmse",
        best.alias("champion_before"),
        (best.isNull() | (F.col("rmse") < best)).alias("promoted"),
    )


def current_champion(history: DataFrame) -> DataFrame:
    """Latest promoted entry of each model type."""
    latest = F.max_by(F.struct("batch_id", "value"), F.col("batch_id"))
    champions = history.filter("promoted").groupBy("model_type").agg(latest.alias("c"))
    return champions.select("model_type", "c.batch_id", "c.value")


def cycle_candidate(log: DataFrame) -> DataFrame:
    """One candidate per cycle: sequence metrics where present, else the rating model's."""
    metrics = lambda kind: F.max_by("metrics", F.when((F.col("model_type") == kind) & (F.size("metrics") > 0), F.lit(1)))
    both = log.groupBy("batch_id").agg(metrics(SEQUENCE).alias("_s"), metrics(RATING).alias("_r"))
    chosen = F.when(F.col("_s").isNotNull(), F.lit(SEQUENCE)).when(F.col("_r").isNotNull(), F.lit(RATING))
    return both.select("batch_id", chosen.alias("model_type"), F.coalesce("_s", "_r").alias("metrics"))


def degradation(log: DataFrame, metric_keys: list[str], window: int = 3) -> DataFrame:
    """(model_type, metric_key, degraded): the last ``window`` cycles got worse every time.

    False when there are fewer cycles or one of them lacks the metric.
    """
    latest_first = Window.partitionBy("model_type").orderBy(F.desc("batch_id"))
    recent = log.withColumn("_rank", F.row_number().over(latest_first)).filter(F.col("_rank") <= window)
    keyed = recent.select(
        "model_type", "batch_id", "metrics", F.explode(F.array(*[F.lit(k) for k in metric_keys])).alias("metric_key")
    ).withColumn("_value", F.try_element_at("metrics", F.col("metric_key")))
    in_series = Window.partitionBy("model_type", "metric_key").orderBy("batch_id")
    before = F.lag("_value").over(in_series)
    worse = F.when(rises_when_worse(F.col("metric_key")), F.col("_value") > before).otherwise(F.col("_value") < before)
    steps = keyed.select("model_type", "metric_key", "_value", worse.alias("_worse"))
    return steps.groupBy("model_type", "metric_key").agg(
        (
            (F.count("_value") == window) & (F.count_if("_worse") == window - 1)
        ).alias("degraded")
    )
