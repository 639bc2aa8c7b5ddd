"""Rating errors and ranking quality, as joins and pre-aggregated group-bys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.operators.bias import fit_bias
from tidemark.operators.split import tail_holdout
from tidemark.operators.transitions import item_transitions


def rmse() -> Column:
    """Aggregate over ``rating`` and ``est``."""
    return F.sqrt(F.avg(F.pow(F.col("rating") - F.col("est"), 2)))


def mae() -> Column:
    return F.avg(F.abs(F.col("rating") - F.col("est")))


def rating_errors(predictions: DataFrame) -> DataFrame:
    return predictions.agg(rmse().alias("rmse"), mae().alias("mae"), F.count(F.lit(1)).alias("num_predictions"))


def precision_recall(
    predictions: DataFrame, order: Sequence[str], k: int = 10, threshold: float = 3.5
) -> DataFrame:
    """One row of mean precision@k and recall@k over users, ranked by estimate.

    Equal estimates keep ``order``. Precision divides by k always, recall is 0 for a
    user without relevant rows. The ranking keeps k rows per user before the shuffle;
    relevant totals are a separate pre-aggregated count.
    """
    best_first = Window.partitionBy("user_id").orderBy(F.desc("est"), *order)
    relevant = F.count_if(F.col("rating") >= threshold)
    hits = (
        predictions.select("user_id", "rating", "est", *order)
        .withColumn("_rank", F.row_number().over(best_first))
        .filter(F.col("_rank") <= k)
        .groupBy("user_id")
        .agg(relevant.alias("hits"))
    )
    totals = predictions.groupBy("user_id").agg(relevant.alias("total"))
    return totals.join(hits, "user_id").agg(
        F.avg(F.col("hits") / F.lit(k)).alias("precision"),
        F.avg(F.when(F.col("total") > 0, F.col("hits") / F.col("total")).otherwise(F.lit(0.0))).alias("recall"),
        F.count(F.lit(1)).alias("num_users"),
    )


def evaluate_candidate(
    df: DataFrame, order: Sequence[str], k: int = 10, threshold: float = 3.5, test_frac: float = 0.2, damping: float = 5.0
) -> DataFrame:
    """One row: RMSE, MAE, precision@k, recall@k of the bias model on the latest rows."""
    labelled = tail_holdout(df, order, test_frac)
    model = fit_bias(labelled.filter(F.col("split") == "train"), damping)
    predictions = model.predict(labelled.filter(F.col("split") == "test"))
    return evaluate_predictions(predictions, order, k, threshold)


def evaluate_predictions(predictions: DataFrame, order: Sequence[str], k: int = 10, threshold: float = 3.5) -> DataFrame:
    errors = predictions.agg(F.struct(rmse().alias("rmse"), mae().alias("mae")).alias("e")).scalar()
    ranked = precision_recall(predictions, order, k, threshold)
    return ranked.withColumn("_e", errors).select("_e.rmse", "_e.mae", "precision", "recall", "num_users")


def ranking_metrics(relevant: DataFrame, recommended: DataFrame, k: int = 10) -> DataFrame:
    """Per user: ndcg, recall, precision, hit_rate, mrr at k.

    ``relevant`` (user_id, item_id) may be of any size and repeat items;
    ``recommended`` (user_id, rank, item_id) is cut to k entries per user. A user in
    only one of the two gets zeros. Repeated relevant items count in the recall
    denominator, repeated list entries each count in ndcg.
    """
    wanted = relevant.groupBy("user_id", "item_id").agg(F.count(F.lit(1)).alias("_copies"))
    wanted_sizes = wanted.groupBy("user_id").agg(
        F.sum("_copies").alias("_relevant"), F.count(F.lit(1)).alias("_distinct")
    )
    top = recommended.filter(F.col("rank") <= k).select("user_id", "rank", "item_id")
    marked = top.join(wanted, ["user_id", "item_id"], "left").withColumn("_hit", F.col("_copies").isNotNull())
    per_item = marked.groupBy("user_id", "item_id").agg(
        F.max("_hit").alias("_hit"),
        F.count(F.lit(1)).alias("_entries"),
        F.sum(F.lit(1.0) / F.log2(F.col("rank") + 1)).alias("_gain"),
        F.min("rank").alias("_first"),
    )
    lists = per_item.groupBy("user_id").agg(
        F.sum("_entries").alias("_length"),
        F.count_if("_hit").alias("_hits"),
        F.coalesce(F.sum(F.when(F.col("_hit"), F.col("_gain"))), F.lit(0.0)).alias("_dcg"),
        F.min(F.when(F.col("_hit"), F.col("_first"))).alias("_best"),
    )
    both = wanted_sizes.join(lists, "user_id", "full")
    ideal = F.least(F.coalesce("_distinct", F.lit(0)), F.coalesce("_length", F.lit(0))).cast("int")
    best = F.when(
        ideal > 0,
        F.aggregate(F.sequence(F.lit(1), ideal), F.lit(0.0), lambda s, i: s + F.lit(1.0) / F.log2(i + F.lit(1.0))),
    )
    zero = F.lit(0.0)
    return both.select(
        "user_id",
        F.coalesce(F.col("_dcg") / best, zero).alias("ndcg"),
        F.coalesce(F.col("_hits") / F.col("_relevant"), zero).alias("recall"),
        F.coalesce(F.col("_hits") / F.col("_length"), zero).alias("precision"),
        F.when(F.col("_hits") > 0, F.lit(1.0)).otherwise(zero).alias("hit_rate"),
        F.coalesce(F.lit(1.0) / F.col("_best"), zero).alias("mrr"),
    )


def hit_rate(targets: DataFrame, recommended: DataFrame, k: int = 10) -> DataFrame:
    """(user_id, item_id, hit_rate): 1.0 where the single target is in the user's top k."""
    top = recommended.filter(F.col("rank") <= k).select("user_id", "item_id").distinct().withColumn("_in", F.lit(1.0))
    return targets.join(top, ["user_id", "item_id"], "left").select(
        "user_id", "item_id", F.coalesce("_in", F.lit(0.0)).alias("hit_rate")
    )


def masked_positions(sequences: DataFrame, ignore_label: int = -100) -> DataFrame:
    """(user_id, pos, target, previous): masked positions with the item before them."""
    entries = sequences.select("user_id", "sequence", F.posexplode("labels").alias("pos", "target"))
    before = F.when(F.col("pos") > 0, F.try_element_at("sequence", F.col("pos")))
    return entries.filter(F.col("target") != ignore_label).select("user_id", "pos", "target", before.alias("previous"))


def masked_rank_eval(positions: DataFrame, ranked_next: DataFrame, k: int = 10) -> DataFrame:
    """One row: mean gain 1 / log2(rank + 1) and hit share of masked targets in the top k.

    ``ranked_next`` (previous, rank, target) holds the scorer's list for each previous item.
    """
    top = ranked_next.filter(F.col("rank") <= k)
    joined = positions.join(top, ["previous", "target"], "left")
    return joined.agg(
        F.avg(F.coalesce(F.lit(1.0) / F.log2(F.col("rank") + 1), F.lit(0.0))).alias("ndcg"),
        F.avg(F.when(F.col("rank").isNotNull(), F.lit(1.0)).otherwise(F.lit(0.0))).alias("hit_rate"),
        F.count(F.lit(1)).alias("num_positions"),
    )


def ranked_transitions(df: DataFrame, order: Sequence[str], k: int = 10) -> DataFrame:
    """(previous, rank, target): the k most frequent next items of each item."""
    moves = item_transitions(df, order)
    best_first = Window.partitionBy("item_id").orderBy(F.desc("moves"), "next_item")
    return (
        moves.withColumn("rank", F.row_number().over(best_first))
        .filter(F.col("rank") <= k)
        .select(F.col("item_id").alias("previous"), "rank", F.col("next_item").alias("target"))
    )
