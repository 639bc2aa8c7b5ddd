"""Candidate generation, ranking, enrichment and sampling of recommendation lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.functions.columns import hash_bits
from tidemark.operators.bias import BiasModel
from tidemark.operators.order import global_positions

# Primes above any catalogue size, hence coprime to it. A step of this
# size modulo the catalogue visits every item once.
STEPS = (998244353, 1000000007, 1000000009, 1000000021)


def unseen(candidates: DataFrame, history: DataFrame) -> DataFrame:
    """Candidates whose (user, item) is not in history."""
    seen = history.select("user_id", "item_id").distinct()
    return candidates.join(seen, ["user_id", "item_id"], "left_anti")


def top_n(scored: DataFrame, n: int = 10, score: str = "score", tie_break: Sequence[str] = ()) -> DataFrame:
    """Best ``n`` rows per user with ``rank``; equal scores fall back to the item id.

    Lists are cut inside the map tasks before the shuffle.
    """
    best_first = Window.partitionBy("user_id").orderBy(F.desc(score), *[F.desc(c) for c in tie_break], "item_id")
    return scored.withColumn("rank", F.row_number().over(best_first)).filter(F.col("rank") <= n)


def popular_items(df: DataFrame, n: int = 10) -> DataFrame:
    """(rank, item_id, interactions): the ``n`` items with most rows."""
    counts = df.groupBy("item_id").agg(F.count(F.lit(1)).alias("interactions"))
    top = counts.orderBy(F.desc("interactions"), "item_id").limit(n)
    # At most n rows.
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("interactions"), "item_id")))


def popularity_order(df: DataFrame) -> DataFrame:
    """(item_id, interactions, position): the whole catalogue, most popular first."""
    counts = df.groupBy("item_id").agg(F.count(F.lit(1)).alias("interactions"))
    placed = global_positions(counts.withColumn("_down", -F.col("interactions")), ["_down", "item_id"])
    return placed.drop("_down")


def first_unseen(users: DataFrame, ranked: DataFrame, history: DataFrame, n: int = 10) -> DataFrame:
    """(user_id, rank, item_id): first ``n`` items of one common order each user has not seen.

    ``ranked`` holds every item with its ``position`` 1..M. No user-by-item product is
    built: a user whose list spans m seen items needs the first n + m positions. The
    j-th seen item, at position p, lies inside the list as long as p - j < n.
    """
    size = ranked.agg(F.coalesce(F.max("position"), F.lit(0))).scalar()
    seen = (
        history.join(users.select("user_id"), "user_id", "left_semi")
        .select("user_id", "item_id")
        .distinct()
        .join(ranked.select("item_id", "position"), "item_id")
    )
    by_place = Window.partitionBy("user_id").orderBy("position")
    inside = (
        seen.withColumn("_j", F.row_number().over(by_place)).filter(F.col("position") - F.col("_j") < n)
    ).select("user_id", "position")
    spans = inside.groupBy("user_id").agg(F.count(F.lit(1)).alias("_m"))
    reach = F.least(F.lit(n) + F.coalesce("_m", F.lit(0)), size)
    positions = F.when(reach > 0, F.sequence(F.lit(1).cast("long"), reach)).otherwise(F.array().cast("array<bigint>"))
    slots = (
        users.select("user_id")
        .distinct()
        .join(spans, "user_id", "left")
        .select("user_id", F.explode(positions).alias("position"))
        .join(inside, ["user_id", "position"], "left_anti")
    )
    listed = slots.withColumn("rank", F.row_number().over(by_place))
    return listed.join(ranked, "position").select("user_id", "rank", *[c for c in ranked.columns if c != "position"])


def best_unseen_by_bias(model: BiasModel, users: DataFrame, history: DataFrame, n: int = 10) -> DataFrame:
    """(user_id, rank, item_id, score): top-N unseen items by the additive model.

    Mean and user bias shift all items of a user alike, so one order of item biases
    serves everyone and ``first_unseen`` needs no user-by-item product.
    """
    ranked = global_positions(model.items.withColumn("_down", -F.col("item_bias")), ["_down", "item_id"]).drop("_down")
    listed = first_unseen(users, ranked, history, n).join(model.users, "user_id", "left")
    estimate = F.lit(model.mean) + F.coalesce("user_bias", F.lit(0.0)) + F.col("item_bias")
    return listed.select("user_id", "rank", "item_id", model.clip(estimate).alias("score"))


def cold_start_recs(users: DataFrame, history: DataFrame, n: int = 10) -> DataFrame:
    """The popular list for users without history, carried as one n-entry value."""
    top = popular_items(history, n)
    entries = top.agg(F.array_sort(F.collect_list(F.struct("rank", "item_id", "interactions")))).scalar()
    cold = users.select("user_id").distinct().join(history.select("user_id").distinct(), "user_id", "left_anti")
    return cold.select("user_id", F.explode(entries).alias("e")).select("user_id", "e.*")


def enrich(recs: DataFrame, items: DataFrame) -> DataFrame:
    """Add title and genres, 'Unknown' where the item has none; scores to four places."""
    info = items.select("item_id", "title", "genres")
    joined = recs.withColumn("score", F.round(F.coalesce("score", F.lit(0.0)), 4)).join(info, "item_id", "left")
    return joined.withColumns({c: F.coalesce(c, F.lit("Unknown")) for c in ("title", "genres")})


def score_share(options: DataFrame) -> DataFrame:
    """Percent of the option set's total and of its maximum, and the best-option flag.

    An option set is a short list per user.
    """
    of_user = Window.partitionBy("user_id")
    best = F.row_number().over(of_user.orderBy(F.desc("score"), "item_id")) == 1
    return options.select(
        "*",
        F.round(F.try_divide(F.col("score"), F.sum("score").over(of_user)) * 100, 1).alias("pct_of_total"),
        F.round(F.try_divide(F.col("score"), F.max("score").over(of_user)) * 100, 1).alias("pct_of_max"),
        best.alias("is_best"),
    )


def option_sets(
    recs: DataFrame, users: DataFrame, ranked: DataFrame, history: DataFrame, seed: int = 42, size: int = 4
) -> DataFrame:
    """(user_id, item_id, slot): the top recommendation and ``size`` - 1 of the others at random.

    A user with fewer than ``size`` recommendations gets ``size`` random unseen items.
    These are walked in a per-user pseudo-random order of the catalogue; size plus the
    number of seen items is as far as the walk can have to go.
    """
    key = [F.lit(str(seed)), F.col("user_id"), F.col("item_id")]
    shuffled = Window.partitionBy("user_id").orderBy(F.col("rank") != 1, hash_bits(*key), "item_id")
    lengths = recs.groupBy("user_id").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= size)
    enough = recs.join(lengths.select("user_id"), "user_id", "left_semi")
    picked = enough.select("user_id", "item_id", F.row_number().over(shuffled).alias("slot")).filter(F.col("slot") <= size)

    rest = users.select("user_id").distinct().join(lengths, "user_id", "left_anti")
    seen = (
        history.join(rest, "user_id", "left_semi")
        .select("user_id", "item_id")
        .distinct()
        .join(ranked.select("item_id", "position"), "item_id")
        .select("user_id", "position")
    )
    spans = seen.groupBy("user_id").agg(F.count(F.lit(1)).alias("_m"))
    items = ranked.agg(F.coalesce(F.max("position"), F.lit(0))).scalar()
    draws = F.least(F.lit(size) + F.coalesce("_m", F.lit(0)), items)
    start = hash_bits(F.lit(str(seed)), F.col("user_id"), F.lit("start"))
    step = F.element_at(
        F.array(*[F.lit(s).cast("long") for s in STEPS]),
        (hash_bits(F.lit(str(seed)), F.col("user_id"), F.lit("step")) % len(STEPS) + 1).cast("int"),
    )
    walk = (
        rest.join(spans, "user_id", "left")
        .withColumns({"_start": start, "_step": step, "_draws": draws, "_items": items})
        .filter(F.col("_draws") > 0)
        .select("user_id", "_start", "_step", "_items", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_draws") - 1)).alias("_draw"))
        .select("user_id", "_draw", ((F.col("_start") + F.col("_step") * F.col("_draw")) % F.col("_items") + 1).alias("position"))
        .join(seen, ["user_id", "position"], "left_anti")
    )
    in_walk = Window.partitionBy("user_id").orderBy("_draw")
    drawn = (
        walk.withColumn("slot", F.row_number().over(in_walk))
        .filter(F.col("slot") <= size)
        .join(ranked.select("item_id", "position"), "position")
    )
    return picked.unionByName(drawn.select("user_id", "item_id", "slot"))


def coverage(recs: DataFrame, items: DataFrame) -> DataFrame:
    """One row: distinct recommended items, catalogue size, their ratio."""
    shown = recs.agg(F.count_distinct("item_id").alias("n")).scalar()
    return items.agg(F.count_distinct("item_id").alias("catalog_items")).select(
        shown.alias("recommended_items"),
        "catalog_items",
        F.round(F.try_divide(shown, F.col("catalog_items")), 6).alias("coverage"),
    )
