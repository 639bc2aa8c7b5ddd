"""User sequences, the item vocabulary, and masked training examples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.config import SequenceConfig
from tidemark.functions.columns import hash_bits, hash_uniform, last_n, left_pad
from tidemark.operators.filters import active_users, positive
from tidemark.operators.order import global_positions


def last_n_per_user(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """Latest ``n`` rows of each user with ``age`` 0 for the latest.

    Spark limits each group inside the map tasks first, so a hot user sends at most
    ``n`` rows per task into the shuffle.
    """
    latest_first = Window.partitionBy("user_id").orderBy(*[F.desc(c) for c in order])
    return (
        df.withColumn("_rank", F.row_number().over(latest_first))
        .filter(F.col("_rank") <= n)
        .withColumn("age", F.col("_rank") - 1)
        .drop("_rank")
    )


def collect_in_order(order: Sequence[str], value: str) -> Column:
    """Aggregate: values of a bounded group in ``order``."""
    entries = F.array_sort(F.collect_list(F.struct(*order, value)))
    return F.transform(entries, lambda e: e[value])


def user_sequences(df: DataFrame, order: Sequence[str], max_len: int = 50, min_len: int = 1) -> DataFrame:
    """(user_id, items, length): the last ``max_len`` items of users with ``min_len`` rows."""
    kept = last_n_per_user(df.select("user_id", "item_id", *order), max(max_len, min_len), order)
    items = kept.groupBy("user_id").agg(collect_in_order(order, "item_id").alias("items"))
    items = items.filter(F.size("items") >= min_len)
    return items.select("user_id", last_n(F.col("items"), max_len).alias("items")).withColumn("length", F.size("items"))


def item_vocab(df: DataFrame) -> DataFrame:
    """(item_id, idx): 1-based dense index over sorted distinct items; 0 stays free."""
    items = global_positions(df.select("item_id").distinct(), ["item_id"], "idx")
    return items.select("item_id", F.col("idx").cast("int").alias("idx"))


def item_vocab_of_active(df: DataFrame, min_len: int = 5) -> DataFrame:
    """The variant that looks only at users with at least ``min_len`` rows."""
    return item_vocab(active_users(df, min_len))


def indexed_items(df: DataFrame, vocab: DataFrame) -> DataFrame:
    """Add the vocabulary index; items outside the vocabulary drop out."""
    return df.join(vocab, "item_id")


def serving_sequence(df: DataFrame, vocab: DataFrame, order: Sequence[str], max_len: int = 50) -> DataFrame:
    """(user_id, sequence): index history of any rating, unknown items dropped, last ``max_len``."""
    known = indexed_items(df.select("user_id", "item_id", *order), vocab)
    kept = last_n_per_user(known, max_len, order)
    return kept.groupBy("user_id").agg(collect_in_order(order, "idx").alias("sequence"))


def with_masks(sequences: DataFrame, cfg: SequenceConfig = SequenceConfig()) -> DataFrame:
    """Add ``masked_sequence`` and ``labels`` to (user_id, sequence).

    Each position draws from a hash of (seed, user, position). A sequence no draw hits
    masks one position, chosen the same way.
    """
    seed, user = F.lit(str(cfg.seed)), F.col("user_id")
    drawn = sequences.withColumn(
        "_hit", F.transform("sequence", lambda _, i: hash_uniform(seed, user, i) < F.lit(cfg.mask_prob))
    )
    fallback = (hash_bits(seed, user, F.lit("fb")) % F.size("sequence")).cast("int")
    forced = drawn.withColumn(
        "_hit",
        F.when(F.exists("_hit", lambda h: h), F.col("_hit")).otherwise(F.transform("_hit", lambda _, i: i == fallback)),
    )
    return forced.select(
        "user_id",
        "sequence",
        F.zip_with("sequence", "_hit", lambda v, h: F.when(h, F.lit(cfg.mask_value)).otherwise(v)).alias("masked_sequence"),
        F.zip_with("sequence", "_hit", lambda v, h: F.when(h, v).otherwise(F.lit(cfg.ignore_label))).alias("labels"),
        F.size("sequence").alias("length"),
    )


def masked_sequences(
    df: DataFrame, order: Sequence[str], cfg: SequenceConfig = SequenceConfig(), vocab: DataFrame | None = None
) -> DataFrame:
    """(user_id, sequence, masked_sequence, labels, length) from raw interactions.

    Rows are cut to the last ``max_len`` per user before they meet the vocabulary.
    """
    liked = positive(df.select("user_id", "item_id", "rating", *order), cfg.min_rating)
    vocab = item_vocab(liked) if vocab is None else vocab
    keep = max(cfg.max_len, cfg.min_len)
    tail = indexed_items(last_n_per_user(liked, keep, order), vocab)
    collected = tail.groupBy("user_id").agg(collect_in_order(order, "idx").alias("sequence"))
    long_enough = collected.filter(F.size("sequence") >= cfg.min_len)
    return with_masks(long_enough.select("user_id", last_n(F.col("sequence"), cfg.max_len).alias("sequence")), cfg)


def padded_sequences(sequences: DataFrame, cfg: SequenceConfig = SequenceConfig()) -> DataFrame:
    """Fixed-length ``masked_sequence`` and ``labels`` for trainers."""
    return sequences.select(
        "user_id",
        left_pad(F.col("masked_sequence"), cfg.max_len, cfg.pad_value).alias("masked_sequence"),
        left_pad(F.col("labels"), cfg.max_len, cfg.ignore_label).alias("labels"),
    )


def sequence_stats(df: DataFrame, min_rating: float = 3.5, min_len: int = 5) -> DataFrame:
    """One row: sequences to build, users with positives, positives; counts per user first."""
    per_user = positive(df, min_rating).groupBy("user_id").agg(F.count(F.lit(1)).alias("_n"))
    return per_user.agg(
        F.count_if(F.col("_n") >= min_len).alias("num_sequences"),
        F.count(F.lit(1)).alias("num_users"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("num_positive"),
    )


def vocab_size(sequences: DataFrame) -> DataFrame:
    """Largest index plus one, for the reserved 0."""
    return sequences.agg((F.coalesce(F.max(F.array_max("sequence")), F.lit(0)) + 1).alias("vocab_size"))


def sequence_lengths(sequences: DataFrame) -> DataFrame:
    return sequences.groupBy("length").agg(F.count(F.lit(1)).alias("num_sequences"))
