"""Vocabulary and user sequences kept up to date from batch to batch.

A batch changes only what it touches. The vocabulary appends: items that are new get the
next numbers, in order of their ids, and a number never changes. Users are dealt into
buckets; of every bucket the last rows of its users and their training sequences are
stored, and a batch reads and writes the buckets of its users alone. What is written carries
the batch number and nothing is changed in place, so a batch that died halfway is
simply run again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.config import SequenceConfig
from tidemark.functions.columns import last_n
from tidemark.operators.filters import positive
from tidemark.operators.order import global_positions
from tidemark.operators.sequences import collect_in_order, last_n_per_user, with_masks
from tidemark.session import stored
from tidemark.sources.files import path_exists
from tidemark.sources.schemas import SEQUENCES

VOCAB = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("idx", T.IntegerType()), T.StructField("batch_id", T.IntegerType())])


@dataclass(frozen=True)
class SequenceStore:
    """Where vocabulary, last rows and sequences lie, and in how many buckets of users."""

    spark: SparkSession
    root: str
    order: tuple[tuple[str, str], ...]
    cfg: SequenceConfig = SequenceConfig()
    buckets: int = 64

    @staticmethod
    def of(rows: DataFrame, root: str, order: Sequence[str], cfg: SequenceConfig = SequenceConfig(), buckets: int = 64) -> SequenceStore:
        """The store below ``root`` for interactions like ``rows``."""
        kinds = tuple((c, rows.schema[c].dataType.simpleString()) for c in order)
        return SequenceStore(rows.sparkSession, root.rstrip("/"), kinds, replace(cfg), buckets)

    @property
    def _columns(self) -> list[str]:
        return ["user_id", "item_id", *[c for c, _ in self.order]]

    def bucket_of(self, user: Column) -> Column:
        return F.pmod(F.xxhash64(user), F.lit(self.buckets)).cast("int")

    def vocabulary(self, before: int | None = None) -> DataFrame:
        """(item_id, idx) after the batches before a number, or after all."""
        return self._read("vocab", VOCAB, before).select("item_id", "idx")

    def sequences(self) -> DataFrame:
        """(user_id, sequence, masked_sequence, labels, length) of all users, as last stored."""
        return self._newest("sequences", SEQUENCES, None).select(*SEQUENCES.names)

    def last_rows(self) -> DataFrame:
        """The last rows of every user that can still enter a sequence."""
        return self._newest("recent", self._recent_schema(), None).select(*self._columns)

    def update(self, batch: DataFrame, number: int) -> None:
        """Carry batch ``number`` into the store, whatever an earlier attempt has left of it."""
        liked = stored(positive(batch.select("rating", *self._columns), self.cfg.min_rating).select(*self._columns), "liked")
        self._add_items(liked, number)
        touched = sorted(r[0] for r in liked.select(self.bucket_of(F.col("user_id"))).distinct().collect())  # buckets at most
        before = self._newest("recent", self._recent_schema(), number, touched).select(*self._columns)
        keep = max(self.cfg.max_len, self.cfg.min_len)
        recent = last_n_per_user(before.unionByName(liked), keep, [c for c, _ in self.order]).select(*self._columns)
        self._write("recent", recent, number)

        mine = self._read("recent", self._recent_schema(), None).filter(F.col("batch_id") == number)
        known = mine.join(self._read("vocab", VOCAB, number + 1).select("item_id", "idx"), "item_id")
        collected = known.groupBy("user_id").agg(collect_in_order([c for c, _ in self.order], "idx").alias("sequence"))
        long_enough = collected.filter(F.size("sequence") >= self.cfg.min_len)
        made = with_masks(long_enough.select("user_id", last_n(F.col("sequence"), self.cfg.max_len).alias("sequence")), self.cfg)
        self._write("sequences", made, number)
        # A bucket counts from here on; the row is what makes the batch visible.
        parts = self.spark.createDataFrame([(b, number) for b in touched], "bucket int, batch_id int")
        parts.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(f"{self.root}/parts")

    def _add_items(self, liked: DataFrame, number: int) -> None:
        before = self.vocabulary(number)
        size = before.agg(F.max("idx")).first()[0] or 0
        fresh = liked.select("item_id").distinct().join(before.select("item_id"), "item_id", "left_anti")
        placed = global_positions(fresh, ["item_id"], "place")
        rows = placed.select("item_id", (F.col("place") + size).cast("int").alias("idx"), F.lit(number).alias("batch_id"))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(f"{self.root}/vocab")

    def _recent_schema(self) -> T.StructType:
        return T.StructType.fromDDL(", ".join(["user_id bigint, item_id bigint", *[f"`{c}` {kind}" for c, kind in self.order]]))

    def _read(self, name: str, schema: T.StructType, before: int | None) -> DataFrame:
        whole = T.StructType([*[f for f in schema if f.name != "batch_id"], T.StructField("bucket", T.IntegerType()), T.StructField("batch_id", T.IntegerType())])
        whole = whole if name != "vocab" else schema
        path = f"{self.root}/{name}"
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], whole)
        rows = self.spark.read.schema(whole).parquet(path)
        return rows if before is None else rows.filter(F.col("batch_id") < before)

    def _newest(self, name: str, schema: T.StructType, before: int | None, buckets: Sequence[int] | None = None) -> DataFrame:
        """The newest version of every bucket; of other buckets and versions no file is opened."""
        parts = self._read("parts", T.StructType([]), before)
        if buckets is not None:
            parts = parts.filter(F.col("bucket").isin(list(buckets)))
        newest: dict[int, list[int]] = {}
        for row in parts.groupBy("bucket").agg(F.max("batch_id").alias("batch_id")).collect():  # buckets at most
            newest.setdefault(row.batch_id, []).append(row.bucket)
        wanted = F.lit(False)
        for number, members in newest.items():
            wanted = wanted | ((F.col("batch_id") == number) & F.col("bucket").isin(members))
        return self._read(name, schema, before).filter(wanted)

    def _write(self, name: str, rows: DataFrame, number: int) -> None:
        rows = rows.withColumns({"bucket": self.bucket_of(F.col("user_id")), "batch_id": F.lit(number)})
        writer = rows.hint("rebalance", "bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("batch_id", "bucket").parquet(f"{self.root}/{name}")


def rebuilt_vocabulary(batches: DataFrame, min_rating: float = 3.5) -> DataFrame:
    """The vocabulary that updates lead to, from all rows with their ``batch_id``."""
    first = positive(batches, min_rating).groupBy("item_id").agg(F.min("batch_id").alias("first"))
    return global_positions(first, ["first", "item_id"], "idx").select("item_id", F.col("idx").cast("int").alias("idx"))
