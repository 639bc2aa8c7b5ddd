"""History kept in buckets of its key, so that comparing a batch with it moves only the batch."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.sources.files import path_exists
from tidemark.sources.schemas import KEY

KEY_COLUMN = "bucket_key"


def bucket_key(keys: Sequence[str] = KEY) -> Column:
    """All parts of a key as one text that is never NULL, so that NULL keys match each other.

    A part is its length and its value, or a dash for NULL: different keys differ.
    """
    texts = [F.col(k).cast("string") for k in keys]
    return F.concat(*[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


class BucketedHistory:
    """An accumulated table in folders by ``batch_id``, every batch cut into the same buckets.

    The table is known to the session's catalog under a name that follows from its path, and
    opening it again, in another session too, needs no more than path, schema and buckets.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str] = KEY, buckets: int = 64):
        self.spark, self.path, self.keys, self.buckets = spark, path, tuple(keys), buckets
        self.columns = [f for f in schema if f.name not in ("batch_id", KEY_COLUMN)]
        self.name = "history_" + hashlib.md5(path.encode()).hexdigest()[:16]
        known = spark.catalog.tableExists(self.name)
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.columns)
        spark.sql(
            f"create table if not exists {self.name} ({fields}, {KEY_COLUMN} string, batch_id int) using parquet "
            f"partitioned by (batch_id) clustered by ({KEY_COLUMN}) into {buckets} buckets location '{path}'"
        )
        if not known and path_exists(spark, path):
            spark.catalog.recoverPartitions(self.name)  # what another session has written there

    def rows(self, before: int | None = None) -> DataFrame:
        """All rows with their ``batch_id``, or those of batches before a number."""
        table = self._table(before)
        return table.select(*[f.name for f in self.columns], "batch_id")

    def _table(self, before: int | None) -> DataFrame:
        self.spark.catalog.refreshTable(self.name)
        table = self.spark.table(self.name)
        return table if before is None else table.filter(F.col("batch_id") < before)

    def write(self, rows: DataFrame, number: int) -> None:
        """Store ``rows`` as batch ``number`` in place of what it held, one file a bucket."""
        keyed = rows.select(*[F.col(f.name).cast(f.dataType) for f in self.columns], bucket_key(self.keys).alias(KEY_COLUMN), F.lit(number).cast("int").alias("batch_id"))
        mode, conf = "spark.sql.sources.partitionOverwriteMode", self.spark.conf
        before = conf.get(mode)
        conf.set(mode, "dynamic")  # a table takes it from the session only
        try:
            keyed.repartition(self.buckets, KEY_COLUMN).write.mode("overwrite").insertInto(self.name)
        finally:
            conf.set(mode, before)

    def lacks(self, batch: DataFrame, before: int | None = None) -> DataFrame:
        """Rows of ``batch`` whose key no row of the table has; repeats within it stay.

        The batch is dealt to the table's buckets; the table is read where it lies, only its
        keys, and only inside the batch's time range if time is part of the key.
        """
        known = self._table(before)
        if "ts" in self.keys:
            low, high = batch.agg(F.min("ts"), F.max("ts")).first()
            known = known.filter(F.col("ts").isNull() | F.col("ts").between(low, high))
        return batch.withColumn(KEY_COLUMN, bucket_key(self.keys)).join(known.select(KEY_COLUMN), KEY_COLUMN, "left_anti").drop(KEY_COLUMN)
