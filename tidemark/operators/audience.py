"""Active and new users and items of a batch from exact bitmaps of those seen before."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.sources.files import path_exists

_SEEN = "kind string, bucket bigint, seen binary, active bigint, new bigint, batch_id int"
_REPORT = "num_interactions bigint, mean_rating double, active_users bigint, new_users bigint, active_items bigint, new_items bigint, batch_id int"


class AudienceStore:
    """Bitmaps of all ids seen up to each batch: one bit an id, 32,768 ids a row.

    Ids are whole numbers; the bitmaps are small where ids are dense, as those of a
    vocabulary are, and exact in any case. A batch needs its own rows and the bitmaps that the batch
    before it has left, never earlier rows. NULL ids count as none.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def update(self, batch: DataFrame, number: int) -> DataFrame:
        """The monitoring row of batch ``number``, stored beside the bitmaps; a re-run replaces both."""
        entries = F.array(F.struct(F.lit("users").alias("kind"), F.col("user_id").alias("id")), F.struct(F.lit("items").alias("kind"), F.col("item_id").alias("id")))
        ids = batch.select(F.explode(entries).alias("e")).select("e.*").filter("id is not null")
        own = ids.groupBy("kind", F.bitmap_bucket_number("id").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits"))
        both = own.withColumn("own", F.lit(True)).unionByName(self._before(number).withColumn("own", F.lit(False)))
        counted = lambda which: F.coalesce(F.sum(F.when(which, F.bitmap_count("bits"))), F.lit(0))
        merged = both.groupBy("kind", "bucket").agg(
            F.bitmap_or_agg("bits").alias("seen"), counted(F.col("own")).alias("active"), counted(~F.col("own")).alias("known")
        )
        self._write(merged.select("kind", "bucket", "seen", "active", (F.bitmap_count("seen") - F.col("known")).alias("new")), "seen", number)

        # Two rows.
        sums = {r.kind: (r.active, r.new) for r in self._read("seen", _SEEN, number).groupBy("kind").agg(F.sum("active").alias("active"), F.sum("new").alias("new")).collect()}
        users, items = sums.get("users", (0, 0)), sums.get("items", (0, 0))
        volume = batch.agg(F.count(F.lit(1)).alias("num_interactions"), F.avg("rating").alias("mean_rating"))
        named = dict(zip(("active_users", "new_users", "active_items", "new_items"), (*users, *items)))
        self._write(volume.select("*", *[F.lit(v).cast("long").alias(k) for k, v in named.items()]), "report", number)
        return self.reports().filter(F.col("batch_id") == number)

    def reports(self) -> DataFrame:
        """The monitoring rows of all batches."""
        return self._read("report", _REPORT, None)

    def _before(self, number: int) -> DataFrame:
        """(kind, bucket, bits) as the latest earlier batch has left them."""
        earlier = self._read("seen", _SEEN, None).filter(F.col("batch_id") < number)
        last = earlier.agg(F.max("batch_id")).first()[0]
        return earlier.filter(F.col("batch_id") == F.lit(last)).select("kind", "bucket", F.col("seen").alias("bits"))

    def _read(self, name: str, schema: str, number: int | None) -> DataFrame:
        path = f"{self.root}/{name}"
        rows = self.spark.read.schema(schema).parquet(path) if path_exists(self.spark, path) else self.spark.createDataFrame([], schema)
        return rows if number is None else rows.filter(F.col("batch_id") == number)

    def _write(self, rows: DataFrame, name: str, number: int) -> None:
        writer = rows.withColumn("batch_id", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("batch_id").parquet(f"{self.root}/{name}")
