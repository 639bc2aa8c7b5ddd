"""Readers and writers for interaction, item, sequence and slice files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.sources.schemas import INTERACTIONS, ITEMS, RAW_INTERACTIONS, SEQUENCES

# The reader options of the two published layouts.
DOUBLE_COLON = {"sep": "::", "encoding": "ISO-8859-1", "header": "false"}
HEADER_CSV = {"sep": ",", "encoding": "UTF-8", "header": "true", "escape": '"'}
# Dataset names published in the '::' layout; all others use header CSV.
DOUBLE_COLON_DATASETS = ("ml-1m", "ml-10m")


def layout_of(dataset: str) -> str:
    return "dat" if dataset in DOUBLE_COLON_DATASETS else "csv"


def _options(layout: str) -> dict[str, str]:
    if layout == "dat":
        return DOUBLE_COLON
    if layout == "csv":
        return HEADER_CSV
    raise ValueError(f"unknown layout: {layout}")


def read_raw_interactions(spark: SparkSession, path: str, layout: str) -> DataFrame:
    """All four columns as text, for input that still has to be validated."""
    return spark.read.options(**_options(layout)).schema(RAW_INTERACTIONS).csv(path)


def read_interactions(spark: SparkSession, path: str, layout: str = "parquet") -> DataFrame:
    if layout == "parquet":
        return spark.read.schema(INTERACTIONS).parquet(path)
    return normalize(read_raw_interactions(spark, path, layout))


def read_items(spark: SparkSession, path: str, layout: str = "parquet") -> DataFrame:
    if layout == "parquet":
        return spark.read.schema(ITEMS).parquet(path)
    return spark.read.options(**_options(layout)).schema(ITEMS).csv(path)


def normalize(df: DataFrame, columns: dict[str, str] | None = None) -> DataFrame:
    """Rename and cast to the four canonical columns; a bad value fails the job."""
    return _cast(df, columns, lambda c, t: c.cast(t))


def normalize_lenient(df: DataFrame, columns: dict[str, str] | None = None) -> DataFrame:
    """As ``normalize``, but a value that does not convert becomes NULL."""
    return _cast(df, columns, lambda c, t: c.try_cast(t))


def _cast(df: DataFrame, columns: dict[str, str] | None, convert) -> DataFrame:
    names = columns or {}
    return df.select(*[convert(F.col(names.get(f.name, f.name)), f.dataType).alias(f.name) for f in INTERACTIONS])


def write_slice(batch: DataFrame, path: str) -> None:
    """Write rows carrying ``batch_id``; a re-run replaces only the slices it holds.

    Rebalancing gathers each slice into few files and still splits a slice too large
    for one task.
    """
    (
        batch.hint("rebalance", "batch_id")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .parquet(path)
    )


def append_rows(delta: DataFrame, path: str) -> None:
    delta.write.mode("append").parquet(path)


def write_delta(delta: DataFrame, path: str) -> None:
    delta.write.mode("overwrite").parquet(path)


def write_sequences(sequences: DataFrame, path: str, layout: str = "parquet") -> None:
    writer = sequences.write.mode("overwrite")
    if layout == "json":
        writer.json(path)
    else:
        writer.parquet(path)


def read_sequences(spark: SparkSession, path: str, layout: str = "parquet") -> DataFrame:
    reader = spark.read.schema(SEQUENCES)
    return reader.json(path) if layout == "json" else reader.parquet(path)


def write_slice_metadata(metadata: DataFrame, path: str) -> None:
    metadata.write.mode("append").json(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """One lookup on whatever file system the path names; nothing is listed."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def with_ingestion_time(metadata: DataFrame, dataset_version: str, path: str) -> DataFrame:
    """Add the descriptive fields of a slice record."""
    return metadata.select(
        F.col("batch_id").cast(T.IntegerType()).alias("batch_id"),
        F.lit(dataset_version).alias("dataset_version"),
        "earliest_timestamp",
        "latest_timestamp",
        "num_interactions",
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("ingestion_timestamp"),
        F.concat(F.lit(f"{path.rstrip('/')}/batch_id="), F.col("batch_id").cast("string")).alias("batch_path"),
    )
