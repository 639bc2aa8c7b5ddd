"""Explicit schemas; nothing is inferred on read."""

from __future__ import annotations

from pyspark.sql import types as T

INTERACTIONS = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("item_id", T.LongType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("ts", T.LongType()),
    ]
)
# Text twin for files that may hold values which do not convert.
RAW_INTERACTIONS = T.StructType([T.StructField(f.name, T.StringType()) for f in INTERACTIONS])

ITEMS = T.StructType(
    [
        T.StructField("item_id", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField("genres", T.StringType()),
    ]
)
SEQUENCES = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("sequence", T.ArrayType(T.IntegerType())),
        T.StructField("masked_sequence", T.ArrayType(T.IntegerType())),
        T.StructField("labels", T.ArrayType(T.IntegerType())),
        T.StructField("length", T.IntegerType()),
    ]
)
METRIC_LOG = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("batch_id", T.IntegerType()),
        T.StructField("model_type", T.StringType()),
        T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("promoted", T.BooleanType()),
    ]
)
RELEASE_STATE = T.StructType(
    [
        T.StructField("last_released_batch", T.IntegerType()),
        T.StructField("last_released_timestamp", T.StringType()),
        T.StructField("total_ratings_released", T.LongType()),
        T.StructField("dataset_version", T.StringType()),
    ]
)

KEY = ("user_id", "item_id", "ts")
