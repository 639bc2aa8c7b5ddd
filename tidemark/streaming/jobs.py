"""Structured Streaming forms of release, de-duplication, windows and user sequences."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.operators import quality
from tidemark.session import stored
from tidemark.sources.files import path_exists, write_slice
from tidemark.sources.history import KEY_COLUMN, BucketedHistory
from tidemark.sources.schemas import KEY

# What runs on executors travels whole, so these need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def read_slices(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = 1) -> DataFrame:
    """A stream over parquet files, ``files_per_batch`` of them per micro-batch."""
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def run_available(
    stream: DataFrame,
    checkpoint: str,
    each_batch: Callable[[DataFrame, int], None],
    mode: str = "append",
    state_partitions: int | None = None,
    state_store: str | None = None,
) -> None:
    """Process everything not yet processed, then stop; a later call resumes.

    ``state_partitions`` fixes the number of state stores when the checkpoint is new;
    it cannot change later. The default is the session's shuffle partitions. ``state_store``
    names the class that keeps state; no batches without data are run then, of which state
    with an expiry would ask for ever more. All settings are the session's own afterwards.
    """
    conf = stream.sparkSession.conf
    names = ("spark.sql.shuffle.partitions", "spark.sql.streaming.stateStore.providerClass", "spark.sql.streaming.noDataMicroBatches.enabled")
    before = [conf.get(name) for name in names]
    for name, own, asked in zip(names, before, (state_partitions, state_store, "false" if state_store else None)):
        conf.set(name, str(asked or own))
    try:
        query = (
            stream.writeStream.outputMode(mode)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .foreachBatch(each_batch)
            .start()
        )
    finally:
        for name, own in zip(names, before):
            conf.set(name, own)
    query.awaitTermination()


def ingest(
    stream: DataFrame,
    history_path: str,
    checkpoint: str,
    order: Sequence[str],
    quarantine_path: str | None = None,
    buckets: int = 64,
    keys: Sequence[str] = KEY,
) -> None:
    """Validate each micro-batch, keep what history lacks, append it as one slice.

    ``keys`` tell rows apart, in the checks and in history. Without ``quarantine_path`` an
    invalid row stops the job. Slices are overwritten by
    number and compared with earlier slices only, so a repeated micro-batch after a
    failure leaves the same table.
    """
    columns = [c for c in stream.columns if c != "batch_id"]

    def each(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        number = epoch + 1
        rows = batch.select(*columns)
        if quarantine_path is None:
            quality.require_valid(quality.validate(rows, keys))
        else:
            flagged = quality.flag_rows(rows, order, keys)
            write_slice(quality.quarantined_rows(flagged).withColumn("batch_id", F.lit(number)), quarantine_path)
            rows = quality.good_rows(flagged)
        history = BucketedHistory(spark, history_path, rows.schema, keys, buckets)
        history.write(history.lacks(rows, number), number)

    run_available(stream, checkpoint, each)


# Why a row went beside the stream.
LATE, KNOWN, UNTIMED = "late", "known", "no time"


def ingest_in_order(stream: DataFrame, root: str, checkpoint: str, allowed_lateness: int = 0, buckets: int = 64) -> None:
    """Append the rows that come after what is committed; store all others with a reason.

    The mark is the latest time committed by earlier micro-batches. Rows at most
    ``allowed_lateness`` seconds below it are taken if history lacks their key, and are ``known``
    otherwise. Rows further back are ``late``, or ``known`` if history has them. No row is
    dropped: ``released_rows`` and ``side_rows`` together are the input. Only rows at or
    below the mark are compared with history. A repeated micro-batch writes the same again.
    """
    columns = [c for c in stream.columns if c != "batch_id"]

    def each(batch: DataFrame, epoch: int) -> None:
        spark, number = batch.sparkSession, epoch + 1
        rows = batch.select(*columns)
        history = BucketedHistory(spark, f"{root}/history", rows.schema, buckets=buckets)
        mark = _committed_mark(spark, root, number)
        if mark is None:
            ahead, behind = rows.filter(F.col("ts").isNotNull()), None
        else:
            ahead, behind = rows.filter(F.col("ts") > mark), rows.filter(F.col("ts") <= mark)
        side = rows.filter(F.col("ts").isNull()).withColumn("reason", F.lit(UNTIMED))
        if behind is not None:
            ids = behind.withColumn("_row", F.monotonically_increasing_id())
            ids = stored(ids, "behind")  # a row number must not change between its two uses
            fresh = stored(history.lacks(ids, number), "behind-fresh")
            in_time = F.col("ts") > F.lit(mark - allowed_lateness)
            ahead = ahead.unionByName(fresh.filter(in_time).drop("_row"))
            seen = ids.join(fresh.select("_row"), "_row", "left_anti").withColumn("reason", F.lit(KNOWN))
            side = side.unionByName(seen.drop("_row")).unionByName(fresh.filter(~in_time).withColumn("reason", F.lit(LATE)).drop("_row"))
        history.write(ahead, number)
        write_slice(side.withColumn("batch_id", F.lit(number)), f"{root}/side")
        last = history.rows().filter(F.col("batch_id") == number).agg(F.max("ts")).first()[0]
        last = last if mark is None else mark if last is None else max(mark, last)
        # Written last: a batch that died before it is simply run again.
        marks = spark.createDataFrame([(last, number)], "mark long, batch_id int")
        write_slice(marks, f"{root}/marks")

    run_available(stream, checkpoint, each)


def _committed_mark(spark: SparkSession, root: str, number: int) -> int | None:
    if not path_exists(spark, f"{root}/marks"):
        return None
    marks = spark.read.schema("mark long, batch_id int").parquet(f"{root}/marks")
    return marks.filter(F.col("batch_id") < number).agg(F.max("mark")).first()[0]


def released_rows(spark: SparkSession, root: str) -> DataFrame:
    """What ``ingest_in_order`` took, with the number of the micro-batch."""
    return spark.read.parquet(f"{root}/history").drop(KEY_COLUMN)


def side_rows(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """What it did not take, with ``reason`` and the number of the micro-batch."""
    whole = T.StructType([*schema.fields, T.StructField("reason", T.StringType()), T.StructField("batch_id", T.IntegerType())])
    return spark.read.schema(whole).parquet(f"{root}/side")


def with_event_time(stream: DataFrame, delay: str) -> DataFrame:
    """Add ``event_time`` with a watermark; later operators drop rows that come after it."""
    return stream.withColumn("event_time", F.timestamp_seconds("ts")).withWatermark("event_time", delay)


def deduplicate(stream: DataFrame, delay: str = "1 day", keys: Sequence[str] = KEY) -> DataFrame:
    """First arrival of each key. Event time is in the key, so old state expires."""
    timed = with_event_time(stream, delay)
    return timed.dropDuplicates([*[k for k in keys if k != "ts"], "event_time"])


def windowed_activity(stream: DataFrame, days: int, delay: str = "1 day") -> DataFrame:
    """Interactions and approximate active users per event-time window of ``days``."""
    timed = with_event_time(stream, delay)
    return (
        timed.groupBy(F.window("event_time", f"{days} days"))
        .agg(
            F.count(F.lit(1)).alias("num_interactions"),
            F.sum("rating").alias("sum_rating"),
            F.approx_count_distinct("user_id").alias("active_users"),
        )
        .select(
            F.unix_seconds("window.start").alias("window_start"), "num_interactions", "sum_rating", "active_users"
        )
    )


SEQUENCE_STATE = T.StructType([T.StructField(c, T.LongType()) for c in ("ts", "tie", "item_id")])
SEQUENCE_OUTPUT = T.StructType(
    [T.StructField("user_id", T.LongType()), T.StructField("sequence", T.ArrayType(T.LongType())), T.StructField("length", T.IntegerType())]
)
# Fixed value: the state store that typed state with an expiry needs.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class LatestItems(StatefulProcessor):
    """The last ``n`` rows of a user as list state. A user of whom nothing has come for
    ``idle_ms`` is forgotten by the state store itself."""

    def __init__(self, n: int, idle_ms: int | None):
        self.n, self.idle_ms = n, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.rows = handle.getListState("rows", SEQUENCE_STATE, self.idle_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        kept = [tuple(r) for r in self.rows.get()]
        for frame in rows:
            kept += frame[SEQUENCE_STATE.names].itertuples(index=False, name=None)
            kept = [tuple(int(v) for v in row) for row in sorted(kept, key=lambda r: r[:2])[-self.n :]]
        # All rows of the user are written anew, so that none of them expires before another.
        self.rows.put(kept)
        yield pd.DataFrame({"user_id": [key[0]], "sequence": [[row[2] for row in kept]], "length": [len(kept)]})

    def close(self) -> None:
        pass


# Rows a task gathers before it thins them out.
THIN_ROWS = 200_000


def thinned(n: int, at_once: int = THIN_ROWS) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """The last ``n`` rows of every user of a task. Where the users are too many to be held,
    a user may come again, each time with ``n`` rows at most."""

    def latest(frames: list[pd.DataFrame]) -> pd.DataFrame:
        return pd.concat(frames).sort_values(["ts", "tie"]).groupby("user_id").tail(n)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for frame in frames:
            if frame.isna().any(axis=None):  # its numbers are floats, which the others shall not become
                yield latest([frame])
                continue
            held, size = [*held, frame], size + len(frame)
            if size >= at_once:
                held = [latest(held)]
                size = len(held[0])
                if 2 * size >= at_once:
                    yield held[0]
                    held, size = [], 0
        if held:
            yield latest(held)

    return run


def latest_sequences(stream: DataFrame, n: int = 50, idle_ms: int | None = None) -> DataFrame:
    """(user_id, sequence, length): each user's last ``n`` items, kept as state.

    Needs columns user_id, item_id, ts, tie. Every task keeps the last ``n`` rows per user
    before the shuffle, so what reaches the stateful tasks grows with users, not with rows.
    With ``idle_ms`` the state of a user expires that many milliseconds after the last row
    came. Run it with ``state_store=ROCKSDB``.
    """
    rows = stream.select("user_id", "item_id", "ts", "tie")
    return (
        rows.mapInPandas(thinned(n), rows.schema)
        .groupBy("user_id")
        .transformWithStateInPandas(LatestItems(n, idle_ms), SEQUENCE_OUTPUT, "Update", "ProcessingTime" if idle_ms else "None")
    )


def append_epochs(path: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch sink that writes each micro-batch below its own number."""

    def each(batch: DataFrame, epoch: int) -> None:
        write_slice(batch.withColumn("batch_id", F.lit(epoch)), path)

    return each


def latest_by_key(updates: DataFrame, key: str) -> DataFrame:
    """Last update per key from a table written by ``append_epochs``."""
    values = [c for c in updates.columns if c not in (key, "batch_id")]
    newest = F.max_by(F.struct(*values), F.col("batch_id"))
    return updates.groupBy(key).agg(newest.alias("v")).select(key, "v.*")
