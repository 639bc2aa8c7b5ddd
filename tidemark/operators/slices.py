"""Chronological release of an immutable interaction table in N-day slices."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.functions.columns import DAY_SECONDS, calendar_day
from tidemark.session import discard, stored


def after_watermark(df: DataFrame, high_water_mark: int | None) -> DataFrame:
    """Rows strictly later than the mark; everything when there is no mark."""
    return df if high_water_mark is None else df.filter(F.col("ts") > F.lit(high_water_mark))


def next_slice(df: DataFrame, high_water_mark: int | None, days: int) -> DataFrame:
    """Rows of the window that starts at the first remaining row and spans ``days``.

    The end is a scalar subquery, one narrow min, and reaches the scan as a bare bound.
    """
    remaining = after_watermark(df, high_water_mark)
    end = remaining.agg((F.min("ts") + F.lit(days * DAY_SECONDS)).alias("end")).scalar()
    return remaining.filter(F.col("ts") < end)


def successors(seconds: DataFrame, width: int) -> DataFrame:
    """(ts, next): the first occupied second at or after ``ts + width``, NULL behind the last.

    ``seconds`` has distinct times. A search is confined to the calendar day of the end,
    at most 86,400 times and as many ends; what it does not find there is the first time
    of the next occupied day, from a table with one row for each calendar day.
    """
    marks = seconds.select("ts", F.col("ts").alias("found"), F.lit(None).cast("long").alias("of")).unionByName(
        seconds.select((F.col("ts") + F.lit(width)).alias("ts"), F.lit(None).cast("long").alias("found"), F.col("ts").alias("of"))
    )
    marks = marks.withColumn("day", calendar_day(F.col("ts")))
    # From the end of the day back, times before the ends of the same second.
    backwards = Window.partitionBy("day").orderBy(F.desc("ts"), F.col("of").asc_nulls_first())
    in_day = marks.withColumn("next", F.min("found").over(backwards.rowsBetween(Window.unboundedPreceding, 0))).filter("of is not null")
    days = marks.groupBy("day").agg(F.min("found").alias("first"))
    later = Window.orderBy(F.desc("day")).rowsBetween(Window.unboundedPreceding, -1)
    after = days.select("day", F.min("first").over(later).alias("after"))
    return in_day.join(F.broadcast(after), "day").select(F.col("of").alias("ts"), F.coalesce("next", "after").alias("next"))


def _jumped(chain: DataFrame, jump: DataFrame, ranks: int) -> DataFrame:
    """The slices that lie ``ranks`` behind those of ``chain``."""
    return chain.join(jump, "ts").select(F.col("next").alias("ts"), (F.col("rank") + F.lit(ranks)).alias("rank")).filter("ts is not null")


def _composed(jump: DataFrame) -> DataFrame:
    """Twice as far as ``jump``; times whose way ends before are left out."""
    further = jump.select(F.col("ts").alias("next"), F.col("next").alias("further"))
    return jump.filter("next is not null").join(further, "next").select("ts", F.col("further").alias("next"))


def slice_chain(df: DataFrame, days: int) -> DataFrame:
    """(batch_id, slice_start, slice_end) of every slice of the table.

    A slice starts at the first row at or after the previous end, so starts depend on
    the data and a fixed-width window is wrong. The table of successors is composed with
    itself: the slices known so far jump by as many at once, which doubles them. The number
    of jobs grows with the logarithm of the number of slices.
    """
    width = days * DAY_SECONDS
    seconds = stored(df.select("ts").filter(F.col("ts").isNotNull()).distinct(), "seconds")
    whole = stored(successors(seconds, width), "successors")
    # Only a time that something leads to can start a slice, except for the first.
    first = seconds.agg(F.min("ts").alias("ts"), F.lit(0).cast("long").alias("rank")).filter("ts is not null")
    starts = whole.select(F.col("next").alias("ts")).filter("ts is not null").unionByName(first.select("ts")).distinct()
    jump = stored(whole.join(starts, "ts", "left_semi"), "successors")
    # Two doublings a round, so that few jobs are run.
    chain, size = stored(first, "chain"), 1
    while True:
        twice = _composed(jump)
        ahead = chain.unionByName(_jumped(chain, jump, size))
        before, chain, size = chain, stored(ahead.unionByName(_jumped(ahead, twice, 2 * size)), "chain"), 4 * size
        discard(before)
        if chain.count() < size:
            break
        shorter, jump = jump, stored(_composed(twice), "successors")
        discard(shorter)
    discard(seconds, whole, jump)
    return chain.select((F.col("rank") + 1).cast("int").alias("batch_id"), F.col("ts").alias("slice_start"), (F.col("ts") + F.lit(width)).alias("slice_end"))


def assign_slices(df: DataFrame, days: int) -> DataFrame:
    """Add ``batch_id``. The range condition is turned into an equi-join on the day."""
    day_of = F.explode(F.sequence(calendar_day(F.col("slice_start")), calendar_day(F.col("slice_end") - 1)))
    by_day = slice_chain(df, days).withColumn("_day", day_of)
    # At most two rows per calendar day of the table's span.
    return (
        df.withColumn("_day", calendar_day(F.col("ts")))
        .join(F.broadcast(by_day), "_day")
        .filter((F.col("ts") >= F.col("slice_start")) & (F.col("ts") < F.col("slice_end")))
        .drop("_day", "slice_start", "slice_end")
    )


def slice_metadata(batches: DataFrame) -> DataFrame:
    return batches.groupBy("batch_id").agg(
        F.min("ts").alias("earliest_timestamp"),
        F.max("ts").alias("latest_timestamp"),
        F.count(F.lit(1)).alias("num_interactions"),
    )


def cumulative_release(metadata: DataFrame) -> DataFrame:
    """Running total over slice records: one row per N days, so one task is enough."""
    upto = Window.orderBy("batch_id").rowsBetween(Window.unboundedPreceding, 0)
    return metadata.select(
        "batch_id", "num_interactions", F.sum("num_interactions").over(upto).alias("total_ratings_released")
    )
