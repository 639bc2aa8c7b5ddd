"""Total order over large tables without ever pulling it into one task.

A window without ``partitionBy`` sorts everything in one task, and one partitioned
by user puts a hot user there. Two tools replace them:

* ``rank_cuts`` finds the rows at given ranks from a histogram and resolves only the
  histogram buckets the cuts fall into. Splits need no more than these rows.
* ``ordered_segments`` range-partitions by a unique key, so even a single hot second
  or user is cut into even parts, and stores the parts because a re-run of a range
  exchange may choose other bounds.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.session import stored

SEGMENT_BITS = 33
# Most rows a plain window may put into one task; larger groups take the segment path.
GROUP_ROWS_LIMIT = 5_000_000
HISTOGRAM_BUCKETS = 4096


def ordered_segments(df: DataFrame, keys: Sequence[str], segments: int | None = None) -> DataFrame:
    """Add ``_seg`` and ``_idx``: part number and position within it in ``keys`` order.

    ``keys`` must identify rows uniquely, otherwise a group of equal keys stays whole.
    Without ``segments``, adaptive execution joins neighbouring small ranges.
    """
    ranges = df.repartitionByRange(segments, *keys) if segments else df.repartitionByRange(*keys)
    parts = (
        ranges.sortWithinPartitions(*keys)
        .withColumn("_row", F.monotonically_increasing_id())
        .withColumn("_seg", F.shiftright("_row", SEGMENT_BITS))
        .withColumn("_idx", F.col("_row").bitwiseAND((1 << SEGMENT_BITS) - 1))
        .drop("_row")
    )
    return stored(parts, "segments")


def global_positions(df: DataFrame, keys: Sequence[str], name: str = "position") -> DataFrame:
    """1-based position of every row in ``keys`` order."""
    parts = ordered_segments(df, keys)
    sizes = parts.groupBy("_seg").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_seg", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    # One row per range partition, so the broadcast has a fixed bound.
    return (
        parts.join(F.broadcast(offsets), "_seg")
        .withColumn(name, F.col("_before") + F.col("_idx") + 1)
        .drop("_seg", "_idx", "_before")
    )


def running_sums(
    df: DataFrame, by: str, value: str, sums: Sequence[str], previous: bool = False
) -> DataFrame:
    """Add ``cum_<s>``: sum of ``s`` over all rows of the same ``by`` up to ``value``,
    and ``all_<s>``: the sum over the whole ``by``.

    ``by`` holds few distinct entries (names of monitored columns); ``value`` is
    unique within it and may be of any cardinality. With ``previous``, ``prev_<value>``
    is the next smaller value of the same ``by``.
    """
    parts = ordered_segments(df, [by, value])
    totals = parts.groupBy(by, "_seg").agg(
        F.max(value).alias("_t_last"), *[F.sum(s).alias(f"_t_{s}") for s in sums]
    )
    in_order = Window.partitionBy(by).orderBy("_seg")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    # One row per range partition and entry of ``by``.
    offsets = totals.select(
        by,
        "_seg",
        F.lag("_t_last").over(in_order).alias("_b_last"),
        *[F.coalesce(F.sum(f"_t_{s}").over(before), F.lit(0)).alias(f"_b_{s}") for s in sums],
        *[F.sum(f"_t_{s}").over(Window.partitionBy(by)).alias(f"all_{s}") for s in sums],
    )
    inside = Window.partitionBy("_seg", by).orderBy("_idx")
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    out = parts.join(F.broadcast(offsets), [by, "_seg"]).select(
        *df.columns,
        *[f"all_{s}" for s in sums],
        *[(F.col(f"_b_{s}") + F.sum(s).over(upto)).alias(f"cum_{s}") for s in sums],
        F.coalesce(F.lag(value).over(inside), F.col("_b_last")).alias(f"prev_{value}"),
    )
    return out if previous else out.drop(f"prev_{value}")


def following(df: DataFrame, by: str, order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Add ``next_<v>``: the value in the next row of the same ``by`` in ``order``.

    Groups up to ``GROUP_ROWS_LIMIT`` rows use a plain window. Larger ones, found by
    a pre-aggregated count, are cut into ordered segments and stitched at the seams.
    """
    window = Window.partitionBy(by).orderBy(*order)
    hot = hot_groups(df, by)
    if hot is None:
        return df.select("*", *[F.lead(v).over(window).alias(f"next_{v}") for v in values])
    regular = df.join(hot, by, "left_anti")
    regular = regular.select("*", *[F.lead(v).over(window).alias(f"next_{v}") for v in values])
    return regular.unionByName(_following_in_segments(df.join(hot, by, "left_semi"), by, order, values))


def hot_groups(df: DataFrame, by: str, limit: int | None = None) -> DataFrame | None:
    """Keys of groups too large for one task, or None when there are none."""
    size = F.count(F.lit(1))
    hot = df.groupBy(by).agg(size.alias("_n")).filter(F.col("_n") > (limit or GROUP_ROWS_LIMIT)).select(by)
    hot = stored(hot, "hot")
    return None if hot.isEmpty() else hot


def _following_in_segments(df: DataFrame, by: str, order: Sequence[str], values: Sequence[str]) -> DataFrame:
    parts = ordered_segments(df, [by, *order])
    heads = parts.filter(F.col("_idx") == 0)
    # One head per range partition.
    seam = Window.orderBy("_seg")
    heads = heads.select(
        "_seg",
        F.lead(by).over(seam).alias("_head_by"),
        *[F.lead(v).over(seam).alias(f"_head_{v}") for v in values],
    )
    within = Window.partitionBy("_seg").orderBy("_idx")
    out = parts.select(
        "*",
        F.lead(by).over(within).alias("_next_by"),
        F.lead("_idx").over(within).isNull().alias("_last"),
        *[F.lead(v).over(within).alias(f"_next_{v}") for v in values],
    ).join(F.broadcast(heads), "_seg")
    same = F.when(F.col("_last"), F.col("_head_by")).otherwise(F.col("_next_by")).eqNullSafe(F.col(by))
    return out.select(
        *df.columns,
        *[
            F.when(same, F.when(F.col("_last"), F.col(f"_head_{v}")).otherwise(F.col(f"_next_{v}"))).alias(f"next_{v}")
            for v in values
        ],
    )


def even_buckets(df: DataFrame, key: str, buckets: int = HISTOGRAM_BUCKETS) -> Column:
    """A non-decreasing bucket number over the range of a whole-number ``key``."""
    low, high = df.agg(F.min(key), F.max(key)).first()
    if low is None:
        return F.lit(0)
    width = (high - low) // buckets + 1
    return F.floor((F.col(key) - F.lit(low)) / F.lit(width)).cast("long")


def rank_cuts(
    df: DataFrame,
    keys: Sequence[str],
    bucket: Column,
    ranks: Callable[[int], Sequence[int]],
) -> tuple[int, list[tuple | None]]:
    """Row count, and the ``keys`` of the rows at 1-based ``ranks(count)``.

    ``bucket`` must be non-decreasing in ``keys`` order with a bounded number of
    values (calendar days, an even grid, a hash prefix): its histogram is what
    reaches the driver. Ranks outside 1..count give None.
    """
    narrow = df.select(*keys, bucket.alias("_bucket"))
    histogram = narrow.groupBy("_bucket").agg(F.count(F.lit(1)).alias("n")).orderBy("_bucket").collect()
    total = sum(row.n for row in histogram)
    wanted = list(ranks(total))

    # Bucket and rank within it of every cut that exists.
    located: dict[int, tuple] = {}
    sizes = {}
    for rank in {r for r in wanted if 1 <= r <= total}:
        before = 0
        for row in histogram:
            if rank <= before + row.n:
                located[rank] = (row["_bucket"], rank - before)
                sizes[row["_bucket"]] = row.n
                break
            before += row.n

    hits: dict[tuple, tuple] = {}
    small = [b for b, n in sizes.items() if n <= GROUP_ROWS_LIMIT]
    if small:
        rows = narrow.filter(F.col("_bucket").isin(small))
        in_bucket = Window.partitionBy("_bucket").orderBy(*keys)
        hits |= _rows_at(rows.withColumn("_pos", F.row_number().over(in_bucket)), keys, located.values(), small)
    for bucket_value in sizes.keys() - set(small):
        rows = global_positions(narrow.filter(F.col("_bucket") == F.lit(bucket_value)), keys, "_pos")
        hits |= _rows_at(rows, keys, located.values(), [bucket_value])
    found = {rank: hits[place] for rank, place in located.items()}
    return total, [found.get(r) for r in wanted]


def _rows_at(placed: DataFrame, keys: Sequence[str], places, buckets: Sequence) -> dict[tuple, tuple]:
    """Keys of the rows at the given (bucket, position) places, at most one per cut."""
    spots = [p for p in places if p[0] in buckets]
    hit = F.lit(False)
    for bucket, position in spots:
        hit = hit | ((F.col("_bucket") == F.lit(bucket)) & (F.col("_pos") == position))
    return {(r["_bucket"], r["_pos"]): tuple(r[k] for k in keys) for r in placed.filter(hit).collect()}


def up_to(keys: Sequence[str], bound: tuple | None) -> Column:
    """True for rows at or before ``bound`` in ``keys`` order; no bound, no rows."""
    if bound is None:
        return F.lit(False)
    at_bound = F.struct(*[F.lit(v).alias(k) for k, v in zip(keys, bound)])
    # The first comparison alone is implied, and is what a parquet scan can use.
    return (F.col(keys[0]) <= F.lit(bound[0])) & (F.struct(*keys) <= at_bound)
