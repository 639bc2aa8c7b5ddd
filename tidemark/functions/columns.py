"""Scalar, string, date, array and map expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

DAY_SECONDS = 86_400
# A release year in parentheses at the end of a title.
YEAR_PATTERN = r"\((\d{4})\)$"


def release_year(title: Column) -> Column:
    """Year at the end of a title, NULL where there is none."""
    return F.regexp_extract(title, YEAR_PATTERN, 1).try_cast("int")


def event_time(ts: Column) -> Column:
    """Epoch seconds to a UTC timestamp."""
    return F.timestamp_seconds(ts)


def iso_time(ts: Column) -> Column:
    """Epoch seconds to ISO-8601 text with the UTC offset."""
    return F.date_format(F.timestamp_seconds(ts), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def plus_days(ts: Column, days: int) -> Column:
    return ts + F.lit(days * DAY_SECONDS)


def calendar_day(ts: Column) -> Column:
    """Whole days since the epoch; floor, so times before 1970 work too."""
    return F.floor(ts / F.lit(DAY_SECONDS)).cast("long")


def slice_label(batch_id: Column) -> Column:
    return F.format_string("batch_%03d", batch_id)


def hash_bits(*parts: Column) -> Column:
    """First 32 bits of the md5 of the parts joined by ':', as a long.

    Depends on the values only, so a draw is the same on any partitioning.
    """
    text = F.concat_ws(":", *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def hash_uniform(*parts: Column) -> Column:
    """Draw in [0, 1) from ``hash_bits``."""
    return hash_bits(*parts) / F.lit(4294967296.0)


def first_n(items: Column, n: int) -> Column:
    return F.slice(items, 1, n)


def last_n(items: Column, n: int) -> Column:
    return F.when(F.size(items) > n, F.slice(items, -n, n)).otherwise(items)


def left_pad(items: Column, length: int, value: int) -> Column:
    """Pad on the left up to ``length``; longer arrays keep their last ``length``."""
    fill = F.array_repeat(F.lit(value), F.greatest(F.lit(length) - F.size(items), F.lit(0)))
    return F.concat(fill, last_n(items, length))


def map_value(metrics: Column, key: str, default: float) -> Column:
    return F.coalesce(F.try_element_at(metrics, F.lit(key)), F.lit(default))


def merge_maps(left: Column, right: Column) -> Column:
    """Union of two maps; the right one wins on shared keys."""
    kept = F.map_filter(left, lambda k, _: ~F.array_contains(F.map_keys(right), k))
    return F.map_concat(kept, right)


def rises_when_worse(metric_key: Column) -> Column:
    """Error metrics get worse upwards, all others downwards."""
    return F.contains(F.lower(metric_key), F.lit("rmse"))
