"""URL filters by a temporal join of captures with dated block and allow lists.

List entries are dated events: a value, a domain or a URL prefix, is added to or removed
from a list. They become validity intervals, and a capture is judged by the entries that
were valid on the day it was fetched. Everything is DataFrame functions.

A URL is matched by its host, by every parent domain of the host, and by the host with any
leading part of the path. An allow entry of the same or a longer value beats a block
entry; otherwise one active block entry blocks.

Events of one value, list and day count once: an addition wins over a removal. An addition
of what is listed, or a removal of what is not, changes nothing. The hot values of a list
hence hold at most one event a day. Captures are brought to distinct pairs of value and
day before they meet intervals, and pairs meet intervals of their own year only, so a host
with a third of all captures is a few hundred rows there.

A null or unparsable URL matches nothing and is not blocked, nor is a capture without a
fetch day; null values, lists and days of entries are ignored. Repeated captures are
judged each. A URL is matched by all its domains, and by its leading path parts of every
length that some entry has, so no entry is too long. Empty tables give empty results, an
empty list blocks nothing. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

FOREVER = "9999-12-31"


def host_of(url: Column) -> Column:
    """Host in lower case without user, port or a final dot; null where there is none."""
    found = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    found = F.regexp_replace(found, r"\.+$", "")
    return F.when(F.length(found) > 0, found)


def path_of(url: Column) -> Column:
    """Path parts without query and fragment, joined by single slashes."""
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^?#]*)", 1)
    return F.regexp_replace(F.regexp_replace(path, "/+", "/"), "^/|/$", "")


def depths_of(entries: DataFrame) -> list[int]:
    """The different numbers of path parts of entries: at most as many as the longest has."""
    depth = F.size(F.split("value", "/")) - 1
    return sorted(r.depth for r in entries.where("value is not null").select(depth.alias("depth")).distinct().collect() if r.depth)


def values_of(url: Column, depths: list[int]) -> Column:
    """The values of a URL: its domains, and its host with leading path parts of each of ``depths``."""
    host, path = host_of(url), path_of(url)
    labels = F.split(host, r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    parts = F.split(path, "/")
    count = F.when(F.length(path) > 0, F.size(parts)).otherwise(0)
    reached = F.filter(F.array(*map(F.lit, depths)).cast("array<int>"), lambda i: i <= count)
    prefixes = F.transform(reached, lambda i: F.concat_ws("/", host, F.array_join(F.slice(parts, F.lit(1), i), "/")))
    return F.when(host.isNotNull(), F.array_distinct(F.concat(domains, prefixes)))


def intervals(entries: DataFrame) -> DataFrame:
    """(value, list, allow, valid_from, valid_to) from events (value, list, allow, day, added).

    ``valid_to`` is the first day on which the entry no longer holds.
    """
    known = entries.where("value is not null and list is not null and day is not null and added is not null")
    # As in a capture, only the host has no case.
    value = F.concat(F.lower(F.substring_index("value", "/", 1)), F.regexp_extract("value", "(?s)/.*", 0))
    daily = known.groupBy(value.alias("value"), "list", F.coalesce("allow", F.lit(False)).alias("allow"), F.to_date("day").alias("day")).agg(
        F.max("added").alias("added")
    )
    history = Window.partitionBy("value", "list", "allow").orderBy("day")  # a row a day at most
    changed = F.coalesce(F.lag("added").over(history), F.lit(False)) != F.col("added")
    turns = daily.withColumn("changed", changed).where("changed")
    following = F.coalesce(F.lead("day").over(history), F.to_date(F.lit(FOREVER)))
    spans = turns.select("value", "list", "allow", F.col("day").alias("valid_from"), following.alias("valid_to"), "added")
    return spans.where("added").drop("added")


def judge(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """(page_id, blocked, lists, value) of every row of captures (page_id, url, fetched).

    ``lists`` has the active block lists that no allow entry beats, sorted and joined by
    commas, and ``value`` the longest value among them, the first in order of equals.
    """
    rows = captures.select("page_id", "url", F.to_date("fetched").alias("day"))
    asked = rows.where("url is not null and day is not null").select("url", "day").distinct()
    wanted = asked.select("url", "day", F.explode(values_of(F.col("url"), depths_of(entries))).alias("value"))

    pairs = wanted.select("value", "day").distinct().withColumn("year", F.year("day"))
    last = pairs.agg(F.max("year")).first()[0] or 0
    spans = intervals(entries).withColumn("until", F.least(F.year("valid_to"), F.lit(last)))
    yearly = spans.where("year(valid_from) <= until").withColumn("year", F.explode(F.sequence(F.year("valid_from"), F.col("until"))))
    active = pairs.join(yearly, ["value", "year"]).where("day >= valid_from and day < valid_to")
    # Lists are few; a value of one day is one row however many captures it has.
    blocks = F.collect_set(F.when(~F.col("allow"), F.col("list")))
    verdicts = active.groupBy("value", "day").agg(blocks.alias("blocks"), F.max("allow").alias("allows"))

    hits = wanted.join(verdicts, ["value", "day"]).withColumn("size", F.length("value"))
    best = hits.groupBy("url", "day").agg(
        F.max(F.when(F.col("allows"), F.col("size"))).alias("allowed"),
        F.collect_list(F.struct((-F.col("size")).alias("order"), "value", "blocks")).alias("found"),  # as many as a URL has values
    )
    kept = F.filter("found", lambda x: (-x["order"] > F.coalesce("allowed", F.lit(-1))) & (F.size(x["blocks"]) > 0))
    judged = best.select("url", "day", F.array_sort(kept).alias("kept")).where(F.size("kept") > 0)
    lists = F.array_sort(F.array_distinct(F.flatten(F.transform("kept", lambda x: x["blocks"]))))
    judged = judged.select("url", "day", F.array_join(lists, ",").alias("lists"), F.get("kept", F.lit(0))["value"].alias("value"))
    joined = rows.join(judged, ["url", "day"], "left")
    return joined.select("page_id", F.col("lists").isNotNull().alias("blocked"), F.coalesce("lists", F.lit("")).alias("lists"), "value")
