"""Scans, filters, slices, deltas, validation and splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.columns import iso_time, slice_label
from tidemark.operators import delta, filters, quality, slices, split
from tidemark.plans.registry import Tables, query
from tidemark.session import stored, work_path
from tidemark.sources import files, state
from tidemark.sources.history import BucketedHistory
from tidemark.sources.schemas import KEY
from tidemark.sources.tables import EVENT_ORDER, LINE_ORDER

SLICE_DAYS = 3
LINE_SLICE_DAYS = 30
LINE_CUT = 899_251_200  # 1998-07-01
EVENT_CUT = 1_705_622_400  # 2024-01-19

CHAIN_SQL = f"""
, chain(batch_id, slice_start) as (
  select cast(1 as bigint), min(ts) from ev
  union all
  select batch_id + 1, (select min(e.ts) from ev e where e.ts >= slice_start + {SLICE_DAYS} * 86400)
  from chain where slice_start is not null),
sliced as (
  select ev.*, batch_id from ev join chain
  on ts >= slice_start and ts < slice_start + {SLICE_DAYS} * 86400),
meta as (
  select batch_id, min(ts) as earliest_timestamp, max(ts) as latest_timestamp,
         count(*) as num_interactions
  from sliced group by batch_id)
"""


def event_slices(t: Tables) -> DataFrame:
    return slices.assign_slices(t.events, SLICE_DAYS)


# -- scans and sinks ---------------------------------------------------------------

EV_SQL = "select user_id, item_id, rating, ts from ev"


@query("scan_csv", EV_SQL)
def scan_csv(t: Tables) -> DataFrame:
    path = work_path(t.spark, "scan-csv")
    t.events.select("user_id", "item_id", "rating", "ts").write.option("header", "true").csv(path)
    return files.read_interactions(t.spark, path, "csv")


@query("scan_dat", EV_SQL)
def scan_dat(t: Tables) -> DataFrame:
    path = work_path(t.spark, "scan-dat")
    t.events.select(F.concat_ws("::", "user_id", "item_id", "rating", "ts")).write.text(path)
    return files.read_interactions(t.spark, path, files.layout_of("ml-1m"))


@query("scan_items_dat", "select item_id, title, genres from it")
def scan_items_dat(t: Tables) -> DataFrame:
    path = work_path(t.spark, "scan-items")
    t.items.select(F.concat_ws("::", "item_id", "title", "genres")).write.option("encoding", "ISO-8859-1").text(path)
    return files.read_items(t.spark, path, files.layout_of("ml-10m"))


# Every 97th order number is replaced by text that does not convert.
@query(
    "normalize",
    """select coalesce(try_cast(case when l_orderkey % 97 = 0 then 'bad' else cast(l_orderkey as varchar) end as bigint), -1) as user_id,
              l_partkey as item_id, l_quantity / 10 as rating, cast(epoch(l_shipdate) as bigint) as ts from lineitem""",
)
def normalize(t: Tables) -> DataFrame:
    text = t.raw("lineitem").select(
        F.when(F.col("l_orderkey") % 97 == 0, F.lit("bad")).otherwise(F.col("l_orderkey").cast("string")).alias("a"),
        F.col("l_partkey").cast("string").alias("b"),
        (F.col("l_quantity") / 10).cast("string").alias("c"),
        F.unix_seconds(F.col("l_shipdate").cast("timestamp")).cast("string").alias("d"),
    )
    columns = {"user_id": "a", "item_id": "b", "rating": "c", "ts": "d"}
    return files.normalize_lenient(text, columns).na.fill(-1, ["user_id"])


@query("scan_pruned", "select user_id, item_id, ts from ev where rating >= 3.5")
def scan_pruned(t: Tables) -> DataFrame:
    return filters.positive(t.events).select("user_id", "item_id", "ts")


@query("slice_sink", CHAIN_SQL + "select batch_id, earliest_timestamp, latest_timestamp, num_interactions from meta")
def slice_sink(t: Tables) -> DataFrame:
    path = work_path(t.spark, "slices")
    files.write_slice(event_slices(t), path)
    return slices.slice_metadata(t.spark.read.parquet(path))


@query(
    "slice_labels",
    CHAIN_SQL
    + """select batch_id, 'batch_' || lpad(cast(batch_id as varchar), 3, '0') as label,
    strftime(make_timestamp(latest_timestamp * 1000000), '%Y-%m-%dT%H:%M:%S+00:00') as last_released_timestamp from meta""",
)
def slice_labels(t: Tables) -> DataFrame:
    meta = slices.slice_metadata(event_slices(t))
    return meta.select(
        "batch_id",
        slice_label(F.col("batch_id")).alias("label"),
        iso_time(F.col("latest_timestamp")).alias("last_released_timestamp"),
    )


# -- filters -----------------------------------------------------------------------


@query("positive_interactions", "select user_id, item_id, rating, ts, tie from ev where rating >= 3.5")
def positive_interactions(t: Tables) -> DataFrame:
    return filters.positive(t.events)


@query(
    "positive_in_catalog",
    """select user_id, item_id, rating, ts from ln where rating >= 3.5 and item_id in (
      select item_id from it where try_cast(regexp_extract(title, '\\((\\d{4})\\)$', 1) as int) >= 1970)""",
)
def positive_in_catalog(t: Tables) -> DataFrame:
    recent = filters.with_release_year(t.items)
    return filters.in_catalog(filters.positive(t.lines), recent).select("user_id", "item_id", "rating", "ts")


@query(
    "title_year",
    """select * from (select item_id, title, genres,
       try_cast(regexp_extract(title, '\\((\\d{4})\\)$', 1) as bigint) as year from it) where year >= 1970""",
)
def title_year(t: Tables) -> DataFrame:
    return filters.with_release_year(t.items)


@query("after_watermark", f"select tie, user_id, item_id, rating, ts from ev where ts > {EVENT_CUT}")
def after_watermark(t: Tables) -> DataFrame:
    return slices.after_watermark(t.events, EVENT_CUT)


@query(
    "next_slice",
    f""", rest as (select * from ev where ts > {EVENT_CUT})
    select tie, user_id, item_id, rating, ts from rest
    where ts < (select min(ts) from rest) + {SLICE_DAYS} * 86400""",
)
def next_slice(t: Tables) -> DataFrame:
    return slices.next_slice(t.events, EVENT_CUT, SLICE_DAYS)


# Ratings of one event in 97 and times of one in 89 are blanked.
@query(
    "drop_null_rows",
    """select rating, ts from (select case when tie % 97 <> 0 then rating end as rating,
       case when tie % 89 <> 0 then ts end as ts from ev) where rating is not null and ts is not null""",
)
def drop_null_rows(t: Tables) -> DataFrame:
    holed = t.events.select(
        F.when(F.col("tie") % 97 != 0, F.col("rating")).alias("rating"),
        F.when(F.col("tie") % 89 != 0, F.col("ts")).alias("ts"),
    )
    return filters.complete_rows(holed)


@query(
    "user_history",
    """select user_id, item_id, rating, ts from ln
       where user_id in (select c_custkey from customer where c_mktsegment = 'BUILDING')""",
)
def user_history(t: Tables) -> DataFrame:
    users = t.raw("customer").filter(F.col("c_mktsegment") == "BUILDING").select(F.col("c_custkey").alias("user_id"))
    return filters.of_users(t.lines, users).select("user_id", "item_id", "rating", "ts")


@query(
    "active_users",
    """select user_id, item_id, rating, ts from ln
       where user_id in (select user_id from ln group by user_id having count(*) >= 40)""",
)
def active_users(t: Tables) -> DataFrame:
    return filters.active_users(t.lines, 40).select("user_id", "item_id", "rating", "ts")


# -- slices ------------------------------------------------------------------------


@query("slice_assignment", CHAIN_SQL + "select tie, user_id, item_id, rating, ts, batch_id from sliced")
def slice_assignment(t: Tables) -> DataFrame:
    return event_slices(t)


@query("slice_metadata", CHAIN_SQL + "select * from meta")
def slice_metadata(t: Tables) -> DataFrame:
    return slices.slice_metadata(event_slices(t))


@query(
    "cumulative_release",
    CHAIN_SQL
    + """select batch_id, num_interactions, cast(sum(num_interactions) over (order by batch_id) as bigint)
         as total_ratings_released from meta""",
)
def cumulative_release(t: Tables) -> DataFrame:
    return slices.cumulative_release(slices.slice_metadata(event_slices(t)))


# -- deltas ------------------------------------------------------------------------

HOLED_SQL = """, holed as (
  select l_orderkey, l_linenumber, case when l_orderkey % 97 <> 0 then user_id end as user_id, item_id, rating,
         case when l_orderkey % 89 <> 0 then ts end as ts, ts as real_ts from ln)
"""


def _holed(t: Tables) -> DataFrame:
    """Line interactions with blanked keys, so that NULL keys have to match each other."""
    return t.lines.select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_orderkey") % 97 != 0, F.col("user_id")).alias("user_id"),
        "item_id",
        "rating",
        F.when(F.col("l_orderkey") % 89 != 0, F.col("ts")).alias("ts"),
        F.col("ts").alias("real_ts"),
    )


DIFF_SQL = (
    HOLED_SQL
    + f"""select l_orderkey, l_linenumber, coalesce(user_id, -1) as user_id, item_id, rating,
    coalesce(ts, -1) as ts, real_ts from holed c
    where not exists (select 1 from holed p where p.real_ts < {LINE_CUT}
      and p.user_id is not distinct from c.user_id and p.item_id is not distinct from c.item_id
      and p.ts is not distinct from c.ts)"""
)


@query("snapshot_diff", DIFF_SQL)
def snapshot_diff(t: Tables) -> DataFrame:
    rows = _holed(t)
    return delta.snapshot_diff(rows, rows.filter(F.col("real_ts") < LINE_CUT)).na.fill(-1, ["user_id", "ts"])


@query("bucketed_diff", DIFF_SQL)
def bucketed_diff(t: Tables) -> DataFrame:
    rows = _holed(t)
    history = BucketedHistory(t.spark, work_path(t.spark, "bucketed"), rows.schema, buckets=t.spark.sparkContext.defaultParallelism)
    history.write(rows.filter(F.col("real_ts") < LINE_CUT), 1)
    return history.lacks(rows).na.fill(-1, ["user_id", "ts"])


@query("delta_sink", DIFF_SQL)
def delta_sink(t: Tables) -> DataFrame:
    """The delta as the file that a cycle leaves; a second run replaces it."""
    rows, path = _holed(t), work_path(t.spark, "delta-sink")
    files.write_delta(rows, path)
    files.write_delta(delta.snapshot_diff(rows, rows.filter(F.col("real_ts") < LINE_CUT)), path)
    return t.spark.read.schema(rows.schema).parquet(path).na.fill(-1, ["user_id", "ts"])


HISTORY_CUT = LINE_CUT + 15 * 86_400


@query(
    "delta_vs_history",
    f""", rest as (select * from ln where ts > {LINE_CUT}),
    batch as (select * from rest where ts < (select min(ts) from rest) + {LINE_SLICE_DAYS} * 86400)
    select l_orderkey, l_linenumber, user_id, item_id, rating, ts from batch b
    where not exists (select 1 from ln h where h.ts < {HISTORY_CUT} and h.user_id = b.user_id
      and h.item_id = b.item_id and h.ts = b.ts)""",
)
def delta_vs_history(t: Tables) -> DataFrame:
    batch = slices.next_slice(t.lines, LINE_CUT, LINE_SLICE_DAYS)
    history = t.lines.filter(F.col("ts") < HISTORY_CUT)
    return delta.delta_vs_history(batch, history).select(
        "l_orderkey", "l_linenumber", "user_id", "item_id", "rating", "ts"
    )


@query(
    "delta_stats",
    HOLED_SQL
    + f""", marked as (
      select c.*, exists (select 1 from holed p where p.real_ts < {LINE_CUT}
        and p.user_id is not distinct from c.user_id and p.item_id is not distinct from c.item_id
        and p.ts is not distinct from c.ts) as known from holed c),
    keyed as (select user_id, item_id, ts, count(*) as n from holed group by all)
    select count(*) as num_records, count(*) filter (not known) as num_new, count(*) filter (known) as num_known,
      (select cast(sum(n - 1) as bigint) from keyed) as num_repeats,
      min(ts) as earliest_timestamp, max(ts) as latest_timestamp from marked""",
)
def delta_stats(t: Tables) -> DataFrame:
    rows = _holed(t)
    return delta.delta_stats(rows, rows.filter(F.col("real_ts") < LINE_CUT))


ACCUMULATE_SQL = f"""select user_id, item_id, rating, ts from ln where ts < {LINE_CUT}
        union all select user_id, item_id, rating, ts from ln where ts >= {LINE_CUT - 30 * 86400}"""


@query("accumulate", ACCUMULATE_SQL)
def accumulate(t: Tables) -> DataFrame:
    rows = t.lines.select("user_id", "item_id", "rating", "ts")
    return delta.accumulate(
        rows.filter(F.col("ts") < LINE_CUT), rows.filter(F.col("ts") >= LINE_CUT - 30 * 86_400)
    )


@query("append_history", ACCUMULATE_SQL)
def append_history(t: Tables) -> DataFrame:
    """The same from files that a second batch was appended to."""
    rows, path = t.lines.select("user_id", "item_id", "rating", "ts"), work_path(t.spark, "append-history")
    files.append_rows(rows.filter(F.col("ts") < LINE_CUT), path)
    files.append_rows(rows.filter(F.col("ts") >= LINE_CUT - 30 * 86_400), path)
    return files.read_interactions(t.spark, path)


@query(
    "slice_records",
    CHAIN_SQL
    + """select batch_id, 'events' as dataset_version, earliest_timestamp, latest_timestamp, num_interactions,
    'slices/batch_id=' || batch_id as batch_path from meta""",
)
def slice_records(t: Tables) -> DataFrame:
    """Records of all slices as their log has them; the time of writing is left out."""
    path = work_path(t.spark, "slice-records")
    records = files.with_ingestion_time(slices.slice_metadata(event_slices(t)), "events", "slices")
    files.write_slice_metadata(records, path)
    return t.spark.read.schema(records.schema).json(path).drop("ingestion_timestamp")


# -- validation --------------------------------------------------------------------

# Planted faults: text that is no number, blanks, a rating off the scale, copied keys.
DIRTY_SQL = """, dirty as (
  select tie,
    case when tie % 101 = 0 then 'x' || user_id when tie % 103 = 0 then null else cast(user_id as varchar) end as user_id,
    cast(item_id as varchar) as item_id,
    case when tie % 107 = 0 then '9.5' when tie % 109 = 0 then 'n/a' else cast(rating as varchar) end as rating,
    case when tie % 113 = 0 then null else cast(cast(floor(ts / 86400) as bigint) as varchar) end as ts from ev),
typed as (
  select tie, user_id as raw_user, item_id as raw_item, rating as raw_rating, ts as raw_ts,
    try_cast(user_id as bigint) as user_id, try_cast(item_id as bigint) as item_id,
    try_cast(rating as double) as rating, try_cast(ts as bigint) as ts from dirty)
"""


def _dirty(t: Tables) -> DataFrame:
    tie = F.col("tie")
    text = {c: F.col(c).cast("string") for c in ("user_id", "item_id", "rating", "ts")}
    day = F.floor(F.col("ts") / 86_400).cast("string")
    return t.events.select(
        "tie",
        F.when(tie % 101 == 0, F.concat(F.lit("x"), text["user_id"]))
        .when(tie % 103 == 0, F.lit(None))
        .otherwise(text["user_id"])
        .alias("user_id"),
        text["item_id"].alias("item_id"),
        F.when(tie % 107 == 0, F.lit("9.5")).when(tie % 109 == 0, F.lit("n/a")).otherwise(text["rating"]).alias("rating"),
        F.when(tie % 113 == 0, F.lit(None)).otherwise(day).alias("ts"),
    )


def _validate_sql(keys: str, name: str) -> str:
    checks = []
    for raw, col in (("raw_user", "user_id"), ("raw_item", "item_id"), ("raw_rating", "rating"), ("raw_ts", "ts")):
        checks.append(f"select 'null:{col}' as \"check\", count(*) as failed_rows from typed where {raw} is null")
        checks.append(f"select 'type:{col}', count(*) from typed where {raw} is not null and {col} is null")
    checks.append("select 'range:rating', count(*) from typed where rating not between 0.5 and 5.0")
    checks.append(
        f"select 'unique:{name}', cast(sum(n - 1) as bigint) from (select count(*) as n from typed group by {keys})"
    )
    return DIRTY_SQL + " union all ".join(checks)


@query("validate_triple", _validate_sql("user_id, item_id, ts", "user_id+item_id+ts"))
def validate_triple(t: Tables) -> DataFrame:
    return quality.validate(_dirty(t), KEY)


@query("validate_on_write", _validate_sql("user_id, item_id, ts", "user_id+item_id+ts"))
def validate_on_write(t: Tables) -> DataFrame:
    """The same report from the job that stores the batch."""
    watched = quality.WatchedBatch(_dirty(t), KEY)
    return watched.report(stored(watched.rows, "watched"))


@query("validate_pair", _validate_sql("user_id, item_id", "user_id+item_id"))
def validate_pair(t: Tables) -> DataFrame:
    return quality.validate(_dirty(t), quality.PAIR_KEY)


@query(
    "duplicate_keys",
    "select user_id, item_id, ts, count(*) as copies from ln group by user_id, item_id, ts having count(*) > 1",
)
def duplicate_keys(t: Tables) -> DataFrame:
    return quality.duplicate_keys(t.lines)


@query(
    "quarantine",
    DIRTY_SQL
    + """, ranked as (select *, row_number() over (partition by user_id, item_id, ts order by tie) as copy from typed),
    flagged as (select tie, array_to_string(list_filter([
      case when raw_user is null then 'null:user_id' end, case when raw_item is null then 'null:item_id' end,
      case when raw_rating is null then 'null:rating' end, case when raw_ts is null then 'null:ts' end,
      case when raw_user is not null and user_id is null then 'type:user_id' end,
      case when raw_item is not null and item_id is null then 'type:item_id' end,
      case when raw_rating is not null and rating is null then 'type:rating' end,
      case when raw_ts is not null and ts is null then 'type:ts' end,
      case when rating not between 0.5 and 5.0 then 'range:rating' end,
      case when copy > 1 then 'unique:user_id+item_id+ts' end], lambda x: x is not null), ',') as reasons from ranked)
    select * from flagged where reasons <> ''""",
)
def quarantine(t: Tables) -> DataFrame:
    return quality.quarantined_rows(quality.flag_rows(_dirty(t), ["tie"])).select("tie", "reasons")


# -- splits ------------------------------------------------------------------------

LINE_ORDER_SQL = "ts, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice"
POSITIONS_SQL = f"""
, placed as (select *, row_number() over (order by {LINE_ORDER_SQL}) as pos, count(*) over () as n from ln),
labelled as (select *, case when pos <= cast(floor(n * 0.8::double) as bigint) then 'train'
  when pos <= cast(floor(n * (0.8::double + 0.1::double)) as bigint) then 'val' else 'test' end as split from placed)
"""
LINE_COLUMNS = ("l_orderkey", "l_linenumber", "user_id", "item_id", "rating", "ts", "split")
LINE_COLUMNS_SQL = "select l_orderkey, l_linenumber, user_id, item_id, rating, ts, split from "


@query("global_split", POSITIONS_SQL + LINE_COLUMNS_SQL + "labelled")
def global_split(t: Tables) -> DataFrame:
    return split.global_split(t.lines, LINE_ORDER).select(*LINE_COLUMNS)


@query("split_sizes", POSITIONS_SQL + "select split, count(*) as num_rows from labelled group by split")
def split_sizes(t: Tables) -> DataFrame:
    return split.split_sizes(split.global_split(t.lines, LINE_ORDER))


@query(
    "tail_holdout",
    POSITIONS_SQL
    + LINE_COLUMNS_SQL
    + "(select * replace (case when pos <= cast(floor(n * (1 - 0.2::double)) as bigint) then 'train' else 'test' end as split) from labelled)",
)
def tail_holdout(t: Tables) -> DataFrame:
    return split.tail_holdout(t.lines, LINE_ORDER).select(*LINE_COLUMNS)


PER_USER_SQL = """, ranked as (
  select *, row_number() over (partition by user_id order by ts desc, tie desc) as rn,
         count(*) over (partition by user_id) as n from ev)
select tie, user_id, item_id, rating, ts,
  case rn when 1 then 'test' when 2 then 'val' else 'train' end as split from ranked where n >= 5"""


@query("per_user_split", PER_USER_SQL)
def per_user_split(t: Tables) -> DataFrame:
    return split.per_user_split(t.events, EVENT_ORDER)


# -- small tables ------------------------------------------------------------------


@query(
    "release_state",
    CHAIN_SQL
    + """select max(batch_id) as last_released_batch,
    strftime(make_timestamp(max(latest_timestamp) * 1000000), '%Y-%m-%dT%H:%M:%S+00:00') as last_released_timestamp,
    cast(sum(num_interactions) as bigint) as total_ratings_released, 'events' as dataset_version from meta""",
)
def release_state(t: Tables) -> DataFrame:
    path = work_path(t.spark, "state")
    meta = slices.slice_metadata(event_slices(t))
    last = meta.agg(
        F.max("batch_id").alias("b"), iso_time(F.max("latest_timestamp")).alias("ts"), F.sum("num_interactions").alias("n")
    ).first()
    state.save_state(t.spark, state.ReleaseState(last.b, last.ts, last.n, "events"), path)
    saved = state.load_state(t.spark, path)
    return t.spark.createDataFrame([saved.__dict__], "last_released_batch int, last_released_timestamp string, total_ratings_released long, dataset_version string")
