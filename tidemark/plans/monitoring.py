"""Batch monitoring, drift and the retraining decision."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.operators import drift, gate, monitor, slices
from tidemark.operators.audience import AudienceStore
from tidemark.plans.models import LOG_SQL, metric_series
from tidemark.plans.registry import Tables, query
from tidemark.plans.rows import CHAIN_SQL, EVENT_CUT, event_slices
from tidemark.session import stored, work_path
from tidemark.sources import files

SCHEDULE_DAYS = 3
MIN_NEW_ROWS = 1000


MONITORING_SQL = (
    CHAIN_SQL
    + """, fu as (select user_id, min(batch_id) as batch_id from sliced group by user_id),
    fi as (select item_id, min(batch_id) as batch_id from sliced group by item_id)
    select batch_id, count(*) as num_interactions, round(avg(rating), 6) as mean_rating,
      count(distinct user_id) as active_users, (select count(*) from fu where fu.batch_id = s.batch_id) as new_users,
      count(distinct item_id) as active_items, (select count(*) from fi where fi.batch_id = s.batch_id) as new_items
    from sliced s group by batch_id"""
)


@query("batch_monitoring", MONITORING_SQL)
def batch_monitoring(t: Tables) -> DataFrame:
    return monitor.batch_monitoring(event_slices(t))


@query("audience_by_slice", MONITORING_SQL)
def audience_by_slice(t: Tables) -> DataFrame:
    """The same rows, slice by slice from the bitmaps that the slice before has left."""
    path = work_path(t.spark, "audience-slices")
    files.write_slice(event_slices(t), path)
    batches = t.spark.read.parquet(path)
    store = AudienceStore(t.spark, work_path(t.spark, "audience"))
    for row in batches.select("batch_id").distinct().orderBy("batch_id").collect():  # one row a slice
        store.update(batches.filter(F.col("batch_id") == row.batch_id), row.batch_id)
    return store.reports()


@query("rating_histogram", CHAIN_SQL + "select batch_id, rating, count(*) as num_ratings from sliced group by batch_id, rating")
def rating_histogram(t: Tables) -> DataFrame:
    return monitor.rating_histogram(event_slices(t))


DRIFT_SQL = """
, split_rows as (select rating, cast(ts as double) as ts, {reference} as is_ref from {source}),
long_rows as (
  select 'rating' as "column", rating as value, is_ref from split_rows
  union all select 'ts', ts, is_ref from split_rows),
counts as (select "column", value, count(*) filter (is_ref) as r, count(*) filter (not is_ref) as c from long_rows group by "column", value),
totals as (select "column", sum(r) as nr, sum(c) as nc from counts group by "column"),
placed as (
  select "column", value, r, c, sum(r) over w as cr, sum(c) over w as cc, lag(value) over w as prev from counts
  window w as (partition by "column" order by value)),
dist as (
  select "column", any_value(nr) as n_ref, any_value(nc) as n_cur, max(abs(cr / nr - cc / nc)) as ks,
    coalesce(sum(abs((cr - r) / nr - (cc - c) / nc) * (value - prev)), 0) as wasserstein
  from placed join totals using ("column") group by "column"),
spread as (select "column", stddev_pop(value) as ref_std from long_rows where is_ref group by "column"),
joined as (select * from dist join spread using ("column")),
ks_test as (select *, ks > 1.3581015157406195 * sqrt((n_ref + n_cur) / (n_ref * n_cur)) as drifted from joined),
ws_test as (select *, wasserstein / greatest(ref_std, 0.001) as score, wasserstein / greatest(ref_std, 0.001) >= 0.1 as drifted from joined)
"""
EVENT_DRIFT_SQL = DRIFT_SQL.format(reference=f"ts < {EVENT_CUT}", source="ev")


def _distances(t: Tables) -> DataFrame:
    return drift.drift_distances(t.events.filter(F.col("ts") < EVENT_CUT), t.events.filter(F.col("ts") >= EVENT_CUT))


@query(
    "drift_ks",
    EVENT_DRIFT_SQL
    + """select "column", cast(n_ref as bigint) as n_ref, cast(n_cur as bigint) as n_cur, round(ks, 6) as score, drifted from ks_test""",
)
def drift_ks(t: Tables) -> DataFrame:
    return drift.column_drift(_distances(t), "ks").select("column", "n_ref", "n_cur", "score", "drifted")


@query(
    "drift_wasserstein",
    EVENT_DRIFT_SQL + 'select "column", round(score, 6) as score, drifted from ws_test',
)
def drift_wasserstein(t: Tables) -> DataFrame:
    return drift.column_drift(_distances(t), "wasserstein").select("column", "score", "drifted")


VERDICT_SQL = (
    EVENT_DRIFT_SQL
    + """, picked as (select case when k.n_ref <= 1000 then k.drifted else w.drifted end as drifted, k.n_cur
      from ks_test k join ws_test w using ("column"))
    select round(avg(cast(cast(drifted as int) as double)), 6) as drift_share, cast(max(n_cur) as bigint) as current_rows,
      max(n_cur) >= 10 and avg(cast(cast(drifted as int) as double)) >= 0.5 as drift_detected from picked"""
)


@query("dataset_drift", VERDICT_SQL)
def dataset_drift(t: Tables) -> DataFrame:
    return drift.dataset_drift(drift.column_drift(_distances(t)))


@query("sketched_drift", VERDICT_SQL)
def sketched_drift(t: Tables) -> DataFrame:
    """The same verdict from a sketch for each calendar day and column."""
    daily = t.events.withColumn("batch_id", F.floor(F.col("ts") / 86_400).cast("int"))
    stored_sketches = stored(drift.column_sketches(daily), "sketches")
    earlier = F.col("batch_id") < EVENT_CUT // 86_400  # the cut is a midnight
    sides = [t.events.filter(F.col("ts") < EVENT_CUT), t.events.filter(F.col("ts") >= EVENT_CUT)]
    return drift.detect_drift_from_sketches(
        stored_sketches.filter(earlier), stored_sketches.filter(~earlier), lambda columns: drift.drift_distances(*sides).filter(F.col("column").isin(list(columns)))
    )


# The latest slice against all earlier ones; degradation comes from the metric history.
@query(
    "retrain_trigger",
    CHAIN_SQL
    + LOG_SQL.replace("log as (", "mlog as (").replace("from log)", "from mlog)")
    + DRIFT_SQL.format(reference="batch_id < (select max(batch_id) from meta)", source="sliced").replace("counts", "dcounts")
    + """, picked as (select case when k.n_ref <= 1000 then k.drifted else w.drifted end as drifted, k.n_cur
      from ks_test k join ws_test w using ("column")),
    verdict as (select max(n_cur) >= 10 and avg(cast(cast(drifted as int) as double)) >= 0.5 as d from picked),
    kept as (select * from (select *, row_number() over (partition by model_type order by batch_id desc) as rn from mlog
      where model_type = 'rating') where rn <= 3),
    worse as (select count(*) = 3 and count(*) filter (value > before) = 2 as g from (
      select value, lag(value) over (order by batch_id) as before from kept)),
    base as (select batch_id, num_interactions >= 1000 as enough_rows,
      coalesce(earliest_timestamp - lag(earliest_timestamp) over (order by batch_id) >= 3 * 86400, true) as schedule_due,
      batch_id = (select max(batch_id) from meta) as latest from meta)
    select batch_id, enough_rows, schedule_due, latest and (select d from verdict) as drift_detected,
      latest and (select g from worse) as degraded,
      enough_rows or schedule_due or (latest and (select d from verdict)) or (latest and (select g from worse)) as retrain
    from base""",
)
def retrain_trigger(t: Tables) -> DataFrame:
    batches = event_slices(t)
    metadata = slices.slice_metadata(batches)
    latest = metadata.agg(F.max("batch_id")).first()[0]
    found = drift.detect_drift(batches.filter(F.col("batch_id") < latest), batches.filter(F.col("batch_id") == latest))
    worse = gate.degradation(metric_series(t), ["test_rmse"]).filter(F.col("model_type") == gate.RATING)
    # One verdict each, for the latest batch.
    drifted, degraded = found.first().drift_detected, worse.first().degraded
    return monitor.retrain_trigger(
        monitor.batch_monitoring(batches),
        metadata,
        t.spark.createDataFrame([(latest, drifted)], "batch_id int, drift_detected boolean"),
        t.spark.createDataFrame([(latest, degraded)], "batch_id int, degraded boolean"),
        SCHEDULE_DAYS,
        MIN_NEW_ROWS,
    )
