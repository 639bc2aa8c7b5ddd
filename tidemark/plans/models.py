"""Rating models, their evaluation, and the promotion gate."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.config import FactorConfig
from tidemark.functions.columns import merge_maps
from tidemark.operators import evaluation, factor, gate, recommend, split
from tidemark.operators.bias import fit_bias
from tidemark.plans.registry import Tables, query
from tidemark.plans.rows import LINE_CUT, LINE_ORDER_SQL
from tidemark.session import stored, work_path
from tidemark.sources import state
from tidemark.sources.tables import LINE_ORDER

TOP = 10
FACTORS = FactorConfig()

BIAS_SQL = f"""
, placed as (select *, row_number() over (order by {LINE_ORDER_SQL}) as pos, count(*) over () as n from ln),
train as (select * from placed where pos <= cast(floor(n * (1 - 0.2::double)) as bigint)),
test as (select * from placed where pos > cast(floor(n * (1 - 0.2::double)) as bigint)),
mu as (select avg(rating) as m from train),
item_b as (select item_id, (sum(rating) - count(rating) * (select m from mu)) / (count(rating) + 5.0::double) as item_bias
  from train group by item_id),
user_b as (select user_id, sum(rating - (select m from mu) - item_bias) / (count(rating) + 5.0::double) as user_bias
  from train join item_b using (item_id) group by user_id),
predicted as (
  select t.*, least(5.0::double, greatest(0.5::double,
    (select m from mu) + coalesce(user_bias, 0) + coalesce(item_bias, 0))) as est
  from test t left join item_b using (item_id) left join user_b using (user_id)),
ranked as (select *, row_number() over (partition by user_id order by est desc, {LINE_ORDER_SQL}) as rn from predicted),
per_user as (select user_id, count(*) filter (rating >= 3.5 and rn <= 10) as hits, count(*) filter (rating >= 3.5) as total
  from ranked group by user_id),
errors as (select sqrt(avg(pow(rating - est, 2))) as rmse, avg(abs(rating - est)) as mae, count(*) as num_predictions from predicted),
quality as (select avg(hits / 10) as precision, avg(case when total > 0 then hits / total else 0 end) as recall,
  count(*) as num_users from per_user)
"""


def _bias_predictions(t: Tables) -> DataFrame:
    labelled = split.tail_holdout(t.lines, LINE_ORDER)
    model = fit_bias(labelled.filter(F.col("split") == "train"))
    return model.predict(labelled.filter(F.col("split") == "test"))


@query(
    "bias_baseline",
    BIAS_SQL
    + """select 'item' as kind, item_id as id, round(item_bias, 6) as bias from item_b
         union all select 'user', user_id, round(user_bias, 6) from user_b
         union all select 'mean', 0, round(m, 6) from mu""",
)
def bias_baseline(t: Tables) -> DataFrame:
    labelled = split.tail_holdout(t.lines, LINE_ORDER)
    model = fit_bias(labelled.filter(F.col("split") == "train"))
    items = model.items.select(F.lit("item").alias("kind"), F.col("item_id").alias("id"), F.col("item_bias").alias("bias"))
    users = model.users.select(F.lit("user").alias("kind"), F.col("user_id").alias("id"), F.col("user_bias").alias("bias"))
    mean = t.spark.createDataFrame([("mean", 0, model.mean)], "kind string, id long, bias double")
    return items.unionByName(users).unionByName(mean)


@query(
    "bias_predictions",
    BIAS_SQL + "select l_orderkey, l_linenumber, user_id, item_id, rating, ts, round(est, 6) as est from predicted",
)
def bias_predictions(t: Tables) -> DataFrame:
    return _bias_predictions(t).select("l_orderkey", "l_linenumber", "user_id", "item_id", "rating", "ts", "est")


@query("rmse_mae", BIAS_SQL + "select round(rmse, 6) as rmse, round(mae, 6) as mae, num_predictions from errors")
def rmse_mae(t: Tables) -> DataFrame:
    return evaluation.rating_errors(_bias_predictions(t))


@query(
    "precision_recall_at_k",
    BIAS_SQL + "select round(precision, 6) as precision, round(recall, 6) as recall, num_users from quality",
)
def precision_recall_at_k(t: Tables) -> DataFrame:
    return evaluation.precision_recall(_bias_predictions(t), LINE_ORDER, TOP)


@query(
    "candidate_eval",
    BIAS_SQL
    + """select round(rmse, 6) as rmse, round(mae, 6) as mae, round(precision, 6) as precision,
         round(recall, 6) as recall, num_users from errors, quality""",
)
def candidate_eval(t: Tables) -> DataFrame:
    return evaluation.evaluate_candidate(t.lines, LINE_ORDER, TOP)


# Best estimated items the user has not met: per user the order of estimates is the
# order of item biases.
@query(
    "top_n_recs",
    """, mu as (select avg(rating) as m from ln),
    item_b as (select item_id, (sum(rating) - count(rating) * (select m from mu)) / (count(rating) + 5.0::double) as item_bias
      from ln group by item_id),
    user_b as (select user_id, sum(rating - (select m from mu) - item_bias) / (count(rating) + 5.0::double) as user_bias
      from ln join item_b using (item_id) group by user_id),
    free as (select user_id, item_id, user_bias, item_bias from user_b, item_b
      where (user_id, item_id) not in (select user_id, item_id from ln))
    select user_id, rank, item_id, round(least(5.0::double, greatest(0.5::double, (select m from mu) + user_bias + item_bias)), 6) as score
    from (select *, row_number() over (partition by user_id order by item_bias desc, item_id) as rank from free) where rank <= 10""",
)
def top_n_recs(t: Tables) -> DataFrame:
    model = fit_bias(t.lines)
    return recommend.best_unseen_by_bias(model, t.lines.select("user_id"), t.lines, TOP)


@query("mf_predictions")
def mf_predictions(t: Tables) -> DataFrame:
    # Read six times by what follows; stored, the lines meet their orders once.
    labelled = split.tail_holdout(stored(t.lines, "lines"), LINE_ORDER)
    model = factor.fit_factors(labelled.filter(F.col("split") == "train"), FACTORS)
    test = labelled.filter(F.col("split") == "test")
    return model.predict(test).select("l_orderkey", "l_linenumber", "user_id", "item_id", "rating", "ts", "est")


@query("mf_top_n")
def mf_top_n(t: Tables) -> DataFrame:
    past = stored(t.lines.filter(F.col("ts") < LINE_CUT).select("user_id", "item_id", "rating"), "past")
    ranker = factor.fit_ranker(past, FACTORS)
    return recommend.enrich(factor.factor_top_n(ranker, past, past.select("user_id").distinct(), TOP), t.items)


# -- metric history and the gate ---------------------------------------------------

# A real series per model type: monthly spread of ratings around the middle of the
# scale, and monthly share of positives. Every seventh month lacks the sequence model.
LOG_SQL = """
, months as (
  select cast(year(make_timestamp(ts * 1000000)) * 12 + month(make_timestamp(ts * 1000000)) as bigint) as batch_id, rating from ln),
monthly as (
  select batch_id, sqrt(avg(pow(rating - 2.75, 2))) as rmse, avg(case when rating >= 3.5 then 1.0::double else 0.0::double end) as ndcg
  from months group by batch_id),
log as (
  select 'rating' as model_type, batch_id, rmse as value from monthly
  union all select 'sequence', batch_id, ndcg from monthly where batch_id % 7 <> 0),
ordered as (select *, row_number() over (partition by model_type order by batch_id) as seq from log),
fold(model_type, seq, batch_id, value, champion_before, promoted, champion) as (
  select model_type, seq, batch_id, value, cast(null as double), true, value from ordered where seq = 1
  union all
  select o.model_type, o.seq, o.batch_id, o.value, f.champion,
    case when o.model_type = 'rating' then o.value < f.champion - 0.005::double else o.value > f.champion + 0.001::double end,
    case when (case when o.model_type = 'rating' then o.value < f.champion - 0.005::double else o.value > f.champion + 0.001::double end)
      then o.value else f.champion end
  from fold f join ordered o on o.model_type = f.model_type and o.seq = f.seq + 1)
"""


def metric_series(t: Tables) -> DataFrame:
    """A metric log (model_type, batch_id, metrics) from monthly aggregates."""
    when = F.timestamp_seconds("ts")
    month = (F.year(when) * 12 + F.month(when)).cast("int").alias("batch_id")
    monthly = t.lines.groupBy(month).agg(
        F.sqrt(F.avg(F.pow(F.col("rating") - 2.75, 2))).alias("rmse"),
        F.avg(F.when(F.col("rating") >= 3.5, 1.0).otherwise(0.0)).alias("ndcg"),
    )
    entry = lambda kind, key, value: F.struct(
        F.lit(kind).alias("model_type"), F.create_map(F.lit(key), F.col(value)).alias("metrics")
    )
    both = F.array_compact(
        F.array(
            entry(gate.RATING, "test_rmse", "rmse"),
            F.when(F.col("batch_id") % 7 != 0, entry(gate.SEQUENCE, "ndcg@10", "ndcg")),
        )
    )
    return monthly.select("batch_id", F.explode(both).alias("e")).select("e.model_type", "batch_id", "e.metrics")


@query(
    "promotion_history",
    LOG_SQL
    + """select model_type, batch_id, round(value, 6) as value, round(champion_before, 6) as champion_before, promoted from fold""",
)
def promotion_history(t: Tables) -> DataFrame:
    return gate.promotion_history(metric_series(t))


@query(
    "current_champion",
    LOG_SQL
    + """select model_type, max(batch_id) as batch_id, round(arg_max(value, batch_id), 6) as value
         from fold where promoted group by model_type""",
)
def current_champion(t: Tables) -> DataFrame:
    return gate.current_champion(gate.promotion_history(metric_series(t)))


@query(
    "cycle_candidate",
    LOG_SQL
    + """select batch_id, case when batch_id % 7 <> 0 then 'sequence' else 'rating' end as model_type,
         round(case when batch_id % 7 <> 0 then ndcg else rmse end, 6) as value from monthly""",
)
def cycle_candidate(t: Tables) -> DataFrame:
    chosen = gate.cycle_candidate(metric_series(t))
    return chosen.select("batch_id", "model_type", gate.gate_value(TOP).alias("value"))


# One series per line number of the order.
@query(
    "strict_gate",
    """, monthly as (
      select cast(l_linenumber as varchar) as series,
        cast(year(make_timestamp(ts * 1000000)) * 12 + month(make_timestamp(ts * 1000000)) as bigint) as batch_id,
        sqrt(avg(pow(rating - 2.75, 2))) as rmse from ln group by all),
    best as (select *, min(rmse) over (partition by series order by batch_id rows between unbounded preceding and 1 preceding) as b
      from monthly)
    select series, batch_id, round(rmse, 6) as rmse, round(b, 6) as champion_before, b is null or rmse < b as promoted from best""",
)
def strict_gate(t: Tables) -> DataFrame:
    when = F.timestamp_seconds("ts")
    monthly = t.lines.groupBy(
        F.col("l_linenumber").cast("string").alias("series"),
        (F.year(when) * 12 + F.month(when)).cast("int").alias("batch_id"),
    ).agg(F.sqrt(F.avg(F.pow(F.col("rating") - 2.75, 2))).alias("rmse"))
    return gate.strict_gate(monthly)


@query(
    "degradation",
    LOG_SQL
    + """, recent as (select *, row_number() over (partition by model_type order by batch_id desc) as rn from log),
    kept as (select * from recent where rn <= 3),
    stepped as (select *, lag(value) over (partition by model_type order by batch_id) as before from kept)
    select m.model_type, k.metric_key,
      (m.model_type = 'rating') = (k.metric_key = 'test_rmse') and count(*) = 3
      and count(*) filter (case when k.metric_key = 'test_rmse' then value > before else value < before end) = 2 as degraded
    from stepped m, (values ('test_rmse'), ('ndcg@10')) k(metric_key) group by m.model_type, k.metric_key""",
)
def degradation(t: Tables) -> DataFrame:
    return gate.degradation(metric_series(t), ["test_rmse", "ndcg@10"])


@query(
    "metric_log",
    LOG_SQL
    + """select batch_id, model_type, round(value, 6) as value, model_type = 'rating' as promoted from log""",
)
def metric_log(t: Tables) -> DataFrame:
    path = work_path(t.spark, "metric-log")
    state.log_metrics(metric_series(t).withColumn("promoted", F.col("model_type") == gate.RATING), path)
    return state.load_metric_log(t.spark, path).select("batch_id", "model_type", gate.gate_value(TOP).alias("value"), "promoted")


@query(
    "merge_metrics",
    LOG_SQL
    + """select batch_id, round(rmse, 6) as test_rmse, round(ndcg, 6) as ndcg, round(ndcg, 6) as shared from monthly where batch_id % 7 <> 0""",
)
def merge_metrics(t: Tables) -> DataFrame:
    log = metric_series(t)
    shared = lambda key: F.map_concat("metrics", F.create_map(F.lit("shared"), F.try_element_at("metrics", F.lit(key))))
    left = log.filter(F.col("model_type") == gate.RATING).select("batch_id", shared("test_rmse").alias("l"))
    right = log.filter(F.col("model_type") == gate.SEQUENCE).select("batch_id", shared("ndcg@10").alias("r"))
    merged = left.join(right, "batch_id").select("batch_id", merge_maps(F.col("l"), F.col("r")).alias("m"))
    return merged.select(
        "batch_id", F.col("m")["test_rmse"].alias("test_rmse"), F.col("m")["ndcg@10"].alias("ndcg"), F.col("m")["shared"].alias("shared")
    )
