"""Sequences, vocabularies, masking and recommendation lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.config import SequenceConfig
from tidemark.operators import evaluation, filters, recommend, sequences, slices, split, transitions
from tidemark.operators.upkeep import SequenceStore
from tidemark.plans.registry import Tables, query
from tidemark.plans.rows import EVENT_CUT, LINE_CUT, SLICE_DAYS
from tidemark.session import stored, work_path
from tidemark.sources import files
from tidemark.sources.tables import EVENT_ORDER

# Shorter than the default so that truncation happens on the supplied tables.
CFG = SequenceConfig(max_len=20)
TOP = 10

VOCAB_SQL = "vocab as (select item_id, row_number() over (order by item_id) as idx from (select distinct item_id from liked))"
POSITIVE_SQL = f"""
, liked as (select * from ev where rating >= 3.5),
{VOCAB_SQL},
tail as (
  select * from (select *, row_number() over (partition by user_id order by ts desc, tie desc) as rn,
    count(*) over (partition by user_id) as n from liked) where rn <= 20 and n >= 5)
"""

MASKED_SQL = (
    POSITIVE_SQL
    + """, steps as (
  select user_id, idx, rn, ts, tie,
    row_number() over (partition by user_id order by ts, tie) - 1 as pos,
    count(*) over (partition by user_id) as len
  from tail join vocab using (item_id)),
drawn as (
  select *, cast('0x' || substr(md5('42:' || user_id || ':' || pos), 1, 8) as bigint) / 4294967296.0::double < 0.2::double as hit,
    cast('0x' || substr(md5('42:' || user_id || ':fb'), 1, 8) as bigint) % len as fb from steps),
settled as (
  select *, case when bool_or(hit) over (partition by user_id) then hit else pos = fb end as mask from drawn),
built as (
  select user_id, list(idx order by pos) as sequence,
    list(case when mask then 0 else idx end order by pos) as masked_sequence,
    list(case when mask then idx else -100 end order by pos) as labels,
    count(*) as length from settled group by user_id)
"""
)
BUILT_TEXT_SQL = """select user_id, array_to_string(sequence, ',') as sequence,
  array_to_string(masked_sequence, ',') as masked_sequence, array_to_string(labels, ',') as labels, length from built"""


def masked(t: Tables) -> DataFrame:
    return sequences.masked_sequences(t.events, EVENT_ORDER, CFG)


@query(
    "last_n_per_user",
    """select tie, user_id, item_id, rating, ts, rn - 1 as age from (
       select *, row_number() over (partition by user_id order by ts desc, tie desc) as rn from ev) where rn <= 20""",
)
def last_n_per_user(t: Tables) -> DataFrame:
    return sequences.last_n_per_user(t.events, CFG.max_len, EVENT_ORDER)


@query(
    "user_sequences",
    POSITIVE_SQL
    + """select user_id, array_to_string(list(item_id order by ts, tie), ',') as items, count(*) as length
         from tail group by user_id""",
)
def user_sequences(t: Tables) -> DataFrame:
    return sequences.user_sequences(filters.positive(t.events), EVENT_ORDER, CFG.max_len, CFG.min_len)


@query(
    "item_vocab",
    """select item_id, row_number() over (order by item_id) as idx from (
       select distinct item_id from ln where rating >= 3.5)""",
)
def item_vocab(t: Tables) -> DataFrame:
    return sequences.item_vocab(filters.positive(t.lines))


@query(
    "item_vocab_active",
    """, liked as (select * from ln where rating >= 3.5)
    select item_id, row_number() over (order by item_id) as idx from (
      select distinct item_id from liked
      where user_id in (select user_id from liked group by user_id having count(*) >= 20))""",
)
def item_vocab_active(t: Tables) -> DataFrame:
    return sequences.item_vocab_of_active(filters.positive(t.lines), 20)


@query("indexed_items", POSITIVE_SQL + "select tie, user_id, item_id, ts, idx from liked join vocab using (item_id)")
def indexed_items(t: Tables) -> DataFrame:
    liked = filters.positive(t.events)
    return sequences.indexed_items(liked, sequences.item_vocab(liked)).select("tie", "user_id", "item_id", "ts", "idx")


@query(
    "serving_sequence",
    f""", first_slice as (select * from ev where ts < (select min(ts) from ev) + {SLICE_DAYS} * 86400),
    vocab as (select item_id, row_number() over (order by item_id) as idx from (
      select distinct item_id from first_slice where rating >= 3.5)),
    known as (select user_id, ts, tie, idx,
      row_number() over (partition by user_id order by ts desc, tie desc) as rn from ev join vocab using (item_id))
    select user_id, array_to_string(list(idx order by ts, tie), ',') as sequence from known where rn <= 20 group by user_id""",
)
def serving_sequence(t: Tables) -> DataFrame:
    vocab = sequences.item_vocab(filters.positive(slices.next_slice(t.events, None, SLICE_DAYS)))
    return sequences.serving_sequence(t.events, vocab, EVENT_ORDER, CFG.max_len)


@query("masked_sequences", MASKED_SQL + BUILT_TEXT_SQL)
def masked_sequences(t: Tables) -> DataFrame:
    return masked(t)


# Three batches of ten days; an item's number follows from the batch that brought it.
CYCLE_DAYS = 10
CYCLE_VOCAB_SQL = f"""chain(batch_id, slice_start) as (
  select cast(1 as bigint), min(ts) from ev
  union all
  select batch_id + 1, (select min(e.ts) from ev e where e.ts >= slice_start + {CYCLE_DAYS} * 86400)
  from chain where slice_start is not null),
brought as (
  select item_id, min(batch_id) as first from liked join chain on ts >= slice_start and ts < slice_start + {CYCLE_DAYS} * 86400 group by item_id),
vocab as (select item_id, row_number() over (order by first, item_id) as idx from brought)"""


@query("cycle_sequences", MASKED_SQL.replace(VOCAB_SQL, CYCLE_VOCAB_SQL) + BUILT_TEXT_SQL)
def cycle_sequences(t: Tables) -> DataFrame:
    """Sequences carried from batch to batch; the vocabulary only appends."""
    path = work_path(t.spark, "cycle-batches")
    files.write_slice(slices.assign_slices(t.events, CYCLE_DAYS), path)
    batches = t.spark.read.parquet(path)
    store = SequenceStore.of(t.events, work_path(t.spark, "cycle-sequences"), EVENT_ORDER, CFG, buckets=t.spark.sparkContext.defaultParallelism)
    for row in batches.select("batch_id").distinct().orderBy("batch_id").collect():  # one row a slice
        store.update(batches.filter(F.col("batch_id") == row.batch_id), row.batch_id)
    return store.sequences()


@query("seq_json_roundtrip", MASKED_SQL + BUILT_TEXT_SQL)
def seq_json_roundtrip(t: Tables) -> DataFrame:
    path = work_path(t.spark, "sequences")
    files.write_sequences(masked(t), path, "json")
    return files.read_sequences(t.spark, path, "json")


@query(
    "padded_sequences",
    MASKED_SQL
    + """select user_id,
      array_to_string(list_concat([0 for x in range(20 - length)], masked_sequence), ',') as masked_sequence,
      array_to_string(list_concat([-100 for x in range(20 - length)], labels), ',') as labels from built""",
)
def padded_sequences(t: Tables) -> DataFrame:
    return sequences.padded_sequences(masked(t), CFG)


@query(
    "sequence_stats",
    """, n as (select user_id, count(*) as c from ln where rating >= 3.5 group by user_id)
    select count(*) filter (c >= 15) as num_sequences, count(*) as num_users, cast(sum(c) as bigint) as num_positive from n""",
)
def sequence_stats(t: Tables) -> DataFrame:
    return sequences.sequence_stats(t.lines, min_len=15)


@query("vocab_size", MASKED_SQL + "select max(list_max(sequence)) + 1 as vocab_size from built")
def vocab_size(t: Tables) -> DataFrame:
    return sequences.vocab_size(masked(t))


@query("seq_length_dist", MASKED_SQL + "select length, count(*) as num_sequences from built group by length")
def seq_length_dist(t: Tables) -> DataFrame:
    return sequences.sequence_lengths(masked(t))


@query(
    "sequence_tail",
    POSITIVE_SQL
    + """, users as (select user_id, row_number() over (order by user_id) as pos, count(*) over () as n
      from (select distinct user_id from tail)),
    kept as (select user_id from users where pos > n - greatest(1, n // 10))
    select user_id, array_to_string(list(item_id order by ts, tie), ',') as items, count(*) as length
    from tail where user_id in (select user_id from kept) group by user_id""",
)
def sequence_tail(t: Tables) -> DataFrame:
    built = sequences.user_sequences(filters.positive(t.events), EVENT_ORDER, CFG.max_len, CFG.min_len)
    return split.sequence_tail(built)


@query(
    "hash_holdout",
    POSITIVE_SQL
    + """, users as (select user_id, count(*) as length from tail group by user_id),
    placed as (select *, row_number() over (order by md5('42:' || user_id), user_id) as pos, count(*) over () as n from users)
    select user_id, length, case when pos <= cast(floor(n * 0.1::double) as bigint) then 'val' else 'train' end as split
    from placed""",
)
def hash_holdout(t: Tables) -> DataFrame:
    built = sequences.user_sequences(filters.positive(t.events), EVENT_ORDER, CFG.max_len, CFG.min_len)
    return split.hash_holdout(built.select("user_id", "length"))


# -- candidates and lists ----------------------------------------------------------


@query(
    "unseen_candidates",
    f"""select distinct user_id, item_id from ln where ts >= {LINE_CUT}
        except select user_id, item_id from ln where ts < {LINE_CUT}""",
)
def unseen_candidates(t: Tables) -> DataFrame:
    later = t.lines.filter(F.col("ts") >= LINE_CUT).select("user_id", "item_id").distinct()
    return recommend.unseen(later, t.lines.filter(F.col("ts") < LINE_CUT))


@query(
    "popular_items",
    """select row_number() over (order by interactions desc, item_id) as rank, item_id, interactions from (
       select item_id, count(*) as interactions from ln group by item_id order by interactions desc, item_id limit 10)""",
)
def popular_items(t: Tables) -> DataFrame:
    return recommend.popular_items(t.lines, TOP)


CANDIDATE_SQL = """
, counts as (select item_id, count(*) as interactions from ln group by item_id),
free as (
  select user_id, item_id, interactions from (select distinct user_id from ln), counts
  where (user_id, item_id) not in (select user_id, item_id from ln)),
listed as (
  select * from (select *, row_number() over (partition by user_id order by interactions desc, item_id) as rank from free)
  where rank <= 10)
"""


def _popular_unseen(t: Tables) -> DataFrame:
    ranked = recommend.popularity_order(t.lines)
    return recommend.first_unseen(t.lines.select("user_id"), ranked, t.lines, TOP)


@query("candidate_pairs", CANDIDATE_SQL + "select user_id, rank, item_id, interactions from listed")
def candidate_pairs(t: Tables) -> DataFrame:
    return _popular_unseen(t)


@query(
    "cold_start_recs",
    """, top as (select item_id, count(*) as interactions from ev group by item_id order by interactions desc, item_id limit 10)
    select c_custkey as user_id, row_number() over (partition by c_custkey order by interactions desc, item_id) as rank,
      item_id, interactions from customer, top where c_custkey not in (select user_id from ev)""",
)
def cold_start_recs(t: Tables) -> DataFrame:
    users = t.raw("customer").select(F.col("c_custkey").alias("user_id"))
    return recommend.cold_start_recs(users, t.events, TOP)


# Items of one type are left out of the dimension so that some recommendations have no title.
@query(
    "enrich",
    """, pairs as (select user_id, item_id, avg(rating) as score from ln group by user_id, item_id),
    info as (select * from it where genres <> 'ECONOMY'),
    best as (select * from (select *, row_number() over (partition by user_id order by score desc, item_id) as rank
      from pairs) where rank <= 10)
    select user_id, rank, item_id, round(score, 4) as score, coalesce(title, 'Unknown') as title,
      coalesce(genres, 'Unknown') as genres from best left join info using (item_id)""",
)
def enrich(t: Tables) -> DataFrame:
    pairs = t.lines.groupBy("user_id", "item_id").agg(F.avg("rating").alias("score"))
    info = t.items.filter(F.col("genres") != "ECONOMY")
    return recommend.enrich(recommend.top_n(pairs, TOP), info)


MOVES_SQL = """
, steps as (select user_id, item_id, ts, tie, lead(item_id) over (partition by user_id order by ts, tie) as next_item from ev),
moves as (
  select item_id, next_item, count(*) as moves, count(*) / sum(count(*)) over (partition by item_id) as prob
  from steps where next_item is not null group by item_id, next_item)
"""


@query(
    "item_transitions",
    MOVES_SQL + "select item_id, next_item, moves, round(prob, 6) as prob from moves",
)
def item_transitions(t: Tables) -> DataFrame:
    return transitions.item_transitions(t.events, EVENT_ORDER)


NEXT_SQL = (
    MOVES_SQL
    + """, recent as (select user_id, item_id, row_number() over (partition by user_id order by ts desc, tie desc) - 1 as age from ev),
scores as (
  select user_id, next_item as item_id, round(sum(pow(0.8::double, age) * prob), 9) as score
  from recent join moves using (item_id) where age < 20 group by user_id, next_item),
recs as (
  select * from (select *, row_number() over (partition by user_id order by score desc, item_id) as rank from scores s
    where not exists (select 1 from ev h where h.user_id = s.user_id and h.item_id = s.item_id)) where rank <= 10)
"""
)


def _next_items(t: Tables) -> DataFrame:
    moves = transitions.item_transitions(t.events, EVENT_ORDER)
    return transitions.next_item_recs(t.events, moves, EVENT_ORDER, TOP, CFG.max_len)


@query("next_item_recs", NEXT_SQL + "select user_id, rank, item_id, round(score, 6) as score from recs")
def next_item_recs(t: Tables) -> DataFrame:
    return _next_items(t).select("user_id", "rank", "item_id", "score")


@query(
    "score_share",
    NEXT_SQL
    + """select user_id, rank, item_id, round(score, 6) as score,
      round(score / sum(score) over w * 100, 1) as pct_of_total, round(score / max(score) over w * 100, 1) as pct_of_max,
      rank = 1 as is_best from recs window w as (partition by user_id)""",
)
def score_share(t: Tables) -> DataFrame:
    return recommend.score_share(_next_items(t).select("user_id", "rank", "item_id", "score"))


@query(
    "rec_coverage",
    CANDIDATE_SQL
    + """select count(distinct item_id) as recommended_items, (select count(distinct item_id) from it) as catalog_items,
      round(count(distinct item_id) / (select count(distinct item_id) from it), 6) as coverage from listed""",
)
def rec_coverage(t: Tables) -> DataFrame:
    return recommend.coverage(_popular_unseen(t), t.items)


OPTION_SQL = """
, counts as (select item_id, count(*) as interactions from ev group by item_id),
ranked as (select item_id, row_number() over (order by interactions desc, item_id) as position from counts),
seen as (select distinct user_id, item_id from ev),
users as (select distinct user_id from ev),
recs as (
  select user_id, item_id, row_number() over (partition by user_id order by position) as rank
  from users, ranked where position <= 10 and (user_id, item_id) not in (select user_id, item_id from seen)),
rich as (select user_id from recs group by user_id having count(*) >= 4),
picked as (
  select user_id, item_id, row_number() over (partition by user_id order by rank <> 1,
    cast('0x' || substr(md5('42:' || user_id || ':' || item_id), 1, 8) as bigint), item_id) as slot
  from recs where user_id in (select user_id from rich)),
walk as (
  select user_id, j,
    (cast('0x' || substr(md5('42:' || user_id || ':start'), 1, 8) as bigint)
     + j * [998244353, 1000000007, 1000000009, 1000000021][
         cast('0x' || substr(md5('42:' || user_id || ':step'), 1, 8) as bigint) % 4 + 1]) % m + 1 as position
  from users, (select count(*) as m from ranked), (select range as j from range((select count(*) from ranked)))
  where user_id not in (select user_id from rich)),
drawn as (
  select user_id, item_id, row_number() over (partition by user_id order by j) as slot
  from walk join ranked using (position) where (user_id, item_id) not in (select user_id, item_id from seen))
select user_id, item_id, slot from picked where slot <= 4
union all select user_id, item_id, slot from drawn where slot <= 4
"""


@query("negative_sample", OPTION_SQL)
def negative_sample(t: Tables) -> DataFrame:
    ranked = stored(recommend.popularity_order(t.events).select("item_id", "position"), "ranked")
    users = t.events.select("user_id").distinct()
    # Only the ten most popular items are on offer, so some users have fewer than four left.
    top = ranked.filter(F.col("position") <= TOP)
    recs = recommend.first_unseen(users, top, t.events, TOP)
    return recommend.option_sets(recs, users, ranked, t.events)


# -- ranking metrics ---------------------------------------------------------------

# Popular items new to the user, from the rows before the cut, against what the user
# liked after it.
METRIC_SQL = f"""
, past as (select * from ev where ts < {EVENT_CUT}),
relevant as (select user_id, item_id from ev where ts >= {EVENT_CUT} and rating >= 3.5),
counts as (select item_id, count(*) as interactions from past group by item_id),
recs as (
  select * from (select user_id, item_id, row_number() over (partition by user_id order by interactions desc, item_id) as rank
    from (select distinct user_id from past), counts
    where (user_id, item_id) not in (select user_id, item_id from past)) where rank <= 10),
wanted as (select user_id, count(*) as n, count(distinct item_id) as d from relevant group by user_id),
marked as (select *, (user_id, item_id) in (select user_id, item_id from relevant) as hit from recs),
lists as (
  select user_id, count(*) as len, count(distinct item_id) filter (hit) as hits,
    coalesce(sum(1 / log2(rank + 1)) filter (hit), 0) as dcg, min(rank) filter (hit) as first_hit
  from marked group by user_id),
both_sides as (
  select coalesce(w.user_id, l.user_id) as user_id, coalesce(n, 0) as n, coalesce(d, 0) as d,
    coalesce(len, 0) as len, coalesce(hits, 0) as hits, coalesce(dcg, 0) as dcg, first_hit
  from wanted w full join lists l on w.user_id = l.user_id),
scored as (
  select user_id,
    case when least(d, len) > 0 then dcg / list_sum([1 / log2(x + 1) for x in range(1, least(d, len) + 1)]) else 0 end as ndcg,
    case when n > 0 then hits / n else 0 end as recall, case when len > 0 then hits / len else 0 end as precision,
    case when hits > 0 then 1.0::double else 0.0::double end as hit_rate, coalesce(1 / first_hit, 0) as mrr
  from both_sides)
"""


def _relevant_and_lists(t: Tables) -> tuple[DataFrame, DataFrame]:
    past = t.events.filter(F.col("ts") < EVENT_CUT)
    relevant = filters.positive(t.events.filter(F.col("ts") >= EVENT_CUT)).select("user_id", "item_id")
    lists = recommend.first_unseen(past.select("user_id"), recommend.popularity_order(past), past, TOP)
    return relevant, lists


def _metric_query(metric: str) -> None:
    @query(f"{metric}_at_k", METRIC_SQL + f"select user_id, round(cast({metric} as double), 6) as {metric} from scored")
    def build(t: Tables) -> DataFrame:
        return evaluation.ranking_metrics(*_relevant_and_lists(t), TOP).select("user_id", metric)


for _metric in ("ndcg", "recall", "precision", "mrr"):
    _metric_query(_metric)


# The first thing each user liked after the cut is the single target.
@query(
    "hit_rate_at_k",
    METRIC_SQL
    + f""", target as (select user_id, arg_min(item_id, (ts, tie)) as item_id from ev
      where ts >= {EVENT_CUT} and rating >= 3.5 group by user_id)
    select user_id, item_id, case when (user_id, item_id) in (select user_id, item_id from recs)
      then 1.0::double else 0.0::double end as hit_rate from target""",
)
def hit_rate_at_k(t: Tables) -> DataFrame:
    liked = filters.positive(t.events.filter(F.col("ts") >= EVENT_CUT))
    first = F.min_by("item_id", F.struct(*EVENT_ORDER))
    targets = liked.groupBy("user_id").agg(first.alias("item_id"))
    return evaluation.hit_rate(targets, _relevant_and_lists(t)[1], TOP)


# Arrays of bounded length: the last positives before and after the cut as lists.
@query(
    "list_metrics",
    f""", ranked as (select user_id, item_id, ts, tie, ts >= {EVENT_CUT} as later,
      row_number() over (partition by user_id, ts >= {EVENT_CUT} order by ts desc, tie desc) as rn from ev),
    lists as (select user_id,
      coalesce(list(item_id order by ts, tie) filter (later), []) as rel,
      coalesce(list(item_id order by ts, tie) filter (not later), []) as rec from ranked where rn <= 20 group by user_id),
    cut as (select user_id, rel, rec[1:10] as top from lists),
    calc as (select *, len(list_intersect(rel, top)) as hits,
      coalesce(list_sum([case when list_contains(rel, top[x]) then 1 / log2(x + 1) else 0 end for x in range(1, len(top) + 1)]), 0) as dcg,
      least(len(list_distinct(rel)), len(top)) as ideal,
      list_min([case when list_contains(rel, top[x]) then x end for x in range(1, len(top) + 1)]) as first_hit from cut)
    select user_id,
      round(case when ideal > 0 then dcg / list_sum([1 / log2(x + 1) for x in range(1, ideal + 1)]) else 0 end, 6) as ndcg,
      round(case when len(rel) > 0 then hits / len(rel) else 0 end, 6) as recall,
      round(case when len(top) > 0 then hits / len(top) else 0 end, 6) as precision,
      round(coalesce(1 / first_hit, 0), 6) as mrr from calc""",
)
def list_metrics(t: Tables) -> DataFrame:
    from tidemark.functions import ranking

    parts = {}
    for name, rows in (("rel", F.col("ts") >= EVENT_CUT), ("rec", F.col("ts") < EVENT_CUT)):
        built = sequences.user_sequences(t.events.filter(rows), EVENT_ORDER, CFG.max_len)
        parts[name] = built.select("user_id", F.col("items").alias(name))
    empty = F.array().cast("array<bigint>")
    both = parts["rel"].join(parts["rec"], "user_id", "full").select(
        "user_id", F.coalesce("rel", empty).alias("rel"), F.coalesce("rec", empty).alias("rec")
    )
    rel, rec = F.col("rel"), F.col("rec")
    return both.select(
        "user_id",
        ranking.ndcg_at_k(rel, rec, TOP).alias("ndcg"),
        ranking.recall_at_k(rel, rec, TOP).alias("recall"),
        ranking.precision_at_k(rel, rec, TOP).alias("precision"),
        ranking.mrr_at_k(rel, rec, TOP).alias("mrr"),
    )


@query(
    "masked_rank_eval",
    MASKED_SQL
    + """, idx_steps as (select user_id, idx, lead(idx) over (partition by user_id order by ts, tie) as next_idx
      from liked join vocab using (item_id)),
    nexts as (select idx as previous, next_idx as target,
      row_number() over (partition by idx order by count(*) desc, next_idx) as rank
      from idx_steps where next_idx is not null group by idx, next_idx),
    spots as (select user_id, pos, idx as target, mask, lag(idx) over (partition by user_id order by pos) as previous from settled)
    select round(avg(coalesce(1 / log2(rank + 1), 0)), 6) as ndcg,
      round(avg(case when rank is not null then 1.0::double else 0.0::double end), 6) as hit_rate, count(*) as num_positions
    from spots s left join nexts n on s.previous = n.previous and s.target = n.target and n.rank <= 10 where mask""",
)
def masked_rank_eval(t: Tables) -> DataFrame:
    liked = filters.positive(t.events)
    vocab = sequences.item_vocab(liked)
    built = sequences.masked_sequences(t.events, EVENT_ORDER, CFG, vocab)
    indexed = sequences.indexed_items(liked, vocab).select("user_id", F.col("idx").alias("item_id"), *EVENT_ORDER)
    return evaluation.masked_rank_eval(
        evaluation.masked_positions(built, CFG.ignore_label), evaluation.ranked_transitions(indexed, EVENT_ORDER, TOP), TOP
    )
