import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions import columns, ranking
from tidemark.operators import evaluation

# relevant, recommended, k -> ndcg, recall, precision, mrr
CASES = [
    ([1, 2], [1, 2, 3], None, 1.0, 1.0, 2 / 3, 1.0),
    ([1, 2], [3, 1], 5, (1 / math.log2(3)) / (1 + 1 / math.log2(3)), 0.5, 0.5, 0.5),
    ([1], [2, 3, 1], 2, 0.0, 0.0, 0.0, 0.0),
    ([], [1, 2], 2, 0.0, 0.0, 0.0, 0.0),
    ([1], [], 3, 0.0, 0.0, 0.0, 0.0),
    ([1, 1], [1], 3, 1.0, 0.5, 1.0, 1.0),
    ([1], [1, 1], 3, 1 + 1 / math.log2(3), 1.0, 0.5, 1.0),
]


@pytest.mark.parametrize("relevant,recommended,k,ndcg,recall,precision,mrr", CASES)
def test_list_metrics(spark, relevant, recommended, k, ndcg, recall, precision, mrr):
    df = spark.createDataFrame([(relevant, recommended)], "a array<long>, b array<long>")
    a, b = F.col("a"), F.col("b")
    got = df.select(
        ranking.ndcg_at_k(a, b, k), ranking.recall_at_k(a, b, k), ranking.precision_at_k(a, b, k), ranking.mrr_at_k(a, b, k)
    ).first()
    assert list(got) == pytest.approx([ndcg, recall, precision, mrr])


def test_hit_rate(spark):
    df = spark.createDataFrame([(3, [1, 2, 3])], "t long, b array<long>")
    got = df.select(*[ranking.hit_rate_at_k(F.col("t"), F.col("b"), k) for k in (None, 3, 2)]).first()
    assert list(got) == [1.0, 1.0, 0.0]


def test_join_form_agrees_with_list_form(spark):
    rng = random.Random(5)
    relevant = [(u, rng.randrange(15)) for u in range(20) for _ in range(rng.randrange(8))]
    recommended = [(u, r + 1, i) for u in range(2, 25) for r, i in enumerate([rng.randrange(15) for _ in range(rng.randrange(12))])]
    rel = spark.createDataFrame(relevant, "user_id long, item_id long")
    rec = spark.createDataFrame(recommended, "user_id long, rank int, item_id long")
    got = {r.user_id: r for r in evaluation.ranking_metrics(rel, rec, 5).collect()}
    empty = F.array().cast("array<bigint>")
    lists = rel.groupBy("user_id").agg(F.collect_list("item_id").alias("a")).join(
        rec.groupBy("user_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "item_id"))), lambda e: e["item_id"]).alias("b")),
        "user_id", "full",
    ).select("user_id", F.coalesce("a", empty).alias("a"), F.coalesce("b", empty).alias("b"))
    a, b = F.col("a"), F.col("b")
    for r in lists.select("user_id", ranking.ndcg_at_k(a, b, 5).alias("n"), ranking.recall_at_k(a, b, 5).alias("r"),
                          ranking.precision_at_k(a, b, 5).alias("p"), ranking.mrr_at_k(a, b, 5).alias("m")).collect():
        m = got[r.user_id]
        assert [m.ndcg, m.recall, m.precision, m.mrr] == pytest.approx([r.n, r.r, r.p, r.m])
        assert m.hit_rate == (1.0 if r.m > 0 else 0.0)
    assert len(got) == lists.count()


def test_precision_recall_ties_and_short_lists(spark):
    rows = [(1, 5.0, 3.0, 1), (1, 2.0, 3.0, 2), (1, 4.0, 3.0, 3), (2, 1.0, 4.0, 4)]
    df = spark.createDataFrame(rows, "user_id long, rating double, est double, ts long")
    row = evaluation.precision_recall(df, ["ts"], k=2).first()
    # User 1 keeps time order among equal estimates: one of two relevant rows in the top 2.
    assert tuple(row) == (0.25, 0.25, 2)


def test_errors(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0)], "rating double, est double")
    assert tuple(evaluation.rating_errors(df).first()) == (pytest.approx(math.sqrt(0.5)), 0.5, 2)


def test_masked_rank_eval(spark):
    positions = spark.createDataFrame([(1, 1, 5, 9), (1, 2, 6, 9), (2, 0, 5, None)], "user_id long, pos int, target int, previous int")
    ranked = spark.createDataFrame([(9, 1, 4), (9, 2, 5), (9, 3, 6)], "previous int, rank int, target int")
    row = evaluation.masked_rank_eval(positions, ranked, 2).first()
    assert tuple(row) == (pytest.approx((1 / math.log2(3)) / 3), pytest.approx(1 / 3), 3)


def test_scalar_columns(spark):
    df = spark.createDataFrame(
        [("A (1999)", {"x": 1.0, "y": 2.0}, {"y": 3.0}, [1, 2, 3]), ("B (1999) x", {}, {"y": 3.0}, []), (None, None, None, None)],
        "t string, l map<string,double>, r map<string,double>, a array<int>",
    )
    rows = df.select(
        columns.release_year(F.col("t")).alias("y"),
        columns.merge_maps(F.col("l"), F.col("r")).alias("m"),
        columns.map_value(F.col("l"), "x", 9.0).alias("v"),
        columns.last_n(F.col("a"), 2).alias("tail"),
        columns.first_n(F.col("a"), 2).alias("head"),
        columns.slice_label(F.lit(7)).alias("label"),
        columns.iso_time(F.lit(0)).alias("iso"),
        columns.calendar_day(F.lit(-1)).alias("day"),
        columns.event_time(F.lit(0)).cast("string").alias("when"),
        columns.plus_days(F.lit(1), 2).alias("later"),
    ).collect()
    assert rows[0].y == 1999 and rows[1].y is None and rows[2].y is None
    assert rows[0].m == {"x": 1.0, "y": 3.0} and rows[1].m == {"y": 3.0}
    assert [r.v for r in rows] == [1.0, 9.0, 9.0]
    assert rows[0].tail == [2, 3] and rows[0].head == [1, 2] and rows[1].tail == []
    assert (rows[0].label, rows[0].iso, rows[0].day) == ("batch_007", "1970-01-01T00:00:00+00:00", -1)
    assert (rows[0].when, rows[0].later) == ("1970-01-01 00:00:00", 172801)
