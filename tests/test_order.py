import random

import pytest
from pyspark.sql import Window, functions as F

from tidemark.functions.columns import calendar_day
from tidemark.operators import order

DAY = 86_400


@pytest.fixture
def skewed(spark):
    """Half of the rows belong to one user and share one second."""
    rng = random.Random(1)
    rows = [(7, 1000, i, rng.randrange(5)) for i in range(300)]
    rows += [(rng.randrange(20), rng.randrange(5 * DAY), 300 + i, rng.randrange(5)) for i in range(300)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "user_id long, ts long, tie long, item_id long").repartition(5)


def test_global_positions_match_a_plain_sort(skewed):
    placed = order.global_positions(skewed, ["ts", "tie"]).collect()
    got = [(r.ts, r.tie) for r in sorted(placed, key=lambda r: r.position)]
    assert got == sorted((r.ts, r.tie) for r in skewed.collect())
    assert sorted(r.position for r in placed) == list(range(1, 601))


def test_segments_split_a_hot_second(skewed):
    sizes = [r["count"] for r in order.ordered_segments(skewed, ["ts", "tie"], 6).groupBy("_seg").count().collect()]
    assert len(sizes) > 3 and max(sizes) < 250


@pytest.mark.parametrize("limit", [10, 5_000_000])
def test_rank_cuts_on_both_paths(skewed, monkeypatch, limit):
    monkeypatch.setattr(order, "GROUP_ROWS_LIMIT", limit)
    want = sorted((r.ts, r.tie) for r in skewed.collect())
    n, cuts = order.rank_cuts(skewed, ["ts", "tie"], calendar_day(F.col("ts")), lambda n: [0, 1, 250, n, n + 1])
    assert n == 600
    assert cuts == [None, want[0], want[249], want[599], None]


@pytest.mark.parametrize("limit", [20, 5_000_000])
def test_following_on_both_paths(skewed, monkeypatch, limit):
    monkeypatch.setattr(order, "GROUP_ROWS_LIMIT", limit)
    got = order.following(skewed, "user_id", ["ts", "tie"], ["item_id"])
    window = Window.partitionBy("user_id").orderBy("ts", "tie")
    want = skewed.select("*", F.lead("item_id").over(window).alias("next_item_id"))
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))


def test_running_sums_with_previous_value(spark):
    rng = random.Random(2)
    rows = [(c, float(v), rng.randrange(5)) for c in "ab" for v in rng.sample(range(1000), 200)]
    df = spark.createDataFrame(rows, "column string, value double, n long").repartition(4)
    got = {(r.column, r.value): (r.cum_n, r.prev_value) for r in order.running_sums(df, "column", "value", ["n"], True).collect()}
    for c in "ab":
        total, before = 0, None
        for _, value, n in sorted(r for r in rows if r[0] == c):
            total += n
            assert got[c, value] == (total, before)
            before = value


def test_even_buckets_do_not_decrease(spark):
    df = spark.createDataFrame([(v,) for v in (-5, 0, 3, 10**12)], "user_id long")
    buckets = [r[0] for r in df.select(order.even_buckets(df, "user_id")).collect()]
    assert buckets == sorted(buckets) and buckets[-1] < order.HISTOGRAM_BUCKETS
