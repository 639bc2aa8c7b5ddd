import random
from collections import Counter

import pytest

from tidemark.operators import recommend, transitions
from tidemark.operators.bias import fit_bias

ORDER = ("ts", "tie")


@pytest.fixture
def history(ratings):
    rng = random.Random(6)
    rows = [(u, min(int(rng.expovariate(0.15)), 29), rng.choice([1.0, 3.0, 5.0]), rng.randrange(10_000)) for u in range(10) for _ in range(rng.randrange(1, 40))]
    # One user has seen everything.
    rows += [(50, i, 3.0, i) for i in range(30)]
    return ratings(rows)


def users_of(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "user_id long")


@pytest.mark.parametrize("n", [1, 5, 100])
def test_first_unseen_against_brute_force(spark, history, n):
    rows = history.collect()
    counts = Counter(r.item_id for r in rows)
    ranking = sorted(counts, key=lambda i: (-counts[i], i))
    users = [0, 1, 2, 3, 50, 777]
    got = recommend.first_unseen(users_of(spark, users), recommend.popularity_order(history), history, n).collect()
    for u in users:
        seen = {r.item_id for r in rows if r.user_id == u}
        want = [i for i in ranking if i not in seen][:n]
        assert [r.item_id for r in sorted((r for r in got if r.user_id == u), key=lambda r: r.rank)] == want


def test_best_unseen_by_bias_against_brute_force(spark, history):
    model = fit_bias(history)
    items = {r.item_id: r.item_bias for r in model.items.collect()}
    rows = history.collect()
    got = recommend.best_unseen_by_bias(model, users_of(spark, [0, 1, 50]), history, 4).collect()
    for u in (0, 1, 50):
        seen = {r.item_id for r in rows if r.user_id == u}
        want = sorted((i for i in items if i not in seen), key=lambda i: (-items[i], i))[:4]
        assert [r.item_id for r in sorted((r for r in got if r.user_id == u), key=lambda r: r.rank)] == want
    assert all(0.5 <= r.score <= 5.0 for r in got)


def test_popular_and_cold_start(spark, history):
    counts = Counter(r.item_id for r in history.collect())
    want = sorted(counts, key=lambda i: (-counts[i], i))[:3]
    assert [r.item_id for r in recommend.popular_items(history, 3).orderBy("rank").collect()] == want
    cold = recommend.cold_start_recs(users_of(spark, [0, 900, 901, 901]), history, 3).orderBy("user_id", "rank").collect()
    assert [(r.user_id, r.item_id) for r in cold] == [(u, i) for u in (900, 901) for i in want]


def test_enrich_fills_unknown_and_rounds(spark):
    recs = spark.createDataFrame([(1, 1, 4.123456), (1, 2, None)], "user_id long, item_id long, score double")
    items = spark.createDataFrame([(1, "T", None)], "item_id long, title string, genres string")
    got = {r.item_id: (r.score, r.title, r.genres) for r in recommend.enrich(recs, items).collect()}
    assert got == {1: (4.1235, "T", "Unknown"), 2: (0.0, "Unknown", "Unknown")}


def test_top_n_limits_and_breaks_ties(spark):
    scored = spark.createDataFrame([(1, i, 1.0) for i in (3, 1, 2)], "user_id long, item_id long, score double")
    assert [r.item_id for r in recommend.top_n(scored, 2).orderBy("rank").collect()] == [1, 2]


def test_score_share(spark):
    options = spark.createDataFrame([(1, 1, 3.0), (1, 2, 1.0), (2, 1, 0.0)], "user_id long, item_id long, score double")
    got = {(r.user_id, r.item_id): (r.pct_of_total, r.pct_of_max, r.is_best) for r in recommend.score_share(options).collect()}
    assert got == {(1, 1): (75.0, 100.0, True), (1, 2): (25.0, 33.3, False), (2, 1): (None, None, True)}


def test_option_sets(spark, history):
    ranked = recommend.popularity_order(history)
    users = users_of(spark, [0, 1, 2, 50, 777])
    recs = spark.createDataFrame([(0, r, 100 + r) for r in range(1, 9)] + [(1, 1, 5)], "user_id long, rank int, item_id long")
    got = recommend.option_sets(recs, users, ranked, history).collect()
    sets = {u: sorted((r.slot, r.item_id) for r in got if r.user_id == u) for u in (0, 1, 2, 50, 777)}
    assert len(sets[0]) == 4 and sets[0][0] == (1, 101) and {i for _, i in sets[0]} <= set(range(101, 109))
    for u in (1, 2, 777):
        seen = {r.item_id for r in history.filter(f"user_id = {u}").collect()}
        assert len({i for _, i in sets[u]}) == 4 and not seen & {i for _, i in sets[u]}
    assert sets[50] == []


def test_coverage(spark):
    recs = spark.createDataFrame([(1, 1), (2, 1), (2, 2)], "user_id long, item_id long")
    assert tuple(recommend.coverage(recs, spark.range(8).withColumnRenamed("id", "item_id")).first()) == (2, 8, 0.25)


def test_transitions_and_next_items(ratings):
    df = ratings([(1, i, 4.0, t) for t, i in enumerate([1, 2, 1, 2, 3])] + [(2, i, 4.0, t) for t, i in enumerate([1, 2])])
    moves = transitions.item_transitions(df, ORDER)
    assert {(r.item_id, r.next_item): (r.moves, r.prob) for r in moves.collect()} == {
        (1, 2): (3, 1.0), (2, 1): (1, 0.5), (2, 3): (1, 0.5)
    }
    recs = transitions.next_item_recs(df, moves, ORDER, decay=0.5).collect()
    assert [(r.user_id, r.item_id, r.score) for r in recs] == [(2, 3, 0.5)]
