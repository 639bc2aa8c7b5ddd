import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.config import FactorConfig
from tidemark.operators import evaluation, factor
from tidemark.operators.bias import fit_bias
from tidemark.plans import catalog, models, streams
from tidemark.plans.registry import Tables
from tidemark.plans.rows import LINE_CUT

CFG = FactorConfig(rank=4, iterations=8, reg=0.05)


@pytest.fixture(scope="module")
def planted(spark):
    """Ratings from planted biases and rank-2 factors; ids beyond 32 bits."""
    rng = np.random.default_rng(7)
    p, q = rng.normal(size=(60, 2)), rng.normal(size=(40, 2))
    rows = [
        (int(u) + 2**40, int(i), float(np.clip(3 + 0.5 * (p[u] @ q[i]), 0.5, 5)))
        for u in range(60) for i in range(40) if rng.random() < 0.6
    ]
    random.Random(8).shuffle(rows)
    return spark.createDataFrame(rows, "user_id long, item_id long, rating double").checkpoint()


def test_bias_against_brute_force(spark, ratings):
    rows = [(1, 1, 5.0, 1), (1, 2, 3.0, 2), (2, 1, 4.0, 3), (2, 1, 1.0, 4)]
    model = fit_bias(ratings(rows), damping=2.0)
    mean = 13 / 4
    item = {i: sum(r[2] - mean for r in rows if r[1] == i) / (sum(r[1] == i for r in rows) + 2) for i in (1, 2)}
    user = {u: sum(r[2] - mean - item[r[1]] for r in rows if r[0] == u) / (2 + 2) for u in (1, 2)}
    assert {r.item_id: r.item_bias for r in model.items.collect()} == pytest.approx(item)
    assert {r.user_id: r.user_bias for r in model.users.collect()} == pytest.approx(user)
    new = spark.createDataFrame([(1, 2), (9, 9), (1, 9)], "user_id long, item_id long")
    got = {(r.user_id, r.item_id): r.est for r in model.predict(new).collect()}
    assert got == pytest.approx({(1, 2): mean + item[2] + user[1], (9, 9): mean, (1, 9): mean + user[1]})


def test_estimates_are_clipped(ratings):
    model = fit_bias(ratings([(1, 1, 5.0, 1), (2, 2, 0.5, 2)]), damping=0.0)
    assert all(0.5 <= r.est <= 5.0 for r in model.predict(ratings([(1, 1, 0.0, 0), (2, 2, 0.0, 0)])).collect())


def test_no_ratings_is_an_error(ratings):
    with pytest.raises(ValueError):
        fit_bias(ratings([(1, 1, 1.0, 1)]).limit(0))


def test_factors_beat_the_mean_and_the_biases(planted):
    train, test = planted.filter(F.hash("user_id", "item_id") % 5 != 0), planted.filter(F.hash("user_id", "item_id") % 5 == 0)
    model = factor.fit_factors(train, CFG)
    error = lambda df: evaluation.rating_errors(df).first().rmse
    mean = error(test.withColumn("est", F.lit(model.bias.mean)))
    biased = error(model.bias.predict(test))
    assert error(model.predict(test)) < min(mean, biased) * 0.8
    assert model.user_ids is not None and model.item_ids is None


def test_unknown_pairs_fall_back_to_biases(spark, planted):
    model = factor.fit_factors(planted, CFG)
    new = spark.createDataFrame([(1, 1), (2**40, 999), (5, 999)], "user_id long, item_id long")
    got = {(r.user_id, r.item_id): r.est for r in model.predict(new).collect()}
    want = {(r.user_id, r.item_id): r.est for r in model.bias.predict(new).collect()}
    assert got == pytest.approx(want)


def test_factor_top_n_against_brute_force(spark, planted):
    ranker = factor.fit_ranker(planted, CFG)
    users = spark.createDataFrame([(2**40 + u,) for u in (0, 1, 2)], "user_id long")
    got = factor.factor_top_n(ranker, planted, users, 5).collect()
    items = planted.select("item_id").distinct()
    pairs = users.join(items, F.lit(True)).join(planted, ["user_id", "item_id"], "left_anti")
    want = {}
    for r in ranker.predict(pairs).collect():
        want.setdefault(r.user_id, []).append((-r.est, r.item_id))
    for u, scored in want.items():
        best = sorted(scored)[:5]
        mine = sorted((r for r in got if r.user_id == u), key=lambda r: r.rank)
        assert [-r.score for r in mine] == pytest.approx([s for s, _ in best], abs=1e-5)
        assert not {r.item_id for r in mine} & {r.item_id for r in planted.filter(F.col("user_id") == u).collect()}


def test_registered_lists_cover_all_users_with_the_default_model(spark):
    sf_dir = "/root/testdata/sf0.001"
    past = Tables(spark, sf_dir).lines.filter(F.col("ts") < LINE_CUT)
    lists = catalog.QUERIES["mf_top_n"](spark, sf_dir)
    assert {r.user_id for r in lists.collect()} == {r.user_id for r in past.select("user_id").distinct().collect()}
    assert models.FACTORS == streams.CYCLE.factors == FactorConfig()
