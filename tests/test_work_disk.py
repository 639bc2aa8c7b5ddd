"""What long jobs leave on disk or send on does not grow with their rounds."""

import random
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tidemark.config import FactorConfig
from tidemark.operators import factor, inner_product
from tidemark.plans import cycle
from tidemark.session import checkpoint_dir
from tidemark.streaming import jobs


def _ratings(spark, seed):
    rng = random.Random(seed)
    rows = [(u, i, rng.choice([1.0, 3.0, 5.0]), u * 20 + i) for u in range(12) for i in range(20) if rng.random() < 0.7]
    return spark.createDataFrame(rows, "user_id long, item_id long, rating double, ts long")


def test_every_iteration_lets_the_exchanges_before_it_go(spark, monkeypatch):
    asked = {}

    class Watched(factor.ALS):
        def __init__(self, **settings):
            asked.update(settings)
            super().__init__(**settings)

    monkeypatch.setattr(factor, "ALS", Watched)
    factor.fit_factors(_ratings(spark, 3), FactorConfig(rank=2, iterations=2))
    assert asked["checkpointInterval"] == 1 and spark.sparkContext.getCheckpointDir()


def test_a_search_keeps_no_state_of_ended_rounds(spark):
    rng = np.random.default_rng(6)
    frame = lambda m: spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)], "id long, features array<float>")
    shared = Path(checkpoint_dir(spark).removeprefix("file://"))
    before = set(shared.iterdir())
    found = inner_product.top_inner_products(
        frame(rng.normal(size=(20, 4))), frame(rng.normal(size=(300, 4))), spark.createDataFrame([(1, 2)], "user long, item long"), 5, 16, 1
    )
    assert found.count() == 100
    made = set(shared.iterdir()) - before
    assert not [p for top in made for p in top.rglob("open=true/*.parquet")]
    assert not [p for top in made if top.name.startswith("open-users") for p in top.rglob("*.parquet")]
    ended = [str(p) for top in made for p in top.glob("open=false")]
    assert ended and spark.read.parquet(*ended).filter(F.col("features").isNotNull()).isEmpty()


def test_predictions_meet_the_factors_once(spark):
    rows = _ratings(spark, 4)
    model = factor.fit_factors(rows, FactorConfig(rank=2, iterations=2))
    predicted = cycle._predicted(model, rows, ["ts", "user_id"])
    assert predicted.inputFiles() and predicted.columns == ["user_id", "rating", "est", "ts"]
    want = {(r.user_id, r.ts): r.est for r in model.predict(rows).collect()}
    assert {(r.user_id, r.ts): r.est for r in predicted.collect()} == want


def test_a_task_sends_a_user_on_once(spark):
    rng = random.Random(9)
    rows = [(u, rng.randrange(50), rng.randrange(10**6), tie) for tie, u in enumerate(rng.choices(range(10), k=5000))]
    frames = [pd.DataFrame(rows[at : at + 100], columns=["user_id", "item_id", "ts", "tie"]) for at in range(0, 5000, 100)]
    best = sorted(sorted(rows, key=lambda r: (r[0], r[2], r[3])), key=lambda r: r[0])
    want = [r for u in range(10) for r in [r for r in best if r[0] == u][-3:]]
    for at_once in (jobs.THIN_ROWS, 150):
        sent = pd.concat(list(jobs.thinned(3, at_once)(iter(frames))))
        assert sorted(sent.itertuples(index=False, name=None)) == sorted(want)
    # Users too many to be held go on in parts, none of their last rows is lost.
    sent = list(jobs.thinned(3, 40)(iter(frames)))
    assert len(sent) > 1 and set(want) <= {r for f in sent for r in f.itertuples(index=False, name=None)}
    # Rows with nulls go through, and leave the others whole numbers.
    holed = frames[0].astype(float)
    holed.loc[5, "item_id"] = None
    sent = list(jobs.thinned(3)(iter([frames[1], holed, frames[2]])))
    assert len(sent) == 2 and sent[1]["ts"].dtype == "int64"
