import random

import numpy as np
import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from tidemark.operators import drift, gate, monitor


@pytest.fixture
def log(spark):
    def build(rows):
        return spark.createDataFrame(rows, "model_type string, batch_id int, metrics map<string,double>")

    return build


def promoted(df, kind):
    return [r.promoted for r in df.filter(F.col("model_type") == kind).orderBy("batch_id").collect()]


def test_promotion_follows_the_champion(log):
    rmse = [1.0, 0.996, 0.994, 0.99, 0.98]
    ndcg = [0.5, 0.501, 0.5011, 0.4, 0.6]
    history = gate.promotion_history(
        log([("rating", i, {"test_rmse": v}) for i, v in enumerate(rmse)] + [("sequence", i, {"ndcg@10": v}) for i, v in enumerate(ndcg)])
    )
    assert promoted(history, "rating") == [True, False, True, False, True]
    assert promoted(history, "sequence") == [True, False, True, False, True]
    assert {r.model_type: r.batch_id for r in gate.current_champion(history).collect()} == {"rating": 4, "sequence": 4}


def test_promotion_against_a_loop(log):
    rng = random.Random(9)
    values = [round(rng.uniform(0.8, 1.0), 3) for _ in range(60)]
    got = promoted(gate.promotion_history(log([("rating", i, {"test_rmse": v}) for i, v in enumerate(values)])), "rating")
    champion, want = None, []
    for v in values:
        want.append(champion is None or v < champion - 0.005)
        champion = v if want[-1] else champion
    assert got == want


def test_missing_metrics_and_unknown_types(log):
    history = gate.promotion_history(log([("rating", 1, {}), ("rating", 2, {"test_rmse": 9.0}), ("sequence", 1, {"ndcg@10": 0.1}), ("sequence", 2, {})]))
    assert promoted(history, "rating") == [True, True] and promoted(history, "sequence") == [True, False]
    with pytest.raises(SparkRuntimeException):
        gate.promotion_history(log([("other", 1, {})])).collect()


def test_strict_gate(spark):
    df = spark.createDataFrame([("s", i, v) for i, v in enumerate([1.0, 1.0, 0.999, 1.5])], "series string, batch_id int, rmse double")
    assert [r.promoted for r in gate.strict_gate(df).orderBy("batch_id").collect()] == [True, False, True, False]


def test_cycle_candidate(log):
    rows = [("rating", 1, {"test_rmse": 1.0}), ("sequence", 1, {"ndcg@10": 0.2}), ("rating", 2, {"test_rmse": 1.0}), ("rating", 3, {"test_rmse": 1.0}), ("sequence", 3, {})]
    assert {r.batch_id: r.model_type for r in gate.cycle_candidate(log(rows)).collect()} == {1: "sequence", 2: "rating", 3: "rating"}


@pytest.mark.parametrize(
    "key,values,expected",
    [
        ("test_rmse", [0.8, 0.9, 1.0], True),
        ("test_rmse", [9.0, 0.8, 0.9, 1.0], True),
        ("test_rmse", [0.8, 0.9, 0.9], False),
        ("Test_RMSE", [0.8, 0.9, 1.0], True),
        ("ndcg@10", [0.9, 0.8, 0.7], True),
        ("ndcg@10", [0.7, 0.8, 0.9], False),
        ("ndcg@10", [0.9, 0.8], False),
        ("ndcg@10", [0.9, None, 0.7], False),
    ],
)
def test_degradation(log, key, values, expected):
    rows = [("m", i, {} if v is None else {key: v}) for i, v in enumerate(values)]
    assert [r.degraded for r in gate.degradation(log(rows), [key]).collect()] == [expected]


@pytest.fixture
def samples(spark):
    rng = np.random.default_rng(10)
    ref = spark.createDataFrame([(float(r), int(t)) for r, t in zip(rng.integers(1, 11, 400) / 2, rng.integers(0, 10**6, 400))], "rating double, ts long")
    cur = spark.createDataFrame([(float(r), int(t)) for r, t in zip(rng.integers(3, 11, 150) / 2, rng.integers(0, 10**6, 150))], "rating double, ts long")
    return ref, cur


def test_distances_against_numpy(samples):
    ref, cur = (df.toPandas() for df in samples)
    for r in drift.drift_distances(*samples).collect():
        a, b = np.sort(ref[r.column].astype(float)), np.sort(cur[r.column].astype(float))
        grid = np.unique(np.concatenate([a, b]))
        f, g = (np.searchsorted(x, grid, side="right") / len(x) for x in (a, b))
        assert r.ks == pytest.approx(np.abs(f - g).max())
        assert r.wasserstein == pytest.approx((np.abs(f - g)[:-1] * np.diff(grid)).sum())
        assert r.ref_std == pytest.approx(a.std()) and (r.n_ref, r.n_cur) == (400, 150)


def test_drift_verdicts(samples):
    ref, cur = samples
    both = {r.column: r for r in drift.column_drift(drift.drift_distances(ref, cur)).collect()}
    assert both["rating"].method == "ks" and both["rating"].drifted and not both["ts"].drifted
    row = drift.detect_drift(ref, cur).first()
    assert row.drift_share == 0.5 and row.drift_detected
    assert not drift.detect_drift(ref, cur, share=0.6).first().drift_detected
    assert not drift.detect_drift(ref, ref).first().drift_detected
    assert not drift.detect_drift(ref, cur.limit(9)).first().drift_detected
    assert not drift.detect_drift(ref, cur.limit(0)).first().drift_detected
    assert {r.method for r in drift.column_drift(drift.drift_distances(ref, cur), "wasserstein").collect()} == {"wasserstein"}


def test_monitoring_and_trigger(spark):
    rows = [(1, 1, 1, 4.0, 0), (1, 1, 2, 4.0, 5), (1, 2, 1, 2.0, 9), (2, 2, 1, 3.0, 86_400), (2, 3, 9, 3.0, 86_401)]
    df = spark.createDataFrame(rows, "batch_id int, user_id long, item_id long, rating double, ts long")
    seen = {r.batch_id: r for r in monitor.batch_monitoring(df).collect()}
    assert (seen[1].num_interactions, seen[1].active_users, seen[1].new_users, seen[1].new_items) == (3, 2, 2, 2)
    assert (seen[2].num_interactions, seen[2].active_users, seen[2].new_users, seen[2].active_items, seen[2].new_items) == (2, 2, 1, 2, 1)
    assert monitor.rating_histogram(df).count() == 3
    from tidemark.operators.slices import slice_metadata

    flags = lambda name, values: spark.createDataFrame(list(values.items()), f"batch_id int, {name} boolean")
    got = {
        r.batch_id: (r.schedule_due, r.enough_rows, r.drift_detected, r.degraded, r.retrain)
        for r in monitor.retrain_trigger(
            monitor.batch_monitoring(df), slice_metadata(df), flags("drift_detected", {2: False}), flags("degraded", {1: False}), 14, 3
        ).collect()
    }
    assert got == {1: (True, True, False, False, True), 2: (False, False, False, False, False)}


def two_sides(spark, reference, current):
    frame = lambda values: spark.createDataFrame([(float(a), float(b)) for a, b in values], "rating double, ts double")
    return frame(reference), frame(current)


@pytest.mark.parametrize("shift", [0.02, 0.1])
def test_sketches_hold_the_exact_score_in_their_band(spark, shift):
    rng = np.random.default_rng(int(shift * 100))
    reference = list(zip(rng.integers(1, 11, 6000) / 2, rng.normal(0, 1, 6000) * 1e6 + 1.7e9))
    current = list(zip(np.clip(rng.integers(1, 11, 5000) / 2 + shift, 0.5, 5), rng.normal(shift, 1, 5000) * 1e6 + 1.7e9))
    ref, cur = two_sides(spark, reference, current)
    numbered = lambda df, parts: df.withColumn("batch_id", (F.monotonically_increasing_id() % parts).cast("int"))
    sketches = drift.column_sketches(numbered(ref, 5)), drift.column_sketches(numbered(cur, 3))
    exact_distances = drift.drift_distances(ref, cur)
    for method in ("ks", "wasserstein"):
        exact = {r["column"]: r for r in drift.column_drift(exact_distances, method).collect()}
        found = {r["column"]: r for r in drift.sketched_drift(*sketches, method).collect()}
        assert exact.keys() == found.keys()
        for name, row in found.items():
            assert (row.n_ref, row.n_cur) == (6000, 5000) and row.ref_std == pytest.approx(exact[name].ref_std)
            assert abs(row.score - exact[name].score) <= row.band
            assert not row.certain or row.drifted == exact[name].drifted
        asked = []

        def ask(columns):
            asked.extend(columns)
            return exact_distances.filter(F.col("column").isin(list(columns)))

        verdict = drift.detect_drift_from_sketches(*sketches, ask, method).first()
        assert tuple(verdict) == tuple(drift.dataset_drift(drift.column_drift(exact_distances, method)).first())
        assert sorted(asked) == sorted(n for n, r in found.items() if not r.certain)


def test_clear_drift_needs_no_exact_path(spark):
    ref, cur = two_sides(spark, [(1 + k % 3, k) for k in range(3000)], [(4, k + 9000) for k in range(500)])
    one = lambda df: drift.column_sketches(df.withColumn("batch_id", F.lit(1)))

    def never(columns):
        raise AssertionError(columns)

    assert drift.detect_drift_from_sketches(one(ref), one(cur), never).first().drift_detected
