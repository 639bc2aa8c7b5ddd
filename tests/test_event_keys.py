"""Two events of one user and item in the same second are two events."""

import random
from datetime import datetime, timedelta

import pytest

from tidemark.config import EngineConfig, FactorConfig, SliceConfig, StorageConfig
from tidemark.operators import quality
from tidemark.plans import catalog
from tidemark.plans.cycle import run_cycle
from tidemark.sources.tables import EVENT_KEY, EVENT_ORDER
from tidemark.streaming import jobs


def test_registered_ingest_keeps_events_of_the_same_second(spark, tmp_path):
    start = datetime(2024, 1, 1)
    rows = [(copy * 60 + i, start + timedelta(hours=3 * i), i % 7, "view", 10.0 + i, f'{{"k": {i % 5}}}') for copy in range(3) for i in range(60)]
    events = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    events.write.parquet(str(tmp_path / "events.parquet"))
    got = catalog.QUERIES["stream_ingest"](spark, str(tmp_path))
    assert sorted(r.tie for r in got.collect()) == list(range(180))
    # The same event twice is still refused.
    events.union(events.limit(1)).write.parquet(str(tmp_path / "twice" / "events.parquet"))
    with pytest.raises(Exception, match="unique:"):
        catalog.QUERIES["stream_ingest"](spark, str(tmp_path / "twice"))


def test_quarantine_takes_the_asked_key(spark, ratings, tmp_path):
    rows = ratings([(1, 10, 4.0, 1), (1, 10, 4.0, 1), (2, 20, 9.0, 2)])
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = jobs.read_slices(spark, str(tmp_path / "in"), rows.schema)
    jobs.ingest(stream, str(tmp_path / "out"), str(tmp_path / "ck"), EVENT_ORDER, str(tmp_path / "bad"), 2, EVENT_KEY)
    assert sorted(r.tie for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [0, 1]
    assert [(r.tie, list(r.reasons)) for r in spark.read.parquet(str(tmp_path / "bad")).collect()] == [(2, ["range:rating"])]


def test_a_cycle_takes_events_of_the_same_second(spark, ratings, tmp_path):
    rng = random.Random(21)
    cfg = EngineConfig(slices=SliceConfig(days=20), factors=FactorConfig(rank=2, iterations=2), storage=StorageConfig(buckets=4))
    once = [(rng.randrange(15), rng.randrange(25), rng.choice([1.0, 3.5, 5.0]), t * 8640) for t in range(200)]
    master = ratings([*once, *once[:30]]).checkpoint()
    report = run_cycle(spark, master, str(tmp_path / "own"), EVENT_ORDER, cfg, EVENT_KEY).first()
    assert (report.num_released, report.num_new, report.num_history) == (230, 230, 230)
    with pytest.raises(quality.InvalidBatch):
        run_cycle(spark, master, str(tmp_path / "default"), EVENT_ORDER, cfg)
