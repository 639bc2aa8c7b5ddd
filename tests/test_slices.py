import pytest
from pyspark.sql import functions as F

from tidemark.operators import slices
from tidemark.sources import files, state

DAY = 86_400


def test_first_slice_and_strict_watermark(tiny):
    first = slices.next_slice(tiny, None, 30)
    assert first.count() == 30
    mark = first.agg(F.max("ts")).first()[0]
    second = slices.next_slice(tiny, mark, 30)
    assert second.agg(F.min("ts")).first()[0] > mark and second.count() == 30


def test_no_slice_after_the_end(tiny):
    assert slices.next_slice(tiny, tiny.agg(F.max("ts")).first()[0], 30).isEmpty()


def test_all_slices(tiny):
    assert sorted(map(tuple, slices.assign_slices(tiny, 30).groupBy("batch_id").count().collect())) == [
        (i, 30) for i in range(1, 11)
    ]


def test_chain_starts_at_the_data_not_on_a_grid(ratings):
    times = [100, 100 + DAY - 1, 100 + DAY + 50_000, 100 + 9 * DAY, 100 + 10 * DAY - 1, 100 + 10 * DAY]
    df = ratings([(1, 1, 4.0, ts) for ts in times])
    chain = [tuple(r) for r in slices.slice_chain(df, 1).orderBy("batch_id").collect()]
    starts = []
    rest = sorted(times)
    while rest:
        starts.append(rest[0])
        rest = [x for x in rest if x >= starts[-1] + DAY]
    assert [c[1] for c in chain] == starts
    assert slices.assign_slices(df, 1).count() == len(times)


def test_chain_matches_repeated_release(ratings):
    import random

    rng = random.Random(3)
    df = ratings([(1, 1, 4.0, rng.randrange(40 * DAY)) for _ in range(200)])
    mark, released = None, []
    while not (batch := slices.next_slice(df, mark, 3)).isEmpty():
        low, mark = batch.agg(F.min("ts"), F.max("ts")).first()
        released.append(low)
    assert [r.slice_start for r in slices.slice_chain(df, 3).orderBy("batch_id").collect()] == released


def test_metadata_and_running_total(tiny):
    meta = slices.slice_metadata(slices.assign_slices(tiny, 30))
    total = [r.total_ratings_released for r in slices.cumulative_release(meta).orderBy("batch_id").collect()]
    assert total == list(range(30, 301, 30))


def test_state_defaults_and_round_trip(spark, tmp_path):
    path = str(tmp_path / "state")
    assert state.load_state(spark, path) == state.ReleaseState()
    assert state.ReleaseState().high_water_mark(spark) is None
    saved = state.ReleaseState(3, "2015-01-31T00:00:00+00:00", 90, "x")
    state.save_state(spark, state.ReleaseState(2, "2015-01-01T00:00:00+00:00", 60, "x"), path)
    state.save_state(spark, saved, path)
    assert state.load_state(spark, path) == saved
    assert saved.high_water_mark(spark) == 1422662400


def test_slice_sink_replaces_only_its_own_slice(spark, tiny, tmp_path):
    path = str(tmp_path / "slices")
    files.write_slice(slices.assign_slices(tiny, 30), path)
    files.write_slice(tiny.limit(5).withColumn("batch_id", F.lit(3)), path)
    counts = dict(map(tuple, spark.read.parquet(path).groupBy("batch_id").count().collect()))
    assert counts[3] == 5 and counts[2] == 30 and len(counts) == 10


def test_metadata_record(spark, tiny, tmp_path):
    meta = slices.slice_metadata(slices.assign_slices(tiny, 30))
    path = str(tmp_path / "meta")
    files.write_slice_metadata(files.with_ingestion_time(meta, "v1", "/data/in"), path)
    row = spark.read.json(path).filter("batch_id = 2").first()
    assert row.num_interactions == 30 and row.batch_path == "/data/in/batch_id=2" and row.dataset_version == "v1"


def test_metric_log_skips_blank_lines(spark, tmp_path):
    path = str(tmp_path / "log")
    assert state.load_metric_log(spark, path).isEmpty()
    row = spark.createDataFrame(
        [(1, "rating", {"test_rmse": 0.9}, True)],
        "batch_id int, model_type string, metrics map<string,double>, promoted boolean",
    )
    state.log_metrics(row, path)
    (tmp_path / "log" / "extra.json").write_text('\n{"batch_id": 2, "model_type": "rating", "metrics": {}, "promoted": false}\n\n')
    assert sorted(r.batch_id for r in state.load_metric_log(spark, path).collect()) == [1, 2]


@pytest.mark.parametrize("dataset,layout", [("ml-1m", "dat"), ("ml-10m", "dat"), ("ml-25m", "csv"), ("ml-latest-small", "csv")])
def test_layouts(dataset, layout):
    assert files.layout_of(dataset) == layout


def test_text_layouts(spark, tmp_path):
    (tmp_path / "r.dat").write_text("1::10::4.5::100\n2::20::3::200\n")
    (tmp_path / "m.dat").write_bytes("5::Caf\xe9, The (1999)::Drama|Comedy\n".encode("latin-1"))
    (tmp_path / "m.csv").write_text('movieId,title,genres\n5,"Café, The (1999)",Drama\n')
    assert [tuple(r) for r in files.read_interactions(spark, str(tmp_path / "r.dat"), "dat").orderBy("user_id").collect()] == [
        (1, 10, 4.5, 100),
        (2, 20, 3.0, 200),
    ]
    assert files.read_items(spark, str(tmp_path / "m.dat"), "dat").first().title == "Café, The (1999)"
    assert files.read_items(spark, str(tmp_path / "m.csv"), "csv").first().title == "Café, The (1999)"
    with pytest.raises(ValueError):
        files.read_items(spark, str(tmp_path / "m.csv"), "xml")


def brute_chain(times, width):
    starts, rest = [], sorted(set(times))
    while rest:
        starts.append(rest[0])
        rest = [x for x in rest if x >= starts[-1] + width]
    return starts


def test_successors_cross_days_and_gaps(spark):
    import bisect
    import random

    rng = random.Random(6)
    times = sorted({rng.randrange(-3 * DAY, 60 * DAY) for _ in range(400)} | set(range(5 * DAY - 20, 5 * DAY + 20)) | {90 * DAY, 90 * DAY + 5})
    seconds = spark.createDataFrame([(t,) for t in times], "ts long")
    for width in (7, DAY, 3 * DAY, 400 * DAY):
        got = {r.ts: r.next for r in slices.successors(seconds, width).collect()}
        at = {t: bisect.bisect_left(times, t + width) for t in times}
        assert got == {t: times[k] if k < len(times) else None for t, k in at.items()}


def test_chains_of_every_length(spark, ratings):
    for count in (0, 1, 3, 4):
        df = ratings([(1, 1, 4.0, k * DAY) for k in range(count)] or [(1, 1, 4.0, 0)])
        df = df if count else df.limit(0)
        got = [(r.batch_id, r.slice_start) for r in slices.slice_chain(df, 1).orderBy("batch_id").collect()]
        assert got == [(k + 1, k * DAY) for k in range(count)]


def test_jobs_do_not_follow_the_number_of_slices(spark):
    """5,000 slices take a few jobs for each doubling, not one for each slice."""
    import random

    rng = random.Random(9)
    times = sorted({rng.randrange(12_000 * DAY) for _ in range(20_000)})
    df = spark.createDataFrame([(t,) for t in times], "ts long").checkpoint()
    sc = spark.sparkContext
    sc.setJobGroup("chain", "chain")
    try:
        chain = [r.slice_start for r in slices.slice_chain(df, 1).orderBy("batch_id").collect()]
        jobs = len(sc.statusTracker().getJobIdsForGroup("chain"))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert chain == brute_chain(times, DAY) and len(chain) > 5000
    assert jobs < 400
