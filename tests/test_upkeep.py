import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.config import SequenceConfig
from tidemark.operators import monitor, sequences
from tidemark.operators.audience import AudienceStore
from tidemark.operators.upkeep import SequenceStore, rebuilt_vocabulary

ORDER = ("ts", "tie")
CFG = SequenceConfig(max_len=6, min_len=3)


@pytest.fixture(scope="module")
def batches(spark):
    rng = random.Random(21)
    rows, tie = [], 0
    for number in (1, 2, 3):
        for _ in range(150):
            rows.append((rng.randrange(25) if number < 3 else rng.randrange(6), rng.randrange(10 * number), rng.choice([1.0, 3.5, 5.0]), 1000 * number + rng.randrange(900), tie, number))
            tie += 1
    return spark.createDataFrame(rows, "user_id long, item_id long, rating double, ts long, tie long, batch_id int").checkpoint()


def part(batches, number):
    return batches.filter(F.col("batch_id") == number)


def table(df):
    return sorted(map(str, df.collect()))


def test_three_updates_equal_a_rebuild(spark, batches, tmp_path):
    store = SequenceStore.of(batches, str(tmp_path), ORDER, CFG, buckets=4)
    for number in (1, 2, 3):
        store.update(part(batches, number), number)
        pool = batches.filter(F.col("batch_id") <= number)
        vocab = rebuilt_vocabulary(pool)
        assert table(store.vocabulary()) == table(vocab)
        built = sequences.masked_sequences(pool, ORDER, CFG, vocab)
        assert table(store.sequences()) == table(built)
    numbers = [r.idx for r in store.vocabulary().collect()]
    assert sorted(numbers) == list(range(1, len(numbers) + 1))


def test_numbers_of_items_never_change(spark, batches, tmp_path):
    store = SequenceStore.of(batches, str(tmp_path), ORDER, CFG, buckets=2)
    store.update(part(batches, 1), 1)
    first = {r.item_id: r.idx for r in store.vocabulary().collect()}
    store.update(part(batches, 2), 2)
    later = {r.item_id: r.idx for r in store.vocabulary().collect()}
    assert first.items() <= later.items() and len(later) > len(first)


def test_a_batch_that_died_is_run_again(spark, batches, tmp_path):
    once, twice = (SequenceStore.of(batches, str(tmp_path / n), ORDER, CFG, buckets=4) for n in ("a", "b"))
    for number in (1, 2):
        once.update(part(batches, number), number)
        twice.update(part(batches, number), number)
        twice.update(part(batches, number), number)
    assert table(once.sequences()) == table(twice.sequences()) and table(once.last_rows()) == table(twice.last_rows())


def test_untouched_buckets_are_neither_read_nor_written(spark, batches, tmp_path):
    store = SequenceStore.of(batches, str(tmp_path), ORDER, CFG, buckets=8)
    store.update(part(batches, 1), 1)
    small = batches.filter("batch_id = 2 and user_id in (1, 2)")
    touched = {r[0] for r in small.select(store.bucket_of(F.col("user_id"))).collect()}
    kept = {f: f.read_bytes() for f in Path(tmp_path).rglob("batch_id=1/bucket=*/*.parquet") if int(f.parent.name.split("=")[1]) not in touched}
    assert kept
    for f in kept:
        f.write_bytes(b"not parquet")  # whoever opens it fails
        (f.parent / f".{f.name}.crc").unlink()
    store.update(small, 2)
    written = {int(f.parent.name.split("=")[1]) for f in Path(tmp_path).rglob("batch_id=2/bucket=*/*.parquet")}
    assert written <= touched
    for f, content in kept.items():
        f.write_bytes(content)
    pool = part(batches, 1).unionByName(small)
    assert table(store.sequences()) == table(sequences.masked_sequences(pool, ORDER, CFG, rebuilt_vocabulary(pool)))


def test_batches_without_likes_and_repeated_rows(spark, batches, tmp_path):
    store = SequenceStore.of(batches, str(tmp_path), ORDER, CFG, buckets=2)
    store.update(part(batches, 1).filter("rating < 2"), 1)
    assert store.sequences().count() == store.vocabulary().count() == store.last_rows().count() == 0
    doubled = part(batches, 2).unionByName(part(batches, 2))
    store.update(doubled, 2)
    assert table(store.sequences()) == table(sequences.masked_sequences(doubled, ORDER, CFG, rebuilt_vocabulary(doubled)))


def test_audience_equals_the_regrouped_form(spark, batches, tmp_path):
    wide = batches.withColumn("user_id", F.when(F.col("user_id") % 5 == 0, F.col("user_id") * 100_003 - 7).otherwise(F.col("user_id")))
    store = AudienceStore(spark, str(tmp_path))
    for number in (1, 2, 3):
        store.update(part(wide, number), number)
    store.update(part(wide, 3), 3)
    want = monitor.batch_monitoring(wide)
    assert table(store.reports().select(*want.columns)) == table(want)


def test_audience_needs_no_earlier_rows(spark, batches, tmp_path):
    for number in (1, 2):
        part(batches, number).write.parquet(str(tmp_path / f"rows{number}"))
    store = AudienceStore(spark, str(tmp_path / "store"))
    store.update(spark.read.parquet(str(tmp_path / "rows1")), 1)
    for f in (tmp_path / "rows1").glob("*.parquet"):
        f.write_bytes(b"not parquet")
    row = store.update(spark.read.parquet(str(tmp_path / "rows2")), 2).first()
    want = monitor.batch_monitoring(batches).filter("batch_id = 2").first()
    assert (row.new_users, row.active_items, row.new_items) == (want.new_users, want.active_items, want.new_items)


def test_audience_of_odd_batches(spark, batches, tmp_path):
    store = AudienceStore(spark, str(tmp_path))
    empty = store.update(batches.limit(0), 1).first()
    assert (empty.num_interactions, empty.mean_rating, empty.active_users, empty.new_items) == (0, None, 0, 0)
    nulls = spark.createDataFrame([(None, 1, 4.0), (2, None, 4.0), (0, -3, 4.0), (2**62, -(2**40), 4.0)], "user_id long, item_id long, rating double")
    row = store.update(nulls, 2).first()
    assert (row.num_interactions, row.active_users, row.new_users, row.active_items, row.new_items) == (4, 3, 3, 3, 3)
