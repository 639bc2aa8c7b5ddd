import pytest

from tidemark.config import SequenceConfig
from tidemark.operators import evaluation, sequences
from tidemark.sources import files

ORDER = ("ts", "tie")


@pytest.fixture
def sample(ratings):
    """Three users with ten hourly likes each, items disjoint."""
    return ratings([(u, u * 100 + i, 4.0, 1_600_000_000 + i * 3600) for u in (1, 2, 3) for i in range(10)])


def test_one_sequence_per_eligible_user(sample):
    rows = sequences.masked_sequences(sample, ORDER).collect()
    assert sorted(r.user_id for r in rows) == [1, 2, 3] and all(r.length == 10 for r in rows)


def test_masks_and_labels_align(sample):
    for cfg in (SequenceConfig(), SequenceConfig(mask_prob=0.0), SequenceConfig(mask_prob=1.0)):
        for r in sequences.masked_sequences(sample, ORDER, cfg).collect():
            hits = 0
            for value, shown, label in zip(r.sequence, r.masked_sequence, r.labels):
                assert (label == -100) == (shown != 0)
                assert shown == value if label == -100 else label == value
                hits += label != -100
            assert hits >= 1
            assert cfg.mask_prob != 0.0 or hits == 1
            assert cfg.mask_prob != 1.0 or hits == r.length


def test_short_users_and_dislikes_drop_out(ratings):
    rows = [(99, 1, 4.0, 1), (99, 2, 4.0, 2)] + [(5, i, 1.0, i) for i in range(9)] + [(6, i, 3.5, i) for i in range(5)]
    assert [r.user_id for r in sequences.masked_sequences(ratings(rows), ORDER).collect()] == [6]


@pytest.mark.parametrize("max_len,min_len", [(4, 6), (6, 4), (50, 5)])
def test_truncation_keeps_the_latest(sample, max_len, min_len):
    cfg = SequenceConfig(max_len=max_len, min_len=min_len)
    vocab = {r.item_id: r.idx for r in sequences.item_vocab(sample).collect()}
    for r in sequences.masked_sequences(sample, ORDER, cfg).collect():
        items = [vocab[r.user_id * 100 + i] for i in range(10)]
        assert r.sequence == items[-max_len:]


def test_vocab_is_dense_and_sorted(sample):
    vocab = sequences.item_vocab(sample).orderBy("item_id").collect()
    assert [r.idx for r in vocab] == list(range(1, 31))


def test_vocab_of_active_users_only(ratings):
    df = ratings([(1, i, 4.0, i) for i in range(5)] + [(2, 77, 4.0, 1)])
    assert sequences.item_vocab_of_active(df).count() == 5 and sequences.item_vocab(df).count() == 6


def test_serving_sequence_drops_unknown_and_ignores_rating(spark, ratings):
    df = ratings([(1, 10, 1.0, 1), (1, 11, 5.0, 2), (1, 12, 5.0, 3)])
    vocab = spark.createDataFrame([(10, 1), (12, 2)], "item_id long, idx int")
    assert sequences.serving_sequence(df, vocab, ORDER).first().sequence == [1, 2]
    assert sequences.serving_sequence(df, vocab, ORDER, 1).first().sequence == [2]


def test_padding(spark):
    df = spark.createDataFrame([(1, [1, 0, 3], [-100, 2, -100]), (2, list(range(1, 8)), [-100] * 7)], "user_id long, masked_sequence array<int>, labels array<int>")
    got = {r.user_id: r for r in sequences.padded_sequences(df, SequenceConfig(max_len=5)).collect()}
    assert got[1].masked_sequence == [0, 0, 1, 0, 3] and got[1].labels == [-100, -100, -100, 2, -100]
    assert got[2].masked_sequence == [3, 4, 5, 6, 7]


def test_json_round_trip_and_vocab_size(spark, sample, tmp_path):
    built = sequences.masked_sequences(sample, ORDER)
    for layout in ("json", "parquet"):
        files.write_sequences(built, str(tmp_path / layout), layout)
        back = files.read_sequences(spark, str(tmp_path / layout), layout)
        assert sorted(map(str, back.collect())) == sorted(map(str, built.collect()))
    assert sequences.vocab_size(built).first()[0] == 31
    assert sequences.vocab_size(built.limit(0)).first()[0] == 1


def test_mask_share_is_close_to_the_probability(ratings):
    df = ratings([(u, i, 4.0, i) for u in range(100) for i in range(40)])
    positions = evaluation.masked_positions(sequences.masked_sequences(df, ORDER))
    assert 0.17 < positions.count() / 4000 < 0.23


def test_draws_do_not_depend_on_the_layout(sample):
    a = sequences.masked_sequences(sample, ORDER).orderBy("user_id").collect()
    b = sequences.masked_sequences(sample.repartition(9), ORDER).orderBy("user_id").collect()
    assert a == b


def test_sequence_stats(sample):
    assert tuple(sequences.sequence_stats(sample).first()) == (3, 3, 30)
