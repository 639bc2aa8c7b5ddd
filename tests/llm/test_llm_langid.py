import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import langid
from tidemark.llm.common import held_out, table, utf8

SF = "/root/testdata/sf0.01"


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    net = langid._fresh(["a", "b", "c"], 3, rng)
    for name in ("inputs", "states", "bias", "out", "out_bias"):
        setattr(net, name, getattr(net, name).astype(np.float64) * 0.7)
    codes = rng.integers(97, 105, (6, 4))
    real = np.ones((6, 4), bool)
    real[4:, 1] = False
    target = np.array([0, 1, 2, 1])

    def loss():
        found, _ = langid._probabilities(net, codes)
        own = found[target, :, np.arange(4)].T
        return -(np.log(own) * real).sum() / real.sum()

    # Zero-width states are kept in single precision, so compare to a few places.
    for array, gradient in zip(net.arrays(), langid._gradients(net, codes, target, real)):
        for place in rng.choice(array.size, min(6, array.size), replace=False):
            spot = np.unravel_index(place, array.shape)
            before, step = array[spot], 1e-2
            array[spot] = before + step
            up = loss()
            array[spot] = before - step
            down = loss()
            array[spot] = before
            assert abs((up - down) / (2 * step) - gradient[spot]) < 5e-3


def test_windows_cover_every_byte_once():
    offsets = np.array([0, 0, 1, 64, 130, 130, 400])
    starts, lengths, owner = langid.windows(np.zeros(400, np.uint8), offsets)
    covered = np.concatenate([np.arange(s, s + n) for s, n in zip(starts, lengths)])
    assert sorted(covered) == list(range(400))
    assert all(offsets[o] <= s and s + n <= offsets[o + 1] for s, n, o in zip(starts, lengths, owner))


def test_held_out_accuracy(spark):
    docs = table(spark, SF, "documents")
    found = langid.identify(docs, langid.train(docs)).where(held_out(F.col("doc_id")) & F.col("lang").isNotNull() & (F.length("text") > 200))
    right, total = found.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert total > 100 and right / total > 0.95


def test_labels_of_other_columns_and_held_out_rows_do_not_count(spark):
    docs = table(spark, SF, "documents").limit(300)
    net = langid.train(docs, per_language=40, rounds=5)
    changed = docs.withColumn("lang", F.when(held_out(F.col("doc_id")), "zz").otherwise(F.col("lang"))).withColumn("source", F.lit("zz"))
    again = langid.train(changed, per_language=40, rounds=5)
    assert net.labels == again.labels
    assert all(np.array_equal(a, b) for a, b in zip(net.arrays(), again.arrays()))


def test_odd_rows(spark, make_docs, odd_rows):
    rng = np.random.default_rng(1)
    net = langid._fresh(["de", "en"], 4, rng)
    docs = make_docs(odd_rows)
    rows = langid.identify(docs, net).collect()
    assert len(rows) == len(odd_rows) and set(rows[0].asDict()) == {*docs.columns, "lang_pred", "score"}
    for row in rows:
        lettered = any(c.isalpha() for c in row.text or "")
        assert (row.lang_pred == "und") == (not lettered) and 0 <= row.score <= 1 and (lettered or row.score == 0)
    same = {(r.lang_pred, r.score) for r in rows if r.doc_id == 6}
    assert len(same) == 1
    split = langid.identify(make_docs(odd_rows, 7), net).collect()
    key = lambda r: (str(r.doc_id), str(r.text), r.lang_pred)
    for one, other in zip(sorted(rows, key=key), sorted(split, key=key), strict=True):
        assert key(one) == key(other) and abs(one.score - other.score) < 1e-5


def test_nothing_to_learn_from(spark, make_docs):
    docs = make_docs([(1, "some text", None), (2, None, None)])
    assert langid.train(docs) is None
    assert {r.lang_pred for r in langid.identify(docs, None).collect()} == {"und"}
    empty = docs.limit(0)
    assert langid.train(empty) is None and langid.identify(empty, None).count() == 0


def test_pooled_is_the_mean_over_bytes():
    import pyarrow as pa

    rng = np.random.default_rng(2)
    net = langid._fresh(["a", "b"], 4, rng)
    texts = ["x" * 10, "hello world " * 30, ""]
    data, offsets = utf8(pa.array(texts))
    found = langid.pooled(net, data, offsets, block=3)
    codes, real = langid._codes(data[:10], np.array([0]), np.array([10]))
    alone, _ = langid._probabilities(net, codes)
    assert np.allclose(found[0], alone[:, :, 0].mean(axis=1), atol=1e-5) and (found[2] == 0).all()
    assert np.allclose(found[:2].sum(axis=1), 1, atol=1e-4) and real.all()
