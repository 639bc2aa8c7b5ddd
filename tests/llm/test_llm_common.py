import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from tidemark.llm import common, sampling
from tidemark.session import stored

FOLD, INSIDE = np.arange(256, dtype=np.uint8), np.array([b != 32 for b in range(256)])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.none() | st.text(alphabet="ab é🙂", max_size=40), max_size=8))
def test_word_hashes_name_words_and_stop_at_texts(texts):
    data, offsets = common.utf8(pa.array(texts, pa.string()))
    hashes, first = common.word_hashes(data, offsets, FOLD, INSIDE)
    words = [[w for w in (t or "").split(" ") if w] for t in texts]
    assert np.diff(first).tolist() == [len(w) for w in words]
    flat = [w for row in words for w in row]
    assert len(hashes) == len(flat) and len(set(hashes.tolist())) == len(set(flat))
    assert len(set(zip(hashes.tolist(), flat))) == len(set(flat))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(-(2**31), 2**31 - 1)))
def test_packed_numbers_come_back(numbers):
    assert common.unpacked(common.packed(np.array(numbers, np.int64))).tolist() == numbers
    assert common.unpacked(common.packed(np.array(numbers, np.int64), "<i8"), "<i8").tolist() == numbers


def test_slices_of_a_column_keep_their_texts():
    column = pa.array(["ab", None, "", "cde", "f"]).slice(1, 3)
    data, offsets = common.utf8(column)
    assert bytes(data) == b"cde" and offsets.tolist() == [0, 0, 0, 3]


def test_samples_are_bounded_and_do_not_depend_on_the_layout(spark):
    rows = spark.createDataFrame([(k, "a" if k % 3 else "b") for k in range(3000)] + [(k, "c") for k in range(5)], "doc_id long, kind string")
    for most, want in ((50, {"a": 50, "b": 50, "c": 5}), ({"a": 7, "c": 2}, {"a": 7, "c": 2})):
        got = [{(r.doc_id, r.kind) for r in sampling.bounded_sample(rows.repartition(n), "kind", most).collect()} for n in (1, 5)]
        assert got[0] == got[1] and {k: sum(1 for _, x in got[0] if x == k) for k in want} == want


def test_forget_deletes_work_tables_only(spark, tmp_path):
    common.prepared(spark)
    spark.range(5).write.parquet(str(tmp_path / "own"))
    work = stored(spark.range(7), "forgotten")
    both = work.union(spark.read.parquet(str(tmp_path / "own")))
    assert both.count() == 12
    common.forget(both)
    assert spark.read.parquet(str(tmp_path / "own")).count() == 5
    folder = work.inputFiles()[0].removeprefix("file://").rpartition("/")[0]
    import os

    assert not os.path.exists(folder)
