import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece

from tidemark.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.read_model(None, PATH)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def awkward(count, seed=1):
    rng = random.Random(seed)
    parts = ["a", "bc", " ", "  ", "\n", "\r", "\t", "\x85", "\xa0", "▁", "　", "é", "1", "'s", "!", "中", "🙂", "﻿", "\0", "word", " the", "<0x0A>", "<s>", "</s>", "<unk>", "ing", "         ", "한"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(count)]


RUNS = [" " * n for n in range(50)] + ["a" + " " * n + "b" for n in range(50)] + ["=" * n for n in range(60)]
LONG = ["ab" * 4000, "a" * 20_000, " " * 20_000, "-" * 5001, "中文" * 9000, "word another thing " * 60_000]


def test_as_the_library_does(vocabulary, library):
    rng = random.Random(2)
    letters = ["".join(rng.choice("abcdeinst ▁th") for _ in range(rng.randint(0, 300))) for _ in range(500)]
    anything = ["".join(chr(rng.choice([rng.randint(32, 0x2FF), rng.randint(0x3040, 0x9FFF), rng.randint(0x1F300, 0x1F6FF)])) for _ in range(60)) for _ in range(500)]
    texts = [*awkward(1500), *letters, *anything, *RUNS, *LONG, "", "last"]
    lists = pieces.encode_texts(pa.array(texts), vocabulary)
    assert lists.to_pylist() == [library.encode(t, add_bos=True, add_eos=True) for t in texts]
    sizes = np.diff(lists.offsets.to_numpy()).astype(np.int64)
    assert pieces.decode_ids(lists.values.to_numpy(), sizes, vocabulary) == [library.decode(ids) for ids in lists.to_pylist()]


def test_any_ids_decode_as_the_library_does(vocabulary, library):
    rng = random.Random(3)
    some = [0, 1, 2, 259, 264, 287, 523, 2287, 28705, *range(3 + 0x80, 3 + 0x100, 7), 3 + 0xE4, 3 + 0xB8, 3 + 0xAD, 3 + 0x41]
    rows = [[rng.choice(some) for _ in range(rng.randint(0, 12))] for _ in range(4000)]
    ids, sizes = np.array([i for r in rows for i in r]), np.array([len(r) for r in rows])
    assert pieces.decode_ids(ids, sizes, vocabulary) == [library.decode(r) for r in rows]


def small(names, scores=None):
    """A vocabulary of its own kind, in which order of merges is easy to see."""
    names = ["<unk>", "<s>", "</s>", *[f"<0x{b:02X}>" for b in range(256)], *names]
    kinds = [2, 3, 3, *[6] * 256, *[1] * (len(names) - 259)]
    scores = [0.0] * 259 + (scores or [-float(k) for k in range(len(names) - 259)])
    return pieces.Vocabulary(names, scores, kinds, 1, 2, "?")


def merged(text, vocabulary):
    symbols = vocabulary.symbols(np.array([ord(c) for c in text]))
    got, place = pieces.merge_rounds(symbols.copy(), np.array([0]), vocabulary)
    assert place[0] == 0 and len(place) == len(got)
    one = pieces._sequential(symbols.tolist(), vocabulary)
    assert got.tolist() == one[0] and place.tolist() == one[1]
    return got.tolist()


def test_a_pair_made_by_a_merge_goes_before_the_other_merges_of_its_round():
    # ab is merged in the first round; aba has a better score than ab, so that the
    # second ab of "abab" must not be merged.
    vocabulary = small(["aba", "ab", "a", "b"])
    assert merged("abab", vocabulary) == [259, 262]
    assert merged("abababab", vocabulary) == [259, 262, 259, 262]
    for text in ("ababa", "aab", "bababab", "abaab"):
        merged(text, vocabulary)


def test_random_vocabularies_merge_as_one_at_a_time():
    rng = random.Random(4)
    for _ in range(150):
        names = list(dict.fromkeys("".join(rng.choice("abc") for _ in range(rng.randint(2, 5))) for _ in range(12)))
        names = [*names, "a", "b", "c"]
        scores = [float(rng.randint(0, 8)) for _ in names] if rng.random() < 0.5 else None
        vocabulary = small(names, scores)
        for _ in range(10):
            merged("".join(rng.choice("abc") for _ in range(rng.randint(1, 30))), vocabulary)


def test_encode_and_decode(spark, make_docs, odd_rows, library):
    rows = [*odd_rows, *[(100 + k, t) for k, t in enumerate(awkward(200, 5))]]
    for limit in (100, 1 << 22):
        made = pieces.decode(pieces.encode(make_docs(rows), PATH, block_bytes=limit), PATH).collect()
        want = [library.encode(t or "", add_bos=True, add_eos=True) for _, t, *_ in rows]
        assert sorted((str(r.doc_id), r.ids, r.decoded) for r in made) == sorted((str(i), w, library.decode(w)) for (i, *_), w in zip(rows, want))


def test_nulls_and_bad_ids(spark, make_docs):
    assert pieces.encode(make_docs([(1, "x")]).limit(0), PATH).count() == 0
    rows = spark.createDataFrame([(1, None), (2, []), (3, [1, 264, 2])], "doc_id long, ids array<int>")
    made = {r.doc_id: (r.decoded, r.bytes) for r in pieces.decode(rows, PATH, packed="bytes").collect()}
    assert made == {1: (None, None), 2: ("", b""), 3: ("a", np.array([1, 264, 2], "<u4").tobytes())}
    for bad in ([40_000], [-1], [264, None]):
        with pytest.raises(Exception, match="vocabulary|null"):
            pieces.decode(spark.createDataFrame([(bad,)], "ids array<int>"), PATH).collect()


def test_digest_bytes():
    lists = pa.array([[1, 258, 70_000], None, []], pa.list_(pa.int32()))
    assert pieces.little_endian(lists).to_pylist() == [np.array([1, 258, 70_000], "<u4").tobytes(), None, b""]
    assert pieces.little_endian(lists[1:]).to_pylist() == [None, b""]


def test_other_models_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    model.ParseFromString(open(PATH, "rb").read())
    model.normalizer_spec.remove_extra_whitespaces = True
    (tmp_path / "m").write_bytes(model.SerializeToString())
    with pytest.raises(ValueError):
        pieces.read_model(None, str(tmp_path / "m"))


def test_model_through_spark(spark, vocabulary):
    assert (pieces.read_model(spark, f"file://{PATH}").rank == vocabulary.rank).all()
