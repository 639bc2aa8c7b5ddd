import random

import public_tokenizers
import pytest
import tiktoken

from tidemark.llm import bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(None, PATH)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def awkward(count, seed=1):
    rng = random.Random(seed)
    parts = ["a", "bc", " ", "  ", "\n", "\r", "\t", "\x0b", "\x1c", "\x85", "\xa0", " ", "　", "é", "ß", "1", "²", "'s", "'re", "!", "中", "🙂", "​", "﻿", "\0", "word", " the"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(count)]


def test_words_encode_as_the_library_does(ranks, library):
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdeinst") for _ in range(rng.randint(1, 200))) for _ in range(400)] + ["a" * 5000, "ab" * 1500]
    for word in words:
        assert bpe.encode_word(word.encode(), ranks) == library.encode_ordinary(word)
    for word in words[:200]:
        if word.encode() not in ranks:
            assert bpe._encode_long(word.encode(), ranks) == bpe.encode_word(word.encode(), ranks)


def test_encode_and_decode(spark, make_docs, odd_rows, library):
    rows = [*odd_rows, *[(100 + k, t) for k, t in enumerate(awkward(400))]]
    for limit in (200, 1 << 20):  # many small bundles, or one a partition
        encoded = bpe.decode(bpe.encode(make_docs(rows), PATH, PATTERN, bundle_bytes=limit), PATH).collect()
        got = sorted((str(r.doc_id), r.ids, bytes(r.decoded)) for r in encoded)
        assert got == sorted((str(i), library.encode_ordinary(t or ""), (t or "").encode()) for i, t, *_ in rows)


def test_empty(spark, make_docs):
    encoded = bpe.encode(make_docs([(1, "x")]).limit(0), PATH, PATTERN)
    assert encoded.count() == 0 and bpe.decode(encoded, PATH).count() == 0


def test_a_null_list_decodes_to_null(spark):
    rows = spark.createDataFrame([(1, None), (2, []), (3, [5, 6])], "doc_id long, ids array<int>")
    got = {r.doc_id: r.decoded for r in bpe.decode(rows, PATH).collect()}
    assert got[1] is None and got[2] == b"" and len(got[3]) >= 2
