import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import suffix_dedup

LENGTH = 400


def removed(texts, length=LENGTH):
    """By brute force: the bytes of each text that a repeated string covers."""
    contents = [(t or "").encode() for t in texts]
    seen = Counter(c[s : s + length] for c in contents for s in range(len(c) - length + 1))
    masks = []
    for c in contents:
        mask = np.zeros(len(c), bool)
        for s in range(len(c) - length + 1):
            if seen[c[s : s + length]] > 1:
                mask[s : s + length] = True
        masks.append(mask)
    return contents, masks


def prose(rng, words):
    return " ".join("".join(rng.choice("abcdefghij é") for _ in range(rng.randint(2, 9))) for _ in range(words))


def planted(seed=1):
    rng = random.Random(seed)
    base = [prose(rng, 400) for _ in range(6)]
    out = [(k, t) for k, t in enumerate(base)]
    for k in range(60):  # passages of all lengths near the bound, at any place of new text
        source = rng.choice(base)
        size = rng.choice([380, 396, 399, 400, 401, 404, 430, 700, 1500])
        at = rng.randrange(max(1, len(source) - size))
        out.append((100 + k, prose(rng, rng.randint(0, 40)) + source[at : at + size] + prose(rng, rng.randint(0, 40))))
    for k in range(6):  # one byte changed in a copy
        text = list(base[k % len(base)])
        text[rng.randrange(len(text))] = "#"
        out.append((200 + k, "".join(text)))
    out += [(300, "a" * 3000), (301, "ab" * 900 + "tail" * 5), (302, base[0]), (303, base[0]), (304, prose(rng, 30) * 8), (305, "z" * 400), (306, "q" * 399)]
    return out


def check(spark, make_docs, rows):
    got = suffix_dedup.without_repeats(make_docs(rows)).collect()
    contents, masks = removed([t for _, t, *_ in rows])
    want = []
    for (i, *_), content, mask in zip(rows, contents, masks):
        runs = int(mask[:1].sum()) + int((mask[1:] & ~mask[:-1]).sum())
        kept = bytes(np.frombuffer(content, np.uint8)[~mask]) if content else b""
        want.append((str(i), kept, runs))
    assert sorted((str(r.doc_id), bytes(r.kept), r.n_spans) for r in got) == sorted(want)


def test_planted_repeats(spark, make_docs):
    check(spark, make_docs, planted())


def test_odd_rows(spark, make_docs, odd_rows):
    rows = [(i, t if t is None or len(t) < 9000 else t[:3000], *rest) for i, t, *rest in odd_rows]  # brute force is quadratic
    check(spark, make_docs, rows)


def test_empty_and_unique(spark, make_docs):
    assert suffix_dedup.without_repeats(make_docs([(1, "x")]).limit(0)).count() == 0
    check(spark, make_docs, [(1, prose(random.Random(5), 200)), (2, None)])


def test_length_has_a_least_value(spark, make_docs):
    with pytest.raises(ValueError):
        suffix_dedup.repeats(make_docs([(1, "x")]), length=100)


@pytest.mark.parametrize("need", [2, 1000])
def test_suffix_ranks_order_as_sorted_suffixes(spark, need):
    rng = random.Random(need)
    strings = [[rng.randint(1, 3) for _ in range(rng.randint(1, 40))] for _ in range(30)] + [[2] * 25, [2] * 24]
    rows = [(1000 + s, p, c) for s, string in enumerate(strings) for p, c in enumerate(string)]
    ranks = suffix_dedup.suffix_ranks(suffix_dedup._next(spark.createDataFrame(rows, "sid long, place long, c long"), "c", suffix_dedup.END), need).collect()
    assert len(ranks) == len(rows)
    suffix = {(r.sid, r.place): tuple(strings[r.sid - 1000][r.place :]) for r in ranks}
    ordered = sorted(ranks, key=lambda r: r.rank)
    short = [suffix[r.sid, r.place][:need] for r in ordered]
    assert short == sorted(short)  # the first ``need`` symbols at least
    if need > 100:
        every = sorted(suffix.values())
        assert all(r.rank == every.index(suffix[r.sid, r.place]) for r in ranks)


def test_chunks_borrow_from_the_next(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "_CHUNK", 4)
    rows = spark.createDataFrame([(1, p, p * 10) for p in range(11)], "sid long, place long, c long")
    got = {r.place: (r.c1, r.c2) for r in suffix_dedup._next(rows, "c", -1).collect()}
    assert got == {p: tuple((p + k) * 10 if p + k < 11 else -1 for k in (1, 2)) for p in range(11)}


def test_anchors_agree_inside_equal_stretches():
    rng = np.random.default_rng(0)
    shared = rng.integers(0, 256, 600, dtype=np.uint8)
    edge = suffix_dedup.WINDOW + suffix_dedup.GRAM
    places = []
    for left in (10, 333):
        text = np.concatenate([rng.integers(0, 256, left, dtype=np.uint8), shared, rng.integers(0, 256, 50, dtype=np.uint8)])
        cut = suffix_dedup.anchors(text) - left
        assert np.diff(cut).max() <= suffix_dedup.WINDOW
        places.append([p for p in cut if edge <= p <= 600 - edge])
    assert places[0] == places[1]


def test_strings_of_an_anchor_are_one_row():
    content = prose(random.Random(3), 300)
    cut = suffix_dedup.anchors(np.frombuffer(content.encode(), np.uint8)).tolist()
    given = [{"pos": p, "back": p - q, "g": 1, "parts": parts} for parts in (1, 5) for q, p in zip(cut, cut[1:])]
    kind = pa.list_(pa.struct([(f, pa.int64()) for f in ("pos", "back", "g", "parts")]))
    batch = pa.record_batch([pa.array([7]), pa.array([content]), pa.array([given], kind)], ["key", "text", "listed"])
    rows = pa.Table.from_batches(suffix_dedup._listed(LENGTH)(iter([batch]))).to_pylist()
    whole = [r for r in rows if r["chosen"] is None]
    assert 0 < len(whole) <= len(given) // 2 < sum(len(r["hashes"]) // 8 for r in whole) // 10
    # Dealt out by hash, the same strings are there once each.
    dealt = {r["first"] + s: h for r in rows if r["chosen"] for s, h in zip(np.frombuffer(r["chosen"], np.int32), np.frombuffer(r["hashes"], np.uint64))}
    assert dealt == {r["first"] + s: h for r in whole for s, h in enumerate(np.frombuffer(r["hashes"], np.uint64))}


@pytest.mark.parametrize("size", [1, 2, 3, 100])
def test_compared_rows_of_a_group_span_batches(size):
    def row(g, part, key, first, hashes, chosen=None):
        return g, part, key, first, np.array(hashes, np.uint64).tobytes(), chosen and np.array(chosen, np.int32).tobytes()

    rows = [row(1, 0, 1, 0, [5, 6, 7]), row(1, 0, 2, 10, [9, 6, 7]), row(1, 0, 3, 20, [5]), row(2, 0, 4, 0, [5, 6]), row(2, 1, 5, 0, [8, 3], [2, 4]), row(2, 1, 6, 7, [3])]
    kinds = [*[pa.int64()] * 4, pa.binary(), pa.binary()]
    whole = pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["g", "part", "key", "first", "hashes", "chosen"])
    batches = [whole.slice(at, size) for at in range(0, len(rows), size)]
    got = pa.Table.from_batches(suffix_dedup._compared(LENGTH)(iter(batches))).to_pylist()
    assert sorted((r["key"], r["start"], r["stop"]) for r in got) == [(1, 0, 402), (2, 11, 412), (3, 20, 420), (5, 4, 404), (6, 7, 407)]


def test_many_kinds_with_one_prefix(spark, make_docs, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "_KINDS", 3)
    monkeypatch.setattr(suffix_dedup, "_CHUNK", 50)
    rng = random.Random(8)
    base = prose(rng, 150)
    rows = [(k, base[:at] + chr(0x100 + k) + base[at + 1 :]) for k, at in enumerate(rng.sample(range(len(base)), 25))]
    check(spark, make_docs, rows)


def test_merge_has_one_row_for_three_places(spark, monkeypatch):
    kept, store = {}, suffix_dedup.stored

    def counted(frame, name):
        made = store(frame, name)
        kept.setdefault(name, []).append(made.count())
        return made

    monkeypatch.setattr(suffix_dedup, "stored", counted)
    rows = [(s, p, 1 + (s + p * p) % 3) for s, size in ((7, 10), (8, 6), (9, 1)) for p in range(size)]
    strings = suffix_dedup._next(spark.createDataFrame(rows, "sid long, place long, c long"), "c", suffix_dedup.END)
    assert suffix_dedup.suffix_ranks(strings, 1).count() == 17
    assert kept["merge"] == [4 + 2 + 1]


def test_prefixes_travel_as_bytes(monkeypatch):
    class Task:
        get = staticmethod(lambda: Task)
        partitionId = staticmethod(lambda: 0)

    monkeypatch.setattr(suffix_dedup, "TaskContext", Task)
    h, place = np.arange(1, 61), np.arange(60)
    at = (place * 40 << 16) | (np.where(place, 40, 0) << 8) | 40
    batch = pa.record_batch([pa.array(np.full(60, 5)), pa.array(at), pa.array(h)], ["key", "at", "h"])
    rows = pa.Table.from_batches(suffix_dedup._runs(LENGTH)(iter([batch]))).to_pylist()
    assert len(rows) == 60 and max(r["n"] for r in rows) > 1
    for r in rows:
        assert isinstance(r["prefixes"], bytes) and len(r["prefixes"]) == 8 * min(r["n"], suffix_dedup.DEPTH)
        if 0 < r["n"] <= suffix_dedup.DEPTH:
            assert r["prefixes"][-8:] == np.int64(r["g"]).tobytes()


def test_passages_of_over_fifty_words(spark, make_docs):
    rng = random.Random(21)
    texts, kinds = [], []
    for k in range(24):  # words of 5 letters: 66 of them are 395 bytes, 67 are 401
        words = 51 + k
        passage = " ".join("".join(rng.choice("bcdfgh") for _ in range(5)) for _ in range(words))
        texts += [f"{prose(rng, 80)}|{passage}|{prose(rng, 60)}" for _ in range(2)]
        kinds += [words >= 67] * 2
    texts += [prose(rng, 160) for _ in range(20)]
    kinds += [False] * 20
    rows = list(enumerate(texts))
    got = {int(r.doc_id): r for r in suffix_dedup.without_repeats(make_docs(rows)).collect()}
    assert [len(got[k].kept) < len(t.encode()) for k, t in rows] == kinds
    check(spark, make_docs, rows)
