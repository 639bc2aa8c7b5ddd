import random
from itertools import combinations

import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import simhash
from tidemark.llm.components import components


def plain_fingerprint(text, size=3):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprint(odd_rows):
    for _, text, *_ in odd_rows:
        assert simhash.fingerprint(text) == plain_fingerprint(text)


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_masks_cover_every_pair_within_the_radius(radius):
    masks = simhash.covering_masks(radius)
    assert len(masks) == 2 ** (radius + 1) - 1
    rng = random.Random(radius)
    sets = combinations(range(64), 2) if radius == 2 else (rng.sample(range(64), radius) for _ in range(2000))
    for bits in sets:
        assert any(not any(m >> b & 1 for b in bits) for m in masks)


def union_find(pairs):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


def test_components(spark):
    rng = random.Random(3)
    pairs = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(k, k + 1) for k in range(1000, 1200)] + [(5000, k) for k in range(5001, 5300)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = union_find([p for p in pairs if p[0] != p[1]])
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_links_connect_as_all_pairs_do(spark, radius):
    rng = random.Random(radius)
    prints = {0}
    for _ in range(12):  # clusters around centres, one of them hot
        centre = rng.getrandbits(64)
        for _ in range(60 if len(prints) < 50 else 8):
            value = centre
            for b in rng.sample(range(64), rng.randint(0, 4)):
                value ^= 1 << b
            prints.add(value)
    rows = spark.createDataFrame([(simhash._signed(p),) for p in prints], "fp long")
    found = simhash.links(rows, radius).collect()
    mask = (1 << 64) - 1
    assert all(0 < ((r.a ^ r.b) & mask).bit_count() <= radius for r in found)
    signed = [simhash._signed(p) for p in prints]
    want = union_find([(a, b) for a, b in combinations(signed, 2) if ((a ^ b) & mask).bit_count() <= radius])
    assert union_find([(r.a, r.b) for r in found]) == want


def test_near_duplicates_by_brute_force(spark, make_docs, odd_rows):
    rng = random.Random(9)
    vocabulary = [f"w{k}" for k in range(300)]
    base = [" ".join(rng.choices(vocabulary, k=80)) for _ in range(12)]
    rows = list(odd_rows)
    for k in range(90):
        words = rng.choice(base).split()
        if k % 2:
            words[rng.randrange(len(words))] = "changed"
        rows.append((100 + k, " ".join(words)))
    found = simhash.near_duplicates(make_docs(rows)).collect()
    assert len(found) == len(rows)
    prints = {(i, plain_fingerprint(t)) for i, t, *_ in rows}
    values = sorted({p for _, p in prints})
    root = union_find([(a, b) for a in values for b in values if a <= b and (a ^ b).bit_count() <= 2])
    least = {}
    for i, p in prints:
        if i is not None:
            least[root[p]] = min(i, least.get(root[p], i))
    got = {(r.doc_id, r.fp & ((1 << 64) - 1), r.component_id) for r in found}
    assert got == {(i, p, least.get(root[p])) for i, p in prints}

    docs = make_docs(rows)
    kept = simhash.one_of_each_group(docs)
    ids = [r.doc_id for r in kept.collect()]
    lone = {root[p] for _, p in prints} - set(least)
    assert sorted(i for i in ids if i is not None) == sorted(set(least.values())) and ids.count(None) == len(lone)
    assert kept.columns == docs.columns


def test_one_row_of_each_group_by_rows(make_docs):
    """Repeated ids, rows without an id and every layout: a defined row stays, and no other text is lost."""
    texts = [" ".join(f"w{k}x{j}" for j in range(60)) for k in range(6)]
    near = texts[0].replace("w0x30", "changed")
    rows = [(1, texts[0]), (1, texts[1]), (1, texts[0]), (2, near), (None, texts[0]), (None, texts[2]), (None, texts[2]), (None, texts[3]), (5, texts[3], "de"),
            (5, texts[3], "en"), (6, None), (None, ""), (7, texts[4]), (3, texts[4])]
    prints = {t: simhash.fingerprint(t) for t in (texts[0], near)}
    want = [(1, texts[0]), (1, texts[1]), (3, texts[4]), (5, texts[3]), (6, None), (None, texts[2])]
    if (prints[texts[0]] ^ prints[near]).bit_count() > 2:
        want.append((2, near))
    results = []
    for parts in (1, 5):
        kept = simhash.one_of_each_group(make_docs(rows, parts)).collect()
        results.append(sorted(map(str, kept)))
        assert sorted(map(str, ((r.doc_id, r.text) for r in kept))) == sorted(map(str, want))
    assert results[0] == results[1] and "lang='de'" in "".join(results[0])


def test_empty(spark, make_docs):
    empty = make_docs([(1, "x")]).limit(0)
    assert simhash.near_duplicates(empty).count() == 0 and simhash.one_of_each_group(empty).count() == 0
    assert simhash.near_duplicates(make_docs([(1, "x")])).select(F.max("component_id")).first()[0] == 1
