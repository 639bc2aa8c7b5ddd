import math
import random

from pyspark.sql import functions as F

from tidemark.llm import topk


def plain(rows, k, asks):
    fit = [(n, i, [math.floor(256 * float(x)) for x in v]) for n, (i, v) in enumerate(rows) if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, i, v in fit:
        if asks(i):
            scored = sorted((-sum(a * b for a, b in zip(v, w)), j) for m, j, w in fit if m != n and len(w) == len(v))
            out += [(i, r, j, -s) for r, (s, j) in enumerate(scored[:k], start=1)]
    return sorted(out)


def run(spark, rows, monkeypatch=None, k=5):
    table = spark.createDataFrame([(i, v, 1, 2, 3) for i, v in rows], "vec_id long, embedding array<float>, rank int, id long, place long").repartition(3)
    got = topk.top_k(table, F.col("id") % 5 == 0, k=k).collect()
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got)


def vectors(count, size=8, seed=1):
    rng = random.Random(seed)
    centres = [[rng.uniform(-1, 1) for _ in range(size)] for _ in range(4)]
    rows = []
    for i in range(count):
        c = rng.choice(centres)
        # Sixteenths are exact in single precision, as the comparison needs.
        rows.append((i, [round((x + rng.uniform(-0.4, 0.4)) * 16) / 16 for x in c]))
    return rows


def test_brute_force(spark):
    rows = vectors(300)
    assert run(spark, rows) == plain(rows, 5, lambda i: i % 5 == 0)


def test_many_ranges_and_groups(spark, monkeypatch):
    monkeypatch.setattr(topk, "RANGE", 37)
    monkeypatch.setattr(topk, "GROUP", 7)
    rows = vectors(220, seed=2)
    assert run(spark, rows) == plain(rows, 5, lambda i: i % 5 == 0)


def test_ties_odd_vectors_and_repeated_ids(spark):
    same = [0.5] * 8
    rows = [(i, same) for i in range(60)] + vectors(10, seed=3)[5:]
    rows += [(500, None), (505, [None] * 8), (510, [float("nan")] * 8), (515, [float("inf")] + [0.0] * 7), (520, [1.0, 2.0]), (525, [2.0, 1.0]), (530, []), (None, same), (5, same), (5, same)]
    got, want = run(spark, rows), plain(rows, 5, lambda i: i % 5 == 0)
    assert got == want and any(q == 520 for q, *_ in got)


def test_fewer_rows_than_asked_for_and_none(spark):
    rows = vectors(3)
    assert run(spark, rows) == plain(rows, 5, lambda i: i % 5 == 0) and len(run(spark, rows)) == 2
    assert run(spark, []) == [] and run(spark, [(1, [0.5])]) == [] and run(spark, [(5, [0.5])]) == []


def test_blocks_are_pruned(monkeypatch):
    import numpy as np

    rows = np.concatenate([np.full((64, 4), 100), np.full((640, 4), -100)])
    scored = []
    real = topk.np.lexsort
    monkeypatch.setattr(topk.np, "lexsort", lambda *a, **b: scored.append(1) or real(*a, **b))
    asks = (np.array([7]), np.array([-1]), np.full((1, 4), 3))
    found = topk.search(asks, (np.arange(704), np.arange(704), rows), 5)
    assert [f[2] for f in found] == [0, 1, 2, 3, 4] and len(scored) == 1
