import math
import random
from collections import Counter

from pyspark.sql import functions as F

from tidemark.llm import lm


def plain(rows, order=3, alpha=0.4, least=2):
    texts = []
    for _, t, *_ in rows:
        folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        for c in "\t\n\x0b\x0c\r":
            folded = folded.replace(c, " ")
        texts.append([w for w in folded.split(" ") if w])
    counts = Counter(tuple(w[i : i + n]) for w in texts for n in range(1, order + 1) for i in range(len(w) - n + 1))
    total = sum(map(len, texts))

    def score(gram):
        if len(gram) == 1:
            return math.log(counts[gram] / total)
        if counts[gram] >= least:
            return math.log(counts[gram] / counts[gram[:-1]])
        return math.log(alpha) + score(gram[1:])

    out = []
    for (i, *_), w in zip(rows, texts):
        parts = [score(tuple(w[max(0, k - order + 1) : k + 1])) for k in range(len(w))]
        out.append((str(i), len(w), sum(parts) / len(w) if w else None))
    return sorted(out, key=str)


def same(got, want):
    got = sorted(((str(r.doc_id), r.n_words, r.score) for r in got), key=str)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    for (_, _, a), (_, _, b) in zip(sorted(got, key=lambda x: (x[0], x[1], x[2] or 0)), sorted(want, key=lambda x: (x[0], x[1], x[2] or 0))):
        assert (a is None) == (b is None) and (a is None or abs(a - b) < 1e-6)


def corpus(seed=1):
    rng = random.Random(seed)
    words = ["the", "The", "of", "and", "a", "averylongwordofmanybytes", "éclair"] + [f"w{k}" for k in range(40)]
    return [(100 + k, rng.choice([" ", "\n", " \t "]).join(rng.choices(words, k=rng.randint(0, 60)))) for k in range(120)]


def test_by_brute_force(spark, make_docs, odd_rows):
    rows = [*odd_rows, *corpus()]
    for limit in (300, 1 << 20):
        same(lm.scores(make_docs(rows), bundle_bytes=limit).collect(), plain(rows))


def test_orders_and_parameters(spark, make_docs, monkeypatch):
    monkeypatch.setattr(lm, "RANGE_BYTES", 200)  # more hash ranges than n-grams in some
    rows = corpus(2)
    for order, alpha, least in ((1, 0.4, 2), (2, 0.7, 1), (4, 0.4, 3)):
        same(lm.scores(make_docs(rows), order, alpha, least).collect(), plain(rows, order, alpha, least))


def test_empty(spark, make_docs):
    assert lm.scores(make_docs([(1, "x")]).limit(0)).count() == 0
    only = lm.scores(make_docs([(1, None), (2, " \n")]))
    assert only.where(F.col("score").isNull() & (F.col("n_words") == 0)).count() == 2
