import random
import re
from collections import Counter

import numpy as np

from tidemark.llm import decontaminate


def plain_words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[a-z0-9\x80-\U0010ffff]+", lower)


def bag(words, size):
    return Counter(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def brute(rows, items):
    """Most similar window of each row and item by the definition, every window compared."""
    out = set()
    for i, text, *_ in rows:
        words = plain_words(text)
        for item, content in items:
            own = plain_words(content)
            if not own or not words or (len(words) < len(own) and min(len(words), len(own)) < 5):
                continue
            size = min(5, len(own))
            width = min(len(words), len(own))
            wanted, best = bag(own, size), 0.0
            for s in range(len(words) - width + 1):
                window = bag(words[s : s + width], size)
                best = max(best, sum((window & wanted).values()) / max(1, sum((window | wanted).values())))
            if best >= 0.8:
                out.add((str(i), item, round(best, 6)))
    return sorted(out)


def prose(rng, count):
    return [rng.choice("the of and to in that was for her his word other thing none some".split()) if rng.random() < 0.4 else f"w{rng.randrange(4000)}" for _ in range(count)]


def cases(seed=1):
    rng = random.Random(seed)
    items = [(k, " ".join(prose(rng, rng.randint(12, 50)))) for k in range(25)]
    items += [(50, "just four words here"), (51, "One."), (52, ""), (53, None), (None, "a null id"), (54, items[0][1]), (55, " ".join(["again"] * 30)), (56, "!!! ???")]
    rows = []
    for k in range(150):
        words = rng.choice(items[:25])[1].split()
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
            words[rng.randrange(len(words))] = f"x{rng.randrange(999)}"
        if rng.random() < 0.2:
            del words[rng.randrange(len(words))]
        joined = rng.choice([" ", "  ", ", ", "\n"]).join(words)
        rows.append((1000 + k, " ".join(prose(rng, rng.randint(0, 60))) + ". " + joined.upper() + " " + " ".join(prose(rng, rng.randint(0, 60)))))
    rows += [(200 + k, " ".join(prose(rng, 120))) for k in range(30)]
    rows += [(300, items[3][1] + " middle " + items[3][1]), (301, "there are just four words here. one"), (302, "again " * 400), (303, items[4][1][: len(items[4][1]) * 9 // 10])]
    return rows, items


def found(spark, docs, items):
    benchmark = spark.createDataFrame([(*i, 1, "x") for i in items], "item_id long, text string, size int, key string")
    return decontaminate.contaminated(docs, benchmark), benchmark


def test_by_brute_force(spark, make_docs, odd_rows):
    rows, items = cases()
    rows = rows + [r for r in odd_rows if r[0] != 5]
    docs = make_docs(rows)
    matches, benchmark = found(spark, docs, items)
    got = sorted({(str(r.doc_id), r.item_id, r.similarity) for r in matches.collect()})
    assert got == brute(rows, [i for i in items if i[0] is not None and i[1]])
    clean = decontaminate.clean(docs, benchmark)
    assert clean.columns == docs.columns
    hit = {g[0] for g in got}
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(str(i) for i, *_ in rows if str(i) not in hit)


def test_groups_of_items_give_the_same(spark, make_docs, monkeypatch):
    rows, items = cases(2)
    docs = make_docs(rows)
    whole = sorted(map(str, found(spark, docs, items)[0].collect()))
    monkeypatch.setattr(decontaminate, "GROUP_CHARS", 800)
    matches, benchmark = found(spark, docs, items)
    assert len(decontaminate._groups(benchmark)) > 3
    assert sorted(map(str, matches.collect())) == whole


def test_long_texts_repeated_rows_and_empty_tables(spark, make_docs):
    rows, items = cases(3)
    long = " ".join(prose(random.Random(8), 60_000)) + " " + items[7][1]
    docs = make_docs([(1, long), (2, items[7][1]), (2, items[7][1])])
    matches, benchmark = found(spark, docs, items)
    got = sorted((r.doc_id, r.item_id, r.first_word) for r in matches.collect())
    assert got == [(1, 7, 60_000), (2, 7, 0), (2, 7, 0)]
    assert found(spark, docs.limit(0), items)[0].count() == 0 and decontaminate.clean(docs.limit(0), benchmark).count() == 0
    assert found(spark, docs, [])[0].count() == 0 and decontaminate.clean(docs, benchmark.limit(0)).count() == 3


def test_items_without_an_id_are_found(spark, make_docs, monkeypatch):
    rng = random.Random(9)
    texts = [" ".join(prose(rng, 20)) for _ in range(4)]
    items = [(None, texts[0]), (None, texts[1]), (None, texts[1]), (7, texts[2])]
    docs = make_docs([(k, f"before {text} after") for k, text in enumerate(texts)])
    for most in (decontaminate.GROUP_CHARS, 100):
        monkeypatch.setattr(decontaminate, "GROUP_CHARS", most)
        matches, benchmark = found(spark, docs, items)
        assert sorted((r.doc_id, str(r.item_id)) for r in matches.collect()) == [(0, "None"), (1, "None"), (2, "7")]
        assert [r.doc_id for r in decontaminate.clean(docs, benchmark).collect()] == [3]


def test_the_index_misses_nothing_within_the_radius():
    rng = np.random.default_rng(0)
    rows, items = cases()
    made = decontaminate.index([i for i in items if i[0] is not None and i[1]])
    for size, (which, near) in made.blocks.items():
        for place, item in enumerate(which):
            for _ in range(50):
                flips = rng.choice(64, rng.integers(0, decontaminate.RADIUS + 1), replace=False)
                value = np.array([int(made.prints[item]) ^ sum(1 << int(b) for b in flips)], "<u8").view(np.uint8)
                assert any(near[b][value[b], place] for b in range(8))
