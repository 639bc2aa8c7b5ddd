import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import fim

UNIT = {"words": re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"), "chars": re.compile(r"(?s).")}


def by_hand(doc_id, text, unit, rate, suffix_first):
    text = text or ""
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    units = UNIT[unit].findall(text)
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < suffix_first:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


ODD = [" ", "\n\n", " a", "a ", "é", "é 中文🙂 x\x85y\xa0z ", "<P> in it", "a <M> b", "<", "<S", "🙂" * 50, "ab<S>", "\0 \x0b\x0c", "x" * 300_000 + " é " * 50_000]


@pytest.mark.parametrize("unit", ["words", "chars"])
@pytest.mark.parametrize("rate, suffix_first", [(50, 80), (100, 50), (0, 50)])
def test_against_a_plain_version(spark, make_docs, odd_rows, unit, rate, suffix_first):
    rows = [*odd_rows, *[(1000 + 7 * k, t) for k, t in enumerate(ODD * 3)]]
    made = fim.transform(make_docs(rows), rate=rate, suffix_first=suffix_first, unit=unit).withColumn("back", fim.restored(F.col("output"), F.col("form")))
    got = sorted(map(repr, ((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.back) for r in made.collect())))
    assert got == sorted(repr((i, *by_hand(i, t, unit, rate, suffix_first), t or "")) for i, t, *_ in rows)


def test_all_forms_occur(spark, make_docs):
    made = fim.transform(make_docs([(k, f"some words é {k} of a text") for k in range(300)]))
    counts = {r.form: r["count"] for r in made.groupBy("form").count().collect()}
    assert counts["plain"] > 100 and counts["spm"] > counts["psm"] > 5


def test_index_converts_both_ways():
    text = "aé中🙂b" * 40 + "plain" + "ß"
    data = np.frombuffer(text.encode(), np.uint8)
    index = fim.Exceptions(data)
    points = np.arange(len(text) + 1)
    places = np.array([len(text[:k].encode()) for k in points])
    assert (index.to_bytes(points) == places).all() and (index.to_points(places) == points).all()
    assert len(index.at) == sum(ord(c) > 127 for c in text)


def test_empty_table_and_wrong_unit(spark, make_docs):
    assert fim.transform(make_docs([(1, "x")]).limit(0)).count() == 0
    with pytest.raises(ValueError):
        fim.transform(make_docs([(1, "x")]), unit="tokens")
