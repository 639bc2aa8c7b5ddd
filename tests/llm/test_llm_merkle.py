import hashlib
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from tidemark.llm import merkle

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def proofs(leaves):
    """Root of a list of nodes, and the (sibling, side) steps of each."""
    steps, nodes, owners = [[] for _ in leaves], list(leaves), [[i] for i in range(len(leaves))]
    while len(nodes) > 1:
        above, held = [], []
        for i in range(0, len(nodes), 2):
            run = nodes[i : i + 2]
            for k in range(len(run)):
                for owner in owners[i + k]:
                    steps[owner].append((run[1 - k], "lr"[1 - k]) if len(run) == 2 else ("", "-"))
            above.append(digest("".join(run)))
            held.append([o for k in range(len(run)) for o in owners[i + k]])
        nodes, owners = above, held
    return nodes[0], steps


def by_hand(rows, claim):
    """(doc_id, leaf, subroot, root, proof, sides, folded, verified), row by row."""
    first = lambda v: (v is not None, v)
    order = sorted(rows, key=lambda r: ((r[2] is not None, (r[2] or "").encode()), (r[0] is not None, r[0] or 0), leaf(r)))
    trees = [list(g) for _, g in groupby(order, key=lambda r: first(r[2]))]
    found = [proofs([leaf(r) for r in t]) for t in trees]
    root, upper = proofs([f[0] for f in found])
    out = []
    for tree, (subroot, steps), up in zip(trees, found, upper):
        for row, path in zip(tree, steps):
            path = path + up
            node = leaf(claim(row))
            for other, side in path:
                node = digest(other + node if side == "l" else node + other)
            out.append((row[0], leaf(row), subroot, root, "".join(o for o, _ in path), "".join(s for _, s in path), node, node == root))
    return out


def planted(sizes):
    rows = []
    for lang, size in sizes.items():
        rows += [(len(rows) * 3 % 1009, f"s{k % 3}" if k % 4 else None, lang, k if k % 5 else None, f"text é {k} {lang}" if k % 6 else None) for k in range(size)]
    return rows


@pytest.mark.parametrize(
    "sizes", [{"en": 1}, {"en": 2}, {"en": 3, None: 1}, {"en": 37, "de": 8, "": 9, None: 5, "zh": 16, "é": 1}, {f"l{k}": 1 + k % 7 for k in range(40)}]
)
def test_against_a_plain_version(spark, sizes):
    rows = planted(sizes)
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, source string, lang string, n_chars long, text string, tree string, pos int").repartition(3)
    odd = F.col("doc_id") % 7 == 0
    claimed = {"n_chars": F.col("n_chars") + F.when(odd, 1).otherwise(0)}
    claim = lambda r: (*r[:3], r[3] + 1 if r[3] is not None and r[0] % 7 == 0 else r[3], r[4])
    want = sorted(by_hand(rows, claim))
    for bits in (2, 10):
        made = merkle.manifest(docs, FIELDS, group="lang", key="doc_id", claimed=claimed, bits=bits).collect()
        assert sorted((r.doc_id, r.leaf, r.subroot, r.root, r.proof, r.sides, r.folded_root, r.verified) for r in made) == want
        assert all(merkle.fold(r.leaf, r.proof, r.sides) == r.root for r in made)


def test_odd_rows(spark, make_docs, odd_rows):
    rows = [*odd_rows, (None, "another without an id"), (None, "a row without an id")]
    docs = make_docs(rows)
    made = merkle.manifest(docs, FIELDS, group="lang", key="doc_id", bits=2).collect()
    plain = [tuple(r) for r in docs.select(*FIELDS).collect()]
    got = [(r.doc_id, r.leaf, r.subroot, r.root, r.proof, r.sides, r.folded_root, r.verified) for r in made]
    assert sorted(got, key=repr) == sorted(by_hand(plain, lambda r: r), key=repr)
    assert all(r.verified for r in made) and len(made) == len(rows)


def test_equal_rows_and_layouts(spark):
    """A third of all rows are one row; the manifest does not depend on the partitions."""
    rows = [(5, "s", "en", 1, "same")] * 100 + [(k, "s", "en" if k % 2 else "fr", 1, f"t{k}") for k in range(200)]
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    results = []
    for parts in (1, 7):
        made = merkle.manifest(spark.createDataFrame(rows, schema).repartition(parts), FIELDS, group="lang", key="doc_id", bits=4)
        results.append(sorted(map(tuple, made.collect())))
    assert results[0] == results[1] and len(results[0]) == 300
    assert sorted(r[2] for r in {(r[0], r[1], r[2]) for r in results[0]} if r[1] == "fr") == list(range(100))


def test_changes_show(spark):
    rows = spark.createDataFrame([(k, "s", "en", 1, f"t{k}") for k in range(20)], "doc_id long, source string, lang string, n_chars long, text string")
    claimed = {"text": F.when(F.col("doc_id") == 4, "other").otherwise(F.col("text"))}
    made = merkle.manifest(rows, FIELDS, group="lang", key="doc_id", claimed=claimed).collect()
    assert [r.doc_id for r in made if not r.verified] == [4]


def test_empty(spark, make_docs):
    assert merkle.manifest(make_docs([(1, "x")]).limit(0), FIELDS, group="lang", key="doc_id").count() == 0
