import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import bpe, decontaminate, langid, secrets, simhash
from tidemark.llm.common import table

SF = "/root/testdata/sf0.001"


@pytest.fixture
def quick_training(monkeypatch):
    real = langid.fit
    monkeypatch.setattr(langid, "fit", lambda *a, **b: real(*a, **b | {"rounds": 40}))


def test_stages_and_run_agree_with_steps_by_hand(spark, quick_training):
    docs = table(spark, SF, "documents")
    rows = docs.collect()
    net = langid.train(docs)
    named = {r.doc_id: (r.p, r.s) for r in langid.identify(docs, net, "p", "s").collect()}
    rows = [r for r in rows if named[r.doc_id][0] != "und" and named[r.doc_id][1] >= corpus_pipeline.MIN_SCORE]

    prints = {r.doc_id: simhash.fingerprint(r.text) for r in rows}
    root = {i: i for i in prints}
    changed = True
    while changed:  # smallest id reachable, by brute force
        changed = False
        for a in prints:
            for b in prints:
                if (prints[a] ^ prints[b]).bit_count() <= 2 and root[b] < root[a]:
                    root[a], changed = root[b], True
    rows = [r for r in rows if root[r.doc_id] == r.doc_id]

    benchmark = table(spark, SF, "benchmark")
    items = [tuple(r) for r in benchmark.select("item_id", "text").collect()]
    import pyarrow as pa

    hit = {m[0] for m in decontaminate.matches(pa.array([r.text for r in rows]), decontaminate.index(items))}
    rows = [r for k, r in enumerate(rows) if k not in hit]

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(None, path), special_tokens={})
    ledger = secrets.Ledger.create(spark)
    ledger.ingest(docs)
    spans = {r.doc_id: r.spans for r in secrets.report(docs, ledger).collect()}

    def redacted(r):
        merged = []
        for _, start, end in sorted((s.split(":") for s in spans[r.doc_id].split(",") if s), key=lambda x: (int(x[1]), int(x[2]))):
            if merged and int(start) <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], int(end))
            else:
                merged.append([int(start), int(end)])
        text = r.text
        for start, end in reversed(merged):
            text = text[:start] + "[secret]" + text[end:]
        return text

    want = {r.doc_id: library.encode_ordinary(redacted(r)) for r in rows}
    got = {r.doc_id: r.ids for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == want and 0 < len(got) < docs.count()


def test_stages_keep_the_columns_and_take_odd_rows(spark, make_docs, odd_rows, quick_training):
    docs = make_docs([*odd_rows, (50, "a clean text of the usual kind"), (51, "token = abcdefghij")])
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "decontamination", "secrets", "byte_bpe"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        assert {r.doc_id for r in out.collect()} >= {50}
        assert stage(spark, docs.limit(0), SF).count() == 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert last.where(F.col("ids").isNull()).count() == 0 and last.count() == docs.count()
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), SF).count() == 0
