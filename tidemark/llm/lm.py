"""Language-model scores by stupid backoff over n-gram counts of the whole corpus.

The score of a word c after a, b is count(abc) / count(ab) when abc occurs at least
``least`` times, else ``alpha`` times the score of c after b, and in the end of the word's
own share of all words. A document's score is the mean of the logarithms over its words.
The first words of a document have the shorter contexts there are.

Counts are joined relationally. A bundle, a run of texts of one input partition, has one
row for each n-gram order and hash range with the hashes of its distinct n-grams and how
often it holds them. Rows of all bundles meet by hash range, where they are summed to the
count table of that range, and the totals of the n-grams that a bundle asked for go back
to it. There they are joined to the n-grams of its texts and summed by document. Frequent
n-grams are one entry a bundle, hash ranges are even, and their number follows the size of
the corpus, so no group grows.

Words are runs without ASCII white space, in lower case for A to Z; n-grams are told apart
by 64-bit hashes. Null and empty texts and texts without words have no words and a null
score. Repeated rows count and are scored each; a null id is passed on. An empty table
gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import gram_hashes, packed, prepared, unpacked, utf8, word_hashes
from tidemark.session import stored

ORDER = 3
ALPHA = 0.4
LEAST = 2
BUNDLE_BYTES = 16 << 20
# Bytes of text to a hash range: some hundred thousand n-grams of each order.
RANGE_BYTES = 4 << 20
_FOLD = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_INSIDE = np.array([not (b == 32 or 9 <= b <= 13) for b in range(256)])


class Grams:
    """The words of some texts, and their n-grams of one order at a time."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.words, self.first = word_hashes(data, offsets, _FOLD, _INSIDE)
        places = np.arange(len(self.words), dtype=np.int32)
        self.place = places - np.repeat(self.first[:-1].astype(np.int32), np.diff(self.first))

    def whole(self, size: int) -> np.ndarray:
        """Whether a text has an n-gram that ends at each word."""
        return self.place >= size - 1

    def hashed(self, size: int) -> np.ndarray:
        """Hashes of the n-grams, in order of the words they end at."""
        ends = np.flatnonzero(self.whole(size)) - (size - 1)
        return gram_hashes(self.words, size)[ends]


def _ranges(keys: np.ndarray, count: int) -> list[tuple[int, slice]]:
    """The hash ranges that sorted keys fall into, and where the keys of each are."""
    part = ((keys >> np.uint64(32)) * np.uint64(count)) >> np.uint64(32)
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(keys)]
    return [(int(part[a]), slice(a, b)) for a, b in zip(edges, edges[1:]) if a < b]


def _joined(batches: list[pa.Array]) -> pa.Array:
    return pa.concat_arrays([b.cast(pa.large_string()) for b in batches])


_ROWS = "bundle long, seal long, texts binary, lengths binary, ids array<long>, part int, size int, keys binary, counts binary"


def _bundles(order: int, parts: int, limit: int):
    """Two kinds of rows: the compressed texts of a bundle, and its n-grams of one range.

    Both kinds are read in a pass of their own over the input. ``seal``, a checksum of the
    texts, keeps them apart if the input's partitions differ between the two.
    """
    names = [f.split()[0] for f in _ROWS.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.int32(), pa.int32(), pa.binary(), pa.binary()]

    def closed(number: int, ids: list, texts: list[pa.Array]) -> Iterator[pa.RecordBatch]:
        data, offsets = utf8(_joined(texts))
        content = data.tobytes()
        seal = zlib.crc32(content)
        compressed = zstandard.compress(content, 3)
        lengths = packed(np.diff(offsets), "<i8")
        rows = [(number, seal, compressed, lengths, ids, None, None, None, None)]
        grams = Grams(data, offsets)
        del data, content
        for size in range(1, order + 1):
            keys, counts = np.unique(grams.hashed(size), return_counts=True)
            for part, some in _ranges(keys, parts):
                steps = np.diff(keys[some], prepend=np.uint64(0))
                rows.append((number, seal, None, None, None, part, size, packed(steps, "<u8"), packed(counts[some])))
        for at in range(0, len(rows), 500):
            columns = zip(*rows[at : at + 500])
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, size, ids, texts = TaskContext.get().partitionId() << 24, 0, [], []
        for batch in batches:
            for at in range(0, batch.num_rows, 100):
                some = batch.slice(at, 100)
                ids += some["doc_id"].to_pylist()
                texts.append(some["text"].fill_null(""))
                size += int(utf8(some["text"])[1][-1])
                if size >= limit:
                    yield from closed(number, ids, texts)
                    number, size, ids, texts = number + 1, 0, [], []
        if ids:
            yield from closed(number, ids, texts)

    return run


def _totals(rows: pd.DataFrame) -> pd.DataFrame:
    """The count table of one hash range and order, given back to each bundle for its n-grams."""
    keys = [np.cumsum(unpacked(k, "<u8"), dtype=np.uint64) for k in rows["keys"]]
    counts = np.concatenate([unpacked(c) for c in rows["counts"]])
    found, place = np.unique(np.concatenate(keys), return_inverse=True)
    totals = np.bincount(place, counts, len(found)).astype(np.int64)[place]
    ends = np.cumsum([len(k) for k in keys])
    back = [packed(t, "<i8") for t in np.split(totals, ends[:-1])]
    return pd.DataFrame({"bundle": rows["bundle"], "seal": rows["seal"], "part": rows["part"], "size": rows["size"], "totals": back})


def _answered(hashed: np.ndarray, known: np.ndarray) -> np.ndarray:
    """The count of every n-gram from those of the distinct ones, which are in order of their hashes."""
    order = np.argsort(hashed)
    ordered = hashed[order]
    rank = np.cumsum(np.append(False, ordered[1:] != ordered[:-1])[: len(hashed)])
    if len(known) != (rank[-1] + 1 if len(rank) else 0):
        raise RuntimeError("counts of a bundle are missing: the input's rows came in other partitions when read again")
    out = np.empty(len(hashed), np.int64)
    out[order] = known[rank]
    return out


def _scored(order: int, alpha: float, least: int):
    def run(texts: pd.DataFrame, totals: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in texts.itertuples():
            lengths = unpacked(row.lengths, "<i8")
            ids = pd.array([None if pd.isna(i) else int(i) for i in row.ids], "Int64")
            data = np.frombuffer(zstandard.decompress(row.texts), np.uint8)
            grams = Grams(data, np.concatenate([[0], np.cumsum(lengths)]))
            first = grams.first
            del data
            counts = []
            for n in range(1, order + 1):
                answer = totals[totals["size"] == n].sort_values("part")["totals"]
                known = np.concatenate([np.empty(0, np.int64), *[unpacked(t, "<i8") for t in answer]])
                count = np.zeros(len(grams.words), np.int64)
                count[grams.whole(n)] = _answered(grams.hashed(n), known)
                counts.append(count)
            logs, open_words = _logs(counts, alpha, least)
            sums = np.add.reduceat(np.append(logs, 0.0), first[:-1])
            unigrams = np.add.reduceat(np.append(open_words, 0), first[:-1])
            words = np.diff(first)
            out.append(pd.DataFrame({"doc_id": ids, "n_words": words, "logs": np.where(words > 0, sums, 0.0), "shares": np.where(words > 0, unigrams, 0)}))
        return pd.concat(out) if out else pd.DataFrame({"doc_id": [], "n_words": [], "logs": [], "shares": []})

    return run


def _logs(counts: list[np.ndarray], alpha: float, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Log score of every word without the number of all words, and where that is missing.

    ``counts`` has by order the count of the n-gram that ends at a word, 0 where its text
    begins later. The context's count is that of the n-gram one shorter, one word before.
    """
    words = len(counts[0])
    logs, done, penalty = np.zeros(words), np.zeros(words, bool), np.zeros(words)
    for size in range(len(counts), 1, -1):
        context = np.concatenate([[0], counts[size - 2][:-1]])[:words]
        seen = ~done & (counts[size - 1] >= least)
        logs[seen] = np.log(counts[size - 1][seen] / context[seen]) + penalty[seen]
        done |= seen
        penalty[(counts[size - 1] > 0) & ~done] += np.log(alpha)
    logs[~done] = np.log(counts[0][~done]) + penalty[~done]
    return logs, (~done).astype(np.int64)


def scores(docs: DataFrame, order: int = ORDER, alpha: float = ALPHA, least: int = LEAST, bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """(doc_id, n_words, score) of every row of ``docs``; score is the mean log of its words.

    ``docs`` must give the same rows in the same partitions when read twice, as files do;
    otherwise the job fails.
    """
    prepared(docs.sparkSession)
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(16, -(-total // RANGE_BYTES))
    rows = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_bundles(order, parts, bundle_bytes), _ROWS)
    asked = rows.where("part is not null").select("bundle", "seal", "part", "size", "keys", "counts")
    totals = asked.groupBy("part", "size").applyInPandas(_totals, "bundle long, seal long, part int, size int, totals binary")
    texts = rows.where("part is null").select("bundle", "seal", "texts", "lengths", "ids")
    scored = texts.groupBy("bundle", "seal").cogroup(totals.groupBy("bundle", "seal")).applyInPandas(
        _scored(order, alpha, least), "doc_id long, n_words long, logs double, shares long"
    )
    scored = stored(scored, "scores")
    words = scored.agg(F.sum("n_words")).first()[0] or 1
    mean = (F.col("logs") - F.col("shares") * F.log(F.lit(float(words)))) / F.col("n_words")
    return scored.select("doc_id", "n_words", F.when(F.col("n_words") > 0, mean).alias("score"))
