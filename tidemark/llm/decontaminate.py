"""Benchmark decontamination by SimHash windows of the size of each item.

Words are runs of ASCII letters (case folded), digits and non-ASCII characters; shingles
are five words, a shorter item or text is one shingle as a whole. For each item size,
windows of that many words slide over a text. A window's SimHash goes to a multi-index of
the items of that size: fingerprints are cut into blocks, and within the radius at least
one block is within the radius divided by the number of blocks, so no item within the
radius is missed. Candidates are verified by the weighted Jaccard similarity of their
shingles, repeats counted, which must be 0.8 or more.

Windows that cannot reach the similarity are not hashed: the similarity bounds from below
how many shingles of an item a window shares, so a text that holds fewer of them has no
such window, and every such window holds one of them.

Null and empty texts and texts without words match nothing, nor do such items. Repeated
rows are reported each; a null id stays null, of a document as of an item. Texts shorter than an item are compared as
one window. Empty tables give empty results. Other columns are ignored or passed through.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import gram_hashes, prepared, utf8, word_hashes

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 23
_BLOCKS = 8
# Items are taken to the executors in groups of at most so many characters.
GROUP_CHARS = 32 << 20
_FOLD = np.array([b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or 48 <= b <= 57 or b >= 128 else 0 for b in range(256)], np.uint8)
_FILTER_BITS = 22


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return word_hashes(data, offsets, _FOLD, _FOLD != 0)


def shingles(hashes: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    return gram_hashes(hashes, size)


def _signs(values: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(values.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.astype(np.int32) * 2 - 1


def _fingerprints(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums > 0, axis=1, bitorder="little").view("<u8").ravel()


@dataclass
class Items:
    """Benchmark items of one group, and the multi-index over their fingerprints."""

    ids: list
    size: np.ndarray  # words
    bags: list[tuple[np.ndarray, np.ndarray]]  # shingles and their counts
    prints: np.ndarray
    shingle: np.ndarray  # all shingles of items of at least SHINGLE words, sorted
    owner: np.ndarray  # the item of each
    filter: np.ndarray  # which leading bits any shingle has
    blocks: dict[int, tuple[np.ndarray, np.ndarray]]  # by size: the items, and (block, value, item) near enough


def index(rows: list[tuple[int | None, str]]) -> Items:
    data, offsets = utf8(pa.array([text for _, text in rows], pa.string()))
    hashes, first = words(data, offsets)
    size = np.diff(first)
    bags, prints, pairs = [], np.zeros(len(rows), np.uint64), []
    for i in range(len(rows)):
        made = shingles(hashes[first[i] : first[i + 1]], min(SHINGLE, max(1, size[i])))
        bags.append(np.unique(made, return_counts=True))
        if size[i]:
            prints[i] = _fingerprints(_signs(made).sum(axis=0, keepdims=True))[0]
            pairs.append((bags[i][0], np.full(len(bags[i][0]), i)))
    every = np.concatenate([p[0] for p in pairs]) if pairs else np.empty(0, np.uint64)
    owner = np.concatenate([p[1] for p in pairs]) if pairs else np.empty(0, np.int64)
    order = np.argsort(every, kind="stable")
    leading = np.zeros(1 << _FILTER_BITS, bool)
    leading[every >> np.uint64(64 - _FILTER_BITS)] = True
    octets = prints.astype("<u8").view(np.uint8).reshape(-1, 8)
    spread = np.bitwise_count(np.arange(256, dtype=np.uint8)[:, None] ^ octets.ravel()).reshape(256, len(rows), _BLOCKS)
    near = (spread <= RADIUS // _BLOCKS).transpose(2, 0, 1)
    blocks = {int(n): (which := np.flatnonzero(size == n), near[:, :, which]) for n in np.unique(size) if n}
    return Items([i for i, _ in rows], size, bags, prints, every[order], owner[order], leading, blocks)


def _least_shared(window: int, item: int) -> int:
    """Shingles two bags of these sizes share at least when similar enough."""
    return math.ceil(SIMILARITY / (1 + SIMILARITY) * (window + item) - 1e-9)


def _similarity(window: np.ndarray, bag: tuple[np.ndarray, np.ndarray]) -> float:
    values, counts = np.unique(window, return_counts=True)
    at = np.minimum(np.searchsorted(bag[0], values), len(bag[0]) - 1)
    shared = int(np.minimum(counts, bag[1][at])[bag[0][at] == values].sum())
    return shared / (len(window) + int(bag[1].sum()) - shared)


def _windows(text: np.ndarray, size: int, starts: np.ndarray, items: Items) -> Iterator[tuple[int, int, int]]:
    """(start, item, distance) of windows at ``starts`` with an item of ``size`` within the radius.

    ``text`` has the shingles of a text; a window has as many of them as an item of that
    size, or all.
    """
    count = min(len(text), max(1, size - SHINGLE + 1))
    which, near = items.blocks[size]
    for run in np.split(starts, np.flatnonzero(np.diff(starts) > count) + 1):
        begin = int(run[0])
        sums = np.zeros((int(run[-1]) + count - begin + 1, 64), np.int32)
        np.cumsum(_signs(text[begin : begin + len(sums) - 1]), axis=0, out=sums[1:])
        prints = _fingerprints(sums[run - begin + count] - sums[run - begin])
        octets = prints.view(np.uint8).reshape(-1, 8)
        candidate = reduce(np.logical_or, (near[b][octets[:, b]] for b in range(_BLOCKS)))
        row, column = np.nonzero(candidate)
        distance = np.bitwise_count(prints[row] ^ items.prints[which[column]])
        for r, c, d in zip(row, column, distance):
            if d <= RADIUS:
                yield int(run[r]), int(which[c]), int(d)


def matches(column: pa.Array, items: Items) -> list[tuple[int, int, int, int, int, float]]:
    """(row, item, first word, words, distance, similarity): the best window of each row and item."""
    data, offsets = utf8(column)
    hashes, first = words(data, offsets)
    found = []
    for size in [n for n in items.blocks if n < SHINGLE]:
        found += _short(hashes, first, size, items)
    grams = shingles(hashes)
    hit = np.flatnonzero(items.filter[grams >> np.uint64(64 - _FILTER_BITS)]) if len(items.shingle) else np.empty(0, np.int64)
    low = np.searchsorted(items.shingle, grams[hit], side="left")
    high = np.searchsorted(items.shingle, grams[hit], side="right")
    row = np.searchsorted(first, hit, side="right") - 1
    real = (high > low) & (hit + SHINGLE <= first[row + 1])  # not across two texts
    hit, row, low, high = hit[real], row[real], low[real], high[real]
    for some in np.split(np.arange(len(hit)), np.flatnonzero(np.diff(row)) + 1) if len(hit) else []:
        r = int(row[some[0]])
        text = grams[first[r] : first[r + 1] - SHINGLE + 1]
        place = np.repeat(hit[some] - first[r], high[some] - low[some])
        owner = items.owner[np.concatenate([np.arange(a, b) for a, b in zip(low[some], high[some])])]
        starts: dict[int, list] = {}
        for item in np.unique(owner):
            size, at = int(items.size[item]), place[owner == item]
            count = min(len(text), size - SHINGLE + 1)
            if size >= SHINGLE and len(at) >= _least_shared(count, size - SHINGLE + 1):
                from_, to = np.maximum(0, at - count + 1), np.minimum(at, len(text) - count)
                marks = np.zeros(len(text) + 1, np.int64)
                np.add.at(marks, from_, 1)
                np.add.at(marks, to + 1, -1)
                starts.setdefault(size, []).append(np.flatnonzero(np.cumsum(marks[:-1]) > 0))
        best: dict[int, tuple] = {}
        for size, parts in starts.items():
            for start, item, distance in _windows(text, size, np.unique(np.concatenate(parts)), items):
                count = min(len(text), size - SHINGLE + 1)
                similar = _similarity(text[start : start + count], items.bags[item])
                if similar >= SIMILARITY and (item not in best or similar > best[item][-1]):
                    best[item] = (r, item, start, count + SHINGLE - 1, distance, similar)
        found += best.values()
    return found


def _short(hashes: np.ndarray, first: np.ndarray, size: int, items: Items) -> list[tuple]:
    """Items of fewer words than a shingle: one shingle as a whole, equal or not."""
    grams, found = shingles(hashes, size), {}
    for item in items.blocks[size][0]:
        for at in np.flatnonzero(grams == items.bags[item][0][0]):
            row = int(np.searchsorted(first, at, side="right")) - 1
            if at + size <= first[row + 1]:
                found.setdefault((row, int(item)), (row, int(item), int(at - first[row]), size, 0, 1.0))
    return list(found.values())


def _groups(benchmark: DataFrame) -> list[DataFrame]:
    """Items in groups of a bounded number of characters; most benchmarks are one group."""
    items = benchmark.select(F.col("item_id").cast("long"), "text").where("text is not null")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    count = max(1, -(-2 * total // GROUP_CHARS)) if total > GROUP_CHARS else 1
    return [items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == k) for k in range(count)]


def _indexed(group: DataFrame) -> Items:
    rows = [(r.item_id, r.text) for r in group.distinct().collect()]  # bounded by GROUP_CHARS
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    return index(rows)


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, first_word, n_words, distance, similarity) of every row that holds an item.

    One row for each row of ``docs`` and item, of the most similar window, the first of
    equals. Texts are read once for each group of items and never shuffled.
    """
    spark = prepared(docs.sparkSession)
    schema = "doc_id long, item_id long, first_word long, n_words long, distance int, similarity double"
    names = [part.split()[0] for part in schema.split(", ")]
    results = []
    for group in _groups(benchmark):
        shared = spark.sparkContext.broadcast(vars(_indexed(group)))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items = Items(**shared.value)
            for batch in batches:
                found = matches(batch["text"], items)
                ids = batch["doc_id"].cast(pa.int64()).take(pa.array([m[0] for m in found], pa.int64()))
                columns = [
                    pa.array([items.ids[m[1]] for m in found], pa.int64()),
                    *[pa.array([m[i] for m in found], pa.int64()) for i in (2, 3)],
                    pa.array([m[4] for m in found], pa.int32()),
                    pa.array([round(m[5], 6) for m in found], pa.float64()),
                ]
                yield pa.record_batch([ids, *columns], names)

        results.append(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema))
    return reduce(DataFrame.union, results)


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no item, in one pass for each group of items."""
    spark = prepared(docs.sparkSession)
    for group in _groups(benchmark):
        shared = spark.sparkContext.broadcast(vars(_indexed(group)))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items = Items(**shared.value)
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                keep[[m[0] for m in matches(batch["text"], items)]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
