"""Toxicity by subword-bag embeddings averaged into a linear softmax.

A text is the bag of the character n-grams of its words, word edges included. Each n-gram
has a hashed embedding; their mean over the whole text goes into a softmax of two classes.
Embeddings and softmax are trained together in numpy, so a misspelt or inflected word that
was never seen shares the vectors of the n-grams it has in common with seen ones.

Null and empty texts have no n-grams and score by the bias alone. Without rows of both
classes to learn from every score is 0. Very long texts only have larger bags. A document
labelled more than once counts as toxic if any label says so. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import held_out, packed, prepared, unpacked, utf8
from tidemark.llm.sampling import bounded_sample

SIZES = (3, 4, 5, 6)
BUCKET_BITS = 18
# Neutral n-grams in every mean, so that a few words alone decide less than many do.
NEUTRAL = 40
_SPACE = 32
# Word characters by byte: ASCII letters in lower case, digits, and all bytes of other
# characters; anything else ends a word.
_FOLD = np.array([b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or 48 <= b <= 57 or b >= 128 else _SPACE for b in range(256)], np.uint8)


@dataclass
class Model:
    gain: np.ndarray  # per bucket: embedding times the difference of the class weights
    bias: float


def grams(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per n-gram size: the bucket at each byte, whether an n-gram starts there, text starts.

    Texts are put between blanks, so no n-gram reaches into the next one.
    """
    text = column.cast(pa.large_string()).fill_null("")
    data, offsets = utf8(pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), text, pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string())))
    folded = _FOLD[data]
    inside = folded != _SPACE
    hashed = folded.astype(np.uint32)
    whole = np.ones(len(folded), bool)
    for size in range(2, SIZES[-1] + 1):
        if len(hashed) < 2:
            return
        count = len(folded) - size + 1
        if count <= 0:
            return
        hashed = hashed[:count] * np.uint32(0x01000193) + folded[size - 1 :]
        whole = whole[:count] & inside[size - 2 : size - 2 + count] if size > 2 else whole[:count]
        if size in SIZES:
            mixed = (hashed ^ (hashed >> np.uint32(15))) * np.uint32(0x9E3779B1 + 2 * size)
            yield mixed >> np.uint32(32 - BUCKET_BITS), whole, offsets


def _summed(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums by text of values that stand at the bytes; no text is empty, blanks surround it."""
    return np.add.reduceat(values, offsets[:-1], dtype=np.float64)


def scores(model: Model, column: pa.Array) -> np.ndarray:
    """Probability of the toxic class of every text."""
    total, count = np.zeros(len(column)), np.zeros(len(column))
    for bucket, whole, offsets in grams(column):
        pad = int(offsets[-1]) - len(bucket)
        gains = np.pad(model.gain[bucket] * whole, (0, pad))
        total += _summed(gains, offsets)
        count += _summed(np.pad(whole, (0, pad)), offsets)
    return 1 / (1 + np.exp(-np.clip(total / (count + NEUTRAL) + model.bias, -60, 60)))


def bag(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text and how many of its n-grams fall into each."""
    found = [bucket[whole] for bucket, whole, _ in grams(pa.array([text], pa.string()))]
    buckets, counts = np.unique(np.concatenate(found) if found else np.empty(0, np.uint32), return_counts=True)
    return buckets.astype(np.int32), counts.astype(np.int32)


def shares(counts: np.ndarray) -> np.ndarray:
    """The weight of each bucket in the mean of a text."""
    return (counts / (counts.sum() + NEUTRAL)).astype(np.float32)


def fit(bags: list[tuple[np.ndarray, np.ndarray]], toxic: np.ndarray, width: int = 4, epochs: int = 10, batch: int = 48, rate: float = 0.5, scale: float = 30.0, seed: int = 3) -> Model:
    """Embeddings and softmax together, by Adagrad on shuffled batches.

    Means over hundreds of n-grams are small, so they enter the softmax times ``scale``.
    """
    rng = np.random.default_rng(seed)
    size = 1 << BUCKET_BITS
    vectors = (rng.standard_normal((width, size)) * 0.01).astype(np.float32)
    weights, bias = (rng.standard_normal((width, 2)) * 0.5).astype(np.float32), np.zeros(2, np.float32)
    seen = np.full((width, size), 1e-6, np.float32), np.full((width, 2), 1e-2, np.float32), np.full(2, 1e-2, np.float32)
    for epoch in range(epochs):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), batch):
            some = order[at : at + batch]
            index = np.concatenate([bags[i][0] for i in some])
            share = np.concatenate([shares(bags[i][1]) for i in some]) * np.float32(scale)
            owner = np.repeat(np.arange(len(some)), [len(bags[i][0]) for i in some])
            mean = np.stack([np.bincount(owner, vectors[k][index] * share, len(some)) for k in range(width)], axis=1)
            logits = mean @ weights + bias
            error = np.exp(logits - logits.max(axis=1, keepdims=True))
            error /= error.sum(axis=1, keepdims=True)
            error[np.arange(len(some)), toxic[some]] -= 1
            error /= len(some)
            d_mean = (error @ weights.T).astype(np.float32)
            used, place = np.unique(index, return_inverse=True)
            for k in range(width):
                g = np.bincount(place, share * d_mean[owner, k], len(used)).astype(np.float32)
                seen[0][k][used] += g * g
                vectors[k][used] -= rate * 0.1 * g / np.sqrt(seen[0][k][used])
            for a, g, s in ((weights, mean.T @ error, seen[1]), (bias, error.sum(axis=0), seen[2])):
                s += g * g
                a -= (rate * 0.2 * g / np.sqrt(s)).astype(np.float32)
    change = (weights[:, 1] - weights[:, 0]) * np.float32(scale)
    return Model((change @ vectors).astype(np.float32), float(bias[1] - bias[0]))


def train(docs: DataFrame, labels: DataFrame, most_toxic: int = 1500, most_clean: int = 4000, **options) -> Model | None:
    """A model of a bounded number of labelled rows of either class, none of them held out.

    An id that repeats gives one of its texts, the one with the largest hash. Bags are made
    on the executors; the driver gets those of the sample, packed.
    """
    prepared(docs.sparkSession)
    marked = labels.where("doc_id is not null and toxic in (0, 1)").where(~held_out(F.col("doc_id")))
    marked = marked.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    sample = bounded_sample(marked, "toxic", {1: most_toxic, 0: most_clean})  # hence small enough to broadcast

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [bag(t.as_py()) for t in batch["text"]]
            steps = [packed(np.diff(b, prepend=0)) for b, _ in made]
            columns = [batch["doc_id"], batch["toxic"], pa.array(steps, pa.binary()), pa.array([packed(c) for _, c in made], pa.binary())]
            yield pa.record_batch(columns, ["doc_id", "toxic", "steps", "counts"])

    chosen = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(sample.select("doc_id", "toxic")), "doc_id")
    one = F.max(F.struct(F.xxhash64("text").alias("hash"), "text"))["text"].alias("text")
    rows = chosen.groupBy("doc_id", "toxic").agg(one).mapInArrow(run, "doc_id long, toxic int, steps binary, counts binary").collect()
    rows.sort(key=lambda r: (r.doc_id, bytes(r.steps), bytes(r.counts)))
    toxic = np.array([r.toxic for r in rows])
    if len(set(toxic.tolist())) < 2:
        return None
    bags = [(np.cumsum(unpacked(bytes(r.steps)), dtype=np.int32), unpacked(bytes(r.counts))) for r in rows]
    return fit(bags, toxic, **options)


def score_documents(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, score) of every row; the score is rounded to six places."""
    spark = prepared(docs.sparkSession)
    weights = None if model is None else (model.gain, model.bias)
    shared = spark.sparkContext.broadcast(weights)  # one float for each of the fixed number of buckets

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = shared.value is not None and batch.num_rows
            found = scores(Model(*shared.value), batch["text"]).round(6) if known else np.zeros(batch.num_rows)
            yield pa.record_batch([batch["doc_id"].cast(pa.int64()), pa.array(found, pa.float64())], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double")
