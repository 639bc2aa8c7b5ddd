"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads the UTF-8 bytes of a text in windows of fixed length, labels every
byte, and the document's probabilities are the mean over all its bytes. It is trained in
numpy by backpropagation through time on windows of a bounded sample of labelled rows.

A text that is null or has no letter gets the label ``und`` and score 0. Without labelled
rows every text does. Very long texts are only more windows. Equal texts get equal labels;
rows with a null id or language are scored, never learned from. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.llm.common import held_out, prepared, utf8
from tidemark.llm.sampling import bounded_sample

UNKNOWN = "und"
WINDOW = 64
PAD = 256
_CHARS = 160  # characters taken per training window: at least WINDOW bytes where the text has them


@dataclass
class Network:
    """Weights by direction and gate: update, reset, candidate.

    Gates are piecewise linear, a quarter of the sum plus a half between 0 and 1; the
    candidate is a softsign, x / (1 + |x|). The reset gate scales what the state adds to it.
    """

    labels: list[str]
    inputs: np.ndarray  # (2, 3, 257, H)
    states: np.ndarray  # (2, 3, H, H)
    bias: np.ndarray  # (2, H), of the candidate inside the reset product
    out: np.ndarray  # (2H, K)
    out_bias: np.ndarray  # (K,)

    def arrays(self) -> list[np.ndarray]:
        return [self.inputs, self.states, self.bias, self.out, self.out_bias]


def _fresh(labels: list[str], hidden: int, rng: np.random.Generator) -> Network:
    def normal(*shape: int, scale: float) -> np.ndarray:
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    return Network(
        labels,
        normal(2, 3, PAD + 1, hidden, scale=0.4),
        normal(2, 3, hidden, hidden, scale=hidden**-0.5),
        np.zeros((2, hidden), np.float32),
        normal(2 * hidden, len(labels), scale=0.3),
        np.zeros(len(labels), np.float32),
    )


def _gate(codes: np.ndarray, h: np.ndarray, table: np.ndarray, turn: np.ndarray) -> np.ndarray:
    x = table.take(codes, axis=0)
    x += h @ turn
    x *= 0.25
    x += 0.5
    return np.clip(x, 0, 1, out=x)


def _run(net: Network, way: int, steps: np.ndarray, keep: list | None = None) -> np.ndarray:
    """Hidden states (steps, batch, H) of one direction over byte codes (steps, batch).

    Padding has the state zero, so what a window gives does not depend on how far it is padded.
    """
    tables, turns, bias = net.inputs[way], net.states[way], net.bias[way]
    h = np.zeros((steps.shape[1], len(bias)), np.float32)
    out = np.empty((len(steps), *h.shape), np.float32)
    padded = (steps == PAD).any(axis=1)
    for t, codes in enumerate(steps):
        z, r = _gate(codes, h, tables[0], turns[0]), _gate(codes, h, tables[1], turns[1])
        inner = h @ turns[2]
        inner += bias
        n = tables[2].take(codes, axis=0)
        n += r * inner
        n /= np.abs(n) + 1
        if keep is not None:
            keep.append((codes, h, z, r, n, inner))
        change = h - n
        change *= z
        h = np.add(n, change, out=out[t])
        if padded[t]:
            h[codes == PAD] = 0
    return out


def _probabilities(net: Network, codes: np.ndarray, kept: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(K, steps, batch) label probabilities of all positions, and the states under them."""
    ahead = _run(net, 0, codes, kept[0] if kept else None)
    back = _run(net, 1, codes[::-1], kept[1] if kept else None)[::-1]
    both = np.concatenate([ahead, back], axis=2)
    found = np.ascontiguousarray((both.reshape(-1, both.shape[2]) @ net.out + net.out_bias).T)
    found -= found.max(axis=0)
    np.exp(found, out=found)
    found /= found.sum(axis=0)
    return found.reshape(-1, *codes.shape), both


def _gradients(net: Network, codes: np.ndarray, target: np.ndarray, real: np.ndarray) -> list[np.ndarray]:
    """Gradients of the mean cross-entropy over real positions, in the order of arrays()."""
    kept: list[list] = [[], []]
    error, both = _probabilities(net, codes, kept)
    hidden = both.shape[2] // 2
    error[target, :, np.arange(codes.shape[1])] -= 1
    error *= (real / max(1, real.sum())).astype(np.float32)
    error = np.ascontiguousarray(error.transpose(1, 2, 0))  # (steps, batch, K)
    d_out = both.reshape(-1, 2 * hidden).T @ error.reshape(-1, error.shape[2])
    d_both = error @ net.out.T
    g_in, g_state, g_bias = (np.zeros_like(a) for a in (net.inputs, net.states, net.bias))
    for way in range(2):
        d_hidden = d_both[:, :, :hidden] if way == 0 else d_both[::-1, :, hidden:]
        carried, at, moved = np.zeros_like(d_hidden[0]), [], []
        for t in range(len(codes) - 1, -1, -1):
            step, h, z, r, n, inner = kept[way][t]
            d = (d_hidden[t] + carried) * (step != PAD)[:, None]
            d_n = d * (1 - z) * (1 - np.abs(n)) ** 2
            d_z = d * (h - n) * 0.25 * ((z > 0) & (z < 1))
            d_r = d_n * inner * 0.25 * ((r > 0) & (r < 1))
            d_inner = d_n * r
            carried = d * z
            for gate, change in enumerate((d_z, d_r, d_inner)):
                g_state[way, gate] += h.T @ change
                carried += change @ net.states[way, gate].T
            g_bias[way] += d_inner.sum(axis=0)
            at.append(step)
            moved.append((d_z, d_r, d_n))
        place = np.concatenate(at)
        for gate in range(3):
            change = np.concatenate([m[gate] for m in moved])
            for k in range(hidden):
                g_in[way, gate, :, k] = np.bincount(place, change[:, k], PAD + 1)
    return [g_in, g_state, g_bias, d_out, error.sum(axis=(0, 1))]


def windows(data: np.ndarray, offsets: np.ndarray, size: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where windows start, how long each is and the text it is of; together they cover all bytes."""
    lengths = np.diff(offsets)
    counts = -(-lengths // size)
    owner = np.repeat(np.arange(len(lengths)), counts)
    first = np.cumsum(counts) - counts
    starts = offsets[:-1][owner] + (np.arange(len(owner)) - first[owner]) * size
    return starts, np.minimum(size, offsets[1:][owner] - starts), owner


def _codes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(steps, batch) byte codes, padded, and which are real."""
    place = np.arange(int(lengths.max()))[:, None]
    real = place < lengths
    at = np.minimum(starts + place, len(data) - 1)
    return np.where(real, data[at].astype(np.int64), PAD), real


def fit(texts: list[bytes], labels: list[str], hidden: int = 8, rounds: int = 400, batch: int = 192, rate: float = 0.03, seed: int = 5) -> Network:
    """Train with Adam on random windows of the given texts, all classes alike."""
    names = sorted(set(labels))
    rng = np.random.default_rng(seed)
    net = _fresh(names, hidden, rng)
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    by_class = [np.array([i for i, x in enumerate(labels) if x == name]) for name in names]
    first, second = [np.zeros_like(a) for a in net.arrays()], [np.zeros_like(a) for a in net.arrays()]
    for step in range(1, rounds + 1):
        target = rng.integers(0, len(names), batch)
        row = np.array([rng.choice(by_class[k]) for k in target])
        room = np.maximum(1, offsets[row + 1] - offsets[row])
        shift = (rng.random(batch) * np.maximum(1, room - WINDOW // 2)).astype(np.int64)
        starts = offsets[row] + shift
        codes, real = _codes(data, starts, np.minimum(WINDOW, offsets[row + 1] - starts))
        now = rate * min(1.0, 2 * (1 - step / (rounds + 1)))
        for a, g, m, v in zip(net.arrays(), _gradients(net, codes, target, real), first, second, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            a -= now * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return net


def pooled(net: Network, data: np.ndarray, offsets: np.ndarray, block: int = 4096) -> np.ndarray:
    """(texts, K) mean label probabilities over all bytes of each text; zero for empty ones."""
    sums = np.zeros((len(offsets) - 1, len(net.labels)))
    starts, lengths, owner = windows(data, offsets)
    order = np.argsort(-lengths, kind="stable")  # full windows first: only few blocks are padded
    for at in range(0, len(order), block):
        some = order[at : at + block]
        codes, real = _codes(data, starts[some], lengths[some])
        found, _ = _probabilities(net, codes)
        if not real.all():
            found *= real
        np.add.at(sums, owner[some], found.sum(axis=1, dtype=np.float64).T)
    return sums / np.maximum(1, np.diff(offsets))[:, None]


def train(docs: DataFrame, per_language: int = 400, places: int = 4, **options) -> Network | None:
    """A network fitted on at most ``per_language`` rows of each language.

    From each drawn row come stretches at ``places`` hashed places of its whole text. The
    sample, a few hundred bytes times the bound, is all that the driver gets.
    """
    learn = docs.where("lang is not null and doc_id is not null and length(text) > 0").where(~held_out(F.col("doc_id")))
    keys = bounded_sample(learn.select("doc_id", "lang", "text"), "lang", per_language)
    room = F.greatest(F.lit(1), F.length("text") - F.lit(_CHARS // 2))
    spots = [F.substring(F.col("text"), (F.pmod(F.xxhash64("doc_id", F.lit(k)), room) + 1).cast("int"), F.lit(_CHARS)) for k in range(places)]
    rows = keys.select("doc_id", "lang", F.explode(F.array(*spots)).alias("part")).collect()
    rows = sorted((r.doc_id, r.lang, r.part) for r in rows if r.part)
    return fit([r[2].encode() for r in rows], [r[1] for r in rows], **options) if rows else None


def _judged(batch: pa.RecordBatch, net: Network | None) -> tuple[np.ndarray, np.ndarray]:
    """Name and score of the best language of every row; unknown and 0 without a letter."""
    letters = batch["has_letter__"].to_numpy(zero_copy_only=False)
    names, scores = np.full(batch.num_rows, UNKNOWN, object), np.zeros(batch.num_rows)
    if net is not None and batch.num_rows:
        found = pooled(net, *utf8(batch["text"]))
        best = found.argmax(axis=1)
        names = np.where(letters, np.array(net.labels, object)[best], UNKNOWN)
        scores = np.where(letters, np.clip(found[np.arange(len(best)), best], 0, 1).round(6), 0.0)
    return names, scores


def _lettered(docs: DataFrame) -> DataFrame:
    prepared(docs.sparkSession)
    return docs.withColumn("has_letter__", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))


def identify(docs: DataFrame, net: Network | None, label: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with a predicted language and the pooled probability of it, in one pass."""
    schema = T.StructType([*docs.schema.fields, T.StructField(label, T.StringType()), T.StructField(score, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = _judged(batch, net)
            rest = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.record_batch([*rest, pa.array(names, pa.string()), pa.array(scores)], [*batch.schema.names[:-1], label, score])

    return _lettered(docs).mapInArrow(run, schema)


def recognised(docs: DataFrame, net: Network | None, least: float) -> DataFrame:
    """The rows of ``docs`` with a language of at least ``least`` probability; the others do
    not leave the worker."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = _judged(batch, net)
            keep = pa.array((names != UNKNOWN) & (scores >= least))
            yield batch.filter(keep).select(range(batch.num_columns - 1))

    return _lettered(docs).mapInArrow(run, docs.schema)
