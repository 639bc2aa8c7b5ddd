"""SimHash fingerprints, and near-duplicate groups by covering locality-sensitive hashing.

Null and empty texts, and texts of white space only, have fingerprint zero and link like
any other. Repeated rows are copies of one another. A null ``doc_id`` takes part, but is
never a component's id; a component of such rows alone has a null id. An empty table
gives an empty result. Other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.llm.common import prepared
from tidemark.llm.components import components
from tidemark.session import stored

BITS = 64
SEED = 42
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_BLOCK = 1 << 16


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Majority of the bits of the XXH64 values of all word shingles, repeats included."""
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    size = min(shingle, len(words))
    begin, end = starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist()
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(begin), _BLOCK):  # bounds the bit matrix of a very long text
        hashes = [xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in zip(begin[at : at + _BLOCK], end[at : at + _BLOCK])]
        octets = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(begin), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp) of every row; fp holds the 64 bits as a signed long."""
    return _printed(docs.select(F.col("doc_id").cast("long"), "text"), shingle)


def _printed(rows: DataFrame, shingle: int) -> DataFrame:
    """``rows`` with ``fp`` in place of ``text``, their last column."""
    prepared(rows.sparkSession)
    kept = rows.drop("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t.as_py(), shingle) for t in batch["text"]), np.uint64, batch.num_rows)
            yield pa.record_batch([*batch.columns[:-1], pa.array(found.view(np.int64))], [*batch.schema.names[:-1], "fp"])

    return rows.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField("fp", T.LongType())]))


def covering_masks(radius: int) -> list[int]:
    """Masks such that two values with at most ``radius`` differing bits agree under one.

    Bit i gets a non-zero vector of radius + 1 bits; mask v keeps the bits whose vector
    has odd parity with v. The vectors of ``radius`` differing bits span less than the
    whole space, so some v is orthogonal to all of them and its mask hides them all.
    """
    vectors = 2 ** (radius + 1) - 1
    owner = [1 + i % vectors for i in range(BITS)]
    return [sum(1 << i for i in range(BITS) if (owner[i] & v).bit_count() % 2) for v in range(1, vectors + 1)]


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def links(distinct: DataFrame, radius: int) -> DataFrame:
    """Pairs (a, b) of different fingerprints that connect all pairs within ``radius``.

    ``distinct`` has the column fp without repeats. Every fingerprint enters one bucket
    per covering mask; buckets of one are left. In a bucket two members differ only in
    hidden bits, and they are within the radius when flipping a few of these bits on
    either side, half of the radius each, meets in one value. So members are sent to
    these values instead of to each other: the work is linear in a bucket of any size,
    and a value has at most a Hamming ball of senders. All senders at a value are within
    the radius of its smallest one, which they are linked to. Every link is a true one;
    pairs within the radius that are not listed are connected through such a value.
    """
    if not 0 <= radius <= 4:
        raise ValueError("radius must be between 0 and 4")
    masks = covering_masks(radius)
    keys = F.explode(F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for t, m in enumerate(masks)]))
    keyed = distinct.select("fp", keys.alias("k")).select("fp", "k.t", "k.key")
    shared = keyed.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    members = keyed.join(shared, ["t", "key"])

    near, far = radius // 2, radius - radius // 2
    sent = members.select("fp", F.explode(_flips(masks, near, far)).alias("f")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("f.bits")).alias("meet"), F.col("f.far").alias("far")
    )
    balls = sent.groupBy("meet").agg(
        F.collect_set(F.when(~F.col("far"), F.col("fp"))).alias("near"), F.collect_set("fp").alias("all")
    )
    pairs = balls.where((F.size("near") > 0) & (F.size("all") > 1)).select(
        F.array_min("near").alias("a"), F.explode("all").alias("b")
    )
    return pairs.where("a != b").distinct()


def _flips(masks: list[int], near: int, far: int) -> Column:
    """Per mask the sets of hidden bits to flip; ``far`` marks those above half the radius."""
    options = F.lit(None)
    for t, mask in enumerate(masks):
        hidden = [1 << i for i in range(BITS) if not mask >> i & 1]
        sets = chain.from_iterable(combinations(hidden, k) for k in range(far + 1))
        flips = F.array(*[F.struct(F.lit(_signed(sum(s))).alias("bits"), F.lit(len(s) > near).alias("far")) for s in sets])
        options = F.when(F.col("t") == t, flips).otherwise(options)
    return options


def _roots(rows: DataFrame, radius: int) -> DataFrame:
    """(fp, root): the component of every fingerprint of ``rows``.

    Copies meet in one fingerprint before any pair is looked for, so a group of copies of
    any size is one node.
    """
    nodes = rows.select("fp").distinct()
    found = components(links(nodes, radius)).withColumnRenamed("node", "fp")
    return nodes.join(found, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """(doc_id, fp, component_id) of every row of ``docs``; component_id is the smallest
    doc_id reachable over links."""
    rows = stored(fingerprints(docs, shingle), "fingerprints")
    nodes = rows.groupBy("fp").agg(F.min("doc_id").alias("first"))
    grouped = nodes.join(_roots(rows, radius), "fp")
    least = grouped.groupBy("root").agg(F.min("first").alias("component_id"))
    label = grouped.join(least, "root").select("fp", "component_id")
    return rows.join(label, "fp").select("doc_id", "fp", "component_id")


def one_of_each_group(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """One row of ``docs`` for each component of near copies, whatever the layout.

    That of the smallest doc_id stays; a row without an id only if its component has none
    with one. Different texts of one id are rows of their own, of which the one with the smaller
    digest goes first, and so are texts without an id. Of rows with equal id and text the
    first in order of all columns stays. Null and empty texts are copies of each other.
    """
    keyed = docs.withColumns({"id__": F.col("doc_id").cast("long"), "digest__": F.md5(F.coalesce("text", F.lit("")))})
    rows = stored(_printed(keyed.select("id__", "digest__", "text"), shingle), "fingerprints")
    place = F.struct(F.col("id__").isNull().alias("bare"), F.col("id__"), F.col("digest__"))
    first = rows.join(_roots(rows, radius), "fp").groupBy("root").agg(F.min(place).alias("first")).select("first.*")
    named = keyed.where("id__ is not null").join(first.where("not bare").select("id__", "digest__"), ["id__", "digest__"], "left_semi")
    bare = keyed.where("id__ is null").join(first.where("bare").select("digest__"), "digest__", "left_semi").select(*keyed.columns)
    kept = named.select(*keyed.columns).unionByName(bare)
    return kept.groupBy("id__", "digest__").agg(F.min(F.struct(*docs.columns)).alias("row")).select("row.*")
