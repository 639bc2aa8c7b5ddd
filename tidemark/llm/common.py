"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

import tidemark.llm
from tidemark.session import checkpoint_dir, configure
from tidemark.sources import tables

# Functions that run on executors travel whole, so these need no copy of the package.
cloudpickle.register_pickle_by_value(tidemark.llm)

# Rows of one Arrow batch. Texts differ in length by four orders of magnitude, so a batch
# is kept short: ten thousand long texts at once would not fit a worker.
BATCH_ROWS = 1000


def prepared(spark: SparkSession) -> SparkSession:
    """The session with the settings these operators rely on."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    # Steps hand on written tables, so the shuffle files of a step can go when it ends.
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    return spark


def forget(*tables: DataFrame) -> None:
    """Delete the work tables that ``tables`` read, once what needs them has been written."""
    for frame in tables:
        spark = frame.sparkSession
        shared = checkpoint_dir(spark).removeprefix("file://").rstrip("/") + "/"
        for folder in {path.rpartition("/")[0] for path in frame.inputFiles()}:
            if shared in folder:
                place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
                place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tables.table(prepared(spark), sf_dir, name)


def held_out(doc_id: Column) -> Column:
    """True for the fifth of documents, by crc32 of the id, that no model learns from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null text has no bytes."""
    binary = column.cast(pa.large_binary())
    if binary.null_count:
        binary = binary.fill_null(b"")
    offsets = np.frombuffer(binary.buffers()[1], np.int64, len(binary) + 1, binary.offset * 8)
    data = binary.buffers()[2]
    if data is None or not len(binary):
        return np.empty(0, np.uint8), np.zeros(len(binary) + 1, np.int64)
    whole = np.frombuffer(data, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Places start, start + 1, ... of each run, one run after the other."""
    first = np.cumsum(counts) - counts
    return np.arange(int(counts.sum())) + np.repeat(starts - first, counts)


def packed(values: np.ndarray, kind: str = "<i4") -> bytes:
    """Numbers as planes of bytes, compressed: high planes are mostly zero."""
    planes = np.ascontiguousarray(values, kind).view(np.uint8).reshape(-1, np.dtype(kind).itemsize).T
    return zstandard.compress(planes.tobytes(), 1)


def unpacked(data: bytes, kind: str = "<i4") -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


_LOW_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_TURN = np.uint64(0x9E3779B97F4A7C15)
_BLOCK = 1 << 16  # words hashed at once


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def word_hashes(data: np.ndarray, offsets: np.ndarray, fold: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of all texts, and the place of each text's first word, the end appended.

    ``fold`` maps bytes before hashing and ``inside`` says by byte whether it is part of a
    word. A word ends with its text. Hashes take eight bytes at a time; few words need a
    second turn.
    """
    folded, within = fold[data], inside[data]
    opens, closes = within.copy(), within.copy()
    opens[1:] &= ~within[:-1]
    closes[:-1] &= ~within[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    opens[cuts] = within[cuts]
    closes[cuts - 1] = within[cuts - 1]
    starts = np.flatnonzero(opens)
    left = np.flatnonzero(closes) + 1 - starts
    del opens, closes, within
    text = np.concatenate([folded, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(folded) + 1,), "<u8", text, strides=(1,))
    out = left.astype(np.uint64)
    for block in range(0, len(starts), _BLOCK):
        some = np.arange(block, min(block + _BLOCK, len(starts)))
        at, size = starts[some], left[some]
        while len(some):
            out[some] = mixed(out[some] * _TURN + (eight[at] & _LOW_BYTES[np.minimum(size, 8)]))
            more = size > 8
            some, at, size = some[more], at[more] + 8, size[more] - 8
    return out, np.searchsorted(starts, offsets)


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each word on, wherever texts end."""
    count = max(0, len(words) - size + 1)
    out = np.zeros(count, np.uint64)
    for k in range(size):
        out *= _TURN
        out += words[k : k + count]
    return mixed(out)
