"""Fill-in-middle transformation with a sparse index of the characters of several bytes.

A text is cut into prefix, middle and suffix at units drawn from its id, and put together
anew behind marks. Cuts are made in bytes. The index holds only the characters of several
bytes, where they begin and how many bytes too many they have up to there; one binary search
turns a cut in code points into one in bytes or back, and between two such characters the
conversion is a subtraction.

Null and empty texts, and texts that hold a mark, stay as they are (``plain``; null gives the
empty text). A row without an id draws as an empty id does; repeated rows are made alike; a
text of any length is cut whole; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import prepared, utf8

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
UNITS = ("words", "chars")
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True


class Exceptions:
    """The characters of several bytes in UTF-8 ``data``; all others are one byte long."""

    def __init__(self, data: np.ndarray):
        self.at = np.flatnonzero(data >= 0xC0)  # the byte at which each begins
        lead = data[self.at]
        self.excess = np.append(0, np.cumsum(1 + (lead >= 0xE0) + (lead >= 0xF0), dtype=np.int64))
        self.points = self.at - self.excess[:-1]  # the code point that each is

    def to_points(self, cuts: np.ndarray) -> np.ndarray:
        """Code points before cuts given in bytes, none inside a character."""
        return cuts - self.excess[np.searchsorted(self.at, cuts)]

    def to_bytes(self, cuts: np.ndarray) -> np.ndarray:
        """Bytes before cuts given in code points."""
        return cuts + self.excess[np.searchsorted(self.points, cuts)]


class Words:
    """Units that are a word with the white space before it, or white space at the end of a text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, index: Exceptions):
        white = _WHITE[data]
        closes = ~white
        closes[:-1] &= white[1:]
        closes[offsets[1:][np.diff(offsets) > 0] - 1] = True
        self.starts, self.ends = offsets[:-1], np.flatnonzero(closes) + 1
        self.before = np.searchsorted(self.ends, offsets, side="right")
        self.counts = np.diff(self.before)

    def bytes(self, units: np.ndarray) -> np.ndarray:
        """The byte at which so many units of each text end."""
        if not len(self.ends):
            return self.starts
        return np.where(units > 0, self.ends[np.maximum(self.before[:-1] + units - 1, 0)], self.starts)


class Chars:
    """Units that are single code points."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, index: Exceptions):
        self.index = index
        points = index.to_points(offsets)
        self.starts, self.counts = points[:-1], np.diff(points)

    def bytes(self, units: np.ndarray) -> np.ndarray:
        return self.index.to_bytes(self.starts + units)


_KINDS = {"words": Words, "chars": Chars}


def draws(doc_id: Column, seed: int) -> list[Column]:
    """Four numbers below 2^32 for each id: the first groups of a digest of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]


def transform(docs: DataFrame, seed: int = 42, rate: int = 50, suffix_first: int = 80, unit: str = "words") -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every row of ``docs``.

    ``rate`` percent of the texts are transformed, and ``suffix_first`` percent of these put the
    suffix in front (``spm``), the others the prefix (``psm``). ``n`` counts the units.
    """
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {UNITS}")
    prepared(docs.sparkSession)

    def made(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = utf8(batch["text"])
        h1, h2, h3, h4 = (batch[f"h{k}"].to_numpy() for k in (1, 2, 3, 4))
        index = Exceptions(data)
        units = _KINDS[unit](data, offsets, index)
        n = units.counts
        a, b = h1 % (n + 1), h2 % (n + 1)
        low, high = units.bytes(np.minimum(a, b)), units.bytes(np.maximum(a, b))
        plain = (n == 0) | (h3 % 100 >= rate)
        for mark in (PREFIX, SUFFIX, MIDDLE):
            plain |= pc.fill_null(pc.match_substring(batch["text"], mark), False).to_numpy(zero_copy_only=False)
        form = np.where(plain, "plain", np.where(h4 % 100 < suffix_first, "spm", "psm"))
        whole, output = data.tobytes(), []
        for kind, start, one, two, stop in zip(form, offsets[:-1].tolist(), low.tolist(), high.tolist(), offsets[1:].tolist()):
            prefix, middle, suffix = whole[start:one], whole[one:two], whole[two:stop]
            if kind == "plain":
                output.append(whole[start:stop])
            elif kind == "psm":
                output.append(b"".join((PREFIX.encode(), prefix, SUFFIX.encode(), suffix, MIDDLE.encode(), middle)))
            else:
                output.append(b"".join((SUFFIX.encode(), suffix, PREFIX.encode(), prefix, MIDDLE.encode(), middle)))
        points = [index.to_points(cut) for cut in (offsets[:-1], low, high)]
        spans = [pa.array(y - x, pa.int64(), mask=plain) for x, y in zip(points, points[1:])]
        columns = [batch["doc_id"], pa.array(n, pa.int64()), pa.array(form.tolist(), pa.string()), *spans, pa.array(output, pa.string())]
        return pa.record_batch(columns, ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from map(made, batches)

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), *draws(F.col("doc_id"), seed))
    return rows.mapInArrow(run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made of. No part holds a mark, so each mark stands once."""
    middle = F.substring_index(output, MIDDLE, -1)
    front = F.substring_index(output, MIDDLE, 1)
    after_first = lambda second: F.substr(F.substring_index(front, second, 1), F.lit(len(PREFIX) + 1))
    psm = F.concat(after_first(SUFFIX), middle, F.substring_index(front, SUFFIX, -1))
    spm = F.concat(F.substring_index(front, PREFIX, -1), middle, after_first(PREFIX))
    return F.when(form == "plain", output).when(form == "psm", psm).when(form == "spm", spm)
