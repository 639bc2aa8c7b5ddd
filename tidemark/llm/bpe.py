"""Byte-level BPE encoding and decoding through a global shuffle of distinct words.

Texts are cut into pre-tokens. A bundle is a run of texts of one input partition; it names
each distinct word it holds by a local number and keeps its texts as numbers in order of
position. The words of all bundles are dealt out by word, so every distinct word is
encoded in one place, and the ids travel back to the bundles, where texts are put together
by position. Words therefore move once a bundle, not once an occurrence, and packed. Decoding
joins the ids with the table of token bytes.

A null text is the empty text and has no ids. A text larger than a bundle is a bundle of
its own. Repeated rows and rows with a null id are encoded like any other. Rows of an
empty table give no rows. Other columns are not read.
"""

from __future__ import annotations

import base64
import heapq
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.llm.common import packed, prepared, spread, unpacked, utf8

# Bytes of text after which a bundle is closed. Its words and numbers are in memory at once.
BUNDLE_BYTES = 4 << 20
_LONG = 64


def read_ranks(spark: SparkSession, path: str) -> dict[bytes, int]:
    """Token bytes to id from a rank file, one base64 token and its rank a line."""
    if "://" in path:
        lines = [row.value for row in spark.read.text(path).collect()]  # a vocabulary, of fixed size
    else:
        with open(path) as file:
            lines = file.read().splitlines()
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line)}


def encode_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: the neighbours of least rank merge first, the leftmost of equals."""
    if word in ranks:
        return [ranks[word]]
    if len(word) > _LONG:
        return _encode_long(word, ranks)
    parts = [word[i : i + 1] for i in range(len(word))]
    none = len(ranks) + 256
    pairs = [ranks.get(a + b, none) for a, b in zip(parts, parts[1:])]
    while pairs:
        least = min(pairs)
        if least == none:
            break
        i = pairs.index(least)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i:
            pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], none)
        if i < len(pairs):
            pairs[i] = ranks.get(parts[i] + parts[i + 1], none)
    return [ranks[p] for p in parts]


def _encode_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same with a heap of candidate merges, for words of any length."""
    size = len(word)
    end = list(range(1, size + 1))  # of the part that starts here; 0 once it is merged away
    before = list(range(-1, size - 1))
    heap: list[tuple[int, int, int]] = []

    def offer(start: int) -> None:
        middle = end[start]
        if middle < size and (rank := ranks.get(word[start : end[middle]])) is not None:
            heapq.heappush(heap, (rank, start, end[middle]))

    for start in range(size - 1):
        offer(start)
    while heap:
        _, start, stop = heapq.heappop(heap)
        middle = end[start]
        if not middle or middle >= size or end[middle] != stop or middle == stop:
            continue  # a part of it has changed since
        end[start], end[middle] = stop, 0
        if stop < size:
            before[stop] = start
        offer(start)
        if before[start] >= 0:
            offer(before[start])
    ids, start = [], 0
    while start < size:
        ids.append(ranks[word[start : end[start]]])
        start = end[start]
    return ids


# A text that holds any of these is matched as a whole: white space other than blank and
# line end, and the mark that pieces are cut at.
_RARE = frozenset(chr(c) for c in range(0x110000) if chr(c).isspace() and chr(c) not in " \n") | {"\0"}
_LEADS = np.zeros(256, bool)  # bytes with which their UTF-8 forms begin
_LEADS[sorted({c.encode()[0] for c in _RARE})] = True


class Words:
    """Pre-tokens of the texts of a bundle: the distinct ones, and each text as their numbers.

    Under the patterns meant here a match may take one blank before it and otherwise never
    crosses from white space into text. So a text whose blanks all stand alone between
    other characters can be cut before each of them, and only distinct pieces are matched.
    A run of letters, with one blank before it or none, is one match. Any other text is
    one piece.
    """

    def __init__(self, texts: pa.Array, pattern: str):
        texts = texts.cast(pa.large_string()).fill_null("")
        data, offsets = utf8(texts)
        whole = np.zeros(len(texts), bool)
        whole[np.searchsorted(offsets, np.flatnonzero(_LEADS[data]), side="right") - 1] = True
        for loose in ("  ", " \n", "\n "):
            whole |= pc.match_substring(texts, loose).to_numpy(zero_copy_only=False)
        whole |= pc.starts_with(texts, " ").to_numpy(zero_copy_only=False) | pc.ends_with(texts, " ").to_numpy(zero_copy_only=False)
        cut = pc.split_pattern(pc.replace_substring(texts.filter(pa.array(~whole)), " ", "\0 "), "\0")
        pieces = pa.chunked_array([cut.flatten(), texts.filter(pa.array(whole))]).combine_chunks().dictionary_encode()
        codes = pieces.indices.to_numpy()
        sizes = np.ones(len(texts), np.int64)
        sizes[~whole] = pc.list_value_length(cut).to_numpy()

        find, numbers, made, counts = regex.compile(pattern).findall, {}, array("i"), array("i")
        for piece in pieces.dictionary.to_numpy(zero_copy_only=False):
            if piece[1:].isalpha() and (piece[0] == " " or piece[0].isalpha()):
                counts.append(1)
                made.append(numbers.setdefault(piece, len(numbers)))
                continue
            found = find(piece)
            counts.append(len(found))
            made.extend([numbers.setdefault(word, len(numbers)) for word in found])
        self.words = list(numbers)
        counts, flat = np.array(counts, np.int64), np.array(made, np.int32)
        order = np.concatenate([np.flatnonzero(~whole), np.flatnonzero(whole)])
        first = np.zeros(len(texts), np.int64)
        first[order] = np.cumsum(sizes[order]) - sizes[order]
        codes = codes[spread(first, sizes)]  # pieces of all texts in order
        del pieces, cut, data, made
        self.numbers = flat[spread((np.cumsum(counts) - counts)[codes], counts[codes])]
        self.ends = np.concatenate([[0], np.cumsum(counts[codes])])[np.cumsum(sizes)]

    def packed(self, first: int, stop: int) -> list[bytes]:
        """Texts ``first`` to ``stop`` as packed numbers."""
        edges = [0, *self.ends.tolist()][first : stop + 1]
        return [packed(self.numbers[a:b]) for a, b in zip(edges, edges[1:])]


_BUNDLED = "bundle long, seal long, doc_id long, part int, packed binary, sizes binary, words binary"


def _bundles(pattern: str, limit: int, parts: int, kind: str):
    """Rows of a ``kind``: "texts" as packed numbers of words, or "words" of one hash part.

    Words are dealt into parts by their checksum; a row has the words that a bundle holds
    of a part: their numbers, lengths and bytes. ``seal`` is a checksum of all words of a
    bundle in order. Texts and words are read in two passes over the input; should its
    partitions differ between them, seals do too, and the texts then lack their words,
    which is an error and never a wrong id.
    """

    def row_batch(n: int, bundle: tuple[int, int], **columns: pa.Array) -> pa.RecordBatch:
        types = {"doc_id": pa.int64(), "part": pa.int32(), "packed": pa.binary(), "sizes": pa.binary(), "words": pa.binary()}
        keys = [pa.array(np.full(n, k, np.int64)) for k in bundle]
        rest = [columns.get(c, pa.nulls(n, kind)) for c, kind in types.items()]
        return pa.record_batch([*keys, *rest], ["bundle", "seal", *types])

    def closed(number: int, held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = pa.chunked_array([b["doc_id"] for b in held]).combine_chunks().cast(pa.int64())
        found = Words(pa.chunked_array([b["text"] for b in held]).combine_chunks(), pattern)
        words = [w.encode() for w in found.words]
        bundle = (number, zlib.crc32(b"\n".join(words)))
        if kind == "texts":
            for at in range(0, len(ids), 1000):
                part = ids.slice(at, 1000)
                yield row_batch(len(part), bundle, doc_id=part, packed=pa.array(found.packed(at, at + 1000), pa.binary()))
            return
        deal = np.array([zlib.crc32(w) % parts for w in words], np.int64)
        order = np.argsort(deal, kind="stable")
        rows = np.split(order, np.flatnonzero(np.diff(deal[order])) + 1) if len(words) else []
        for at in range(0, len(rows), 1000):
            some = rows[at : at + 1000]
            chosen = [[words[i] for i in r.tolist()] for r in some]
            yield row_batch(
                len(some),
                bundle,
                part=pa.array([int(deal[r[0]]) for r in some], pa.int32()),
                packed=pa.array([packed(r) for r in some], pa.binary()),
                sizes=pa.array([packed(np.array([len(w) for w in c])) for c in chosen], pa.binary()),
                words=pa.array([zstandard.compress(b"".join(c), 1) for c in chosen], pa.binary()),
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, size, held = TaskContext.get().partitionId() << 24, 0, []
        for batch in batches:
            for at in range(0, batch.num_rows, 100):
                part = batch.slice(at, 100)
                held.append(part)
                size += int(utf8(part["text"])[1][-1])
                if size >= limit:
                    yield from closed(number, held)
                    number, size, held = number + 1, 0, []
        if held:
            yield from closed(number, held)

    return run


def _encoded(ranks):
    """Ids of the words of a part; a word that several bundles hold is encoded once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ranks.value
        known: dict[bytes, bytes] = {}
        for batch in batches:
            counts, ids = [], []
            for sizes, words in zip(batch["sizes"], batch["words"]):
                ends = np.cumsum(unpacked(sizes.as_py())).tolist()
                content, made = zstandard.decompress(words.as_py()), []
                for a, b in zip([0, *ends], ends):
                    word = content[a:b]
                    found = known.get(word)
                    if found is None:
                        found = known[word] = np.array(encode_word(word, table), "<i4").tobytes()
                    made.append(found)
                counts.append(packed(np.array([len(m) // 4 for m in made])))
                ids.append(packed(np.frombuffer(b"".join(made), "<i4")))
                if len(known) > 200_000:  # bounds memory; a word may then be encoded again
                    known.clear()
            columns = [batch["bundle"], batch["seal"], batch["packed"], pa.array(counts, pa.binary()), pa.array(ids, pa.binary())]
            yield pa.record_batch(columns, ["bundle", "seal", "numbers", "counts", "ids"])

    return run


def _reassembled(texts: pa.Table, words: pa.Table) -> pa.Table:
    """Texts of one bundle with their ids, in order of position."""

    def whole(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
        parts = [unpacked(x.as_py()) for x in column]
        return np.concatenate([np.empty(0, np.int32), *parts]), np.array([0, *map(len, parts)])

    (numbers, _), (counts, _), (ids, _) = (whole(words[c]) for c in ("numbers", "counts", "ids"))
    starts, sizes = np.zeros(len(numbers), np.int64), np.zeros(len(numbers), np.int64)
    starts[numbers], sizes[numbers] = np.cumsum(counts, dtype=np.int64) - counts, counts
    held, edges = whole(texts["packed"])
    if len(held) and (held.max() >= len(sizes) or not sizes[held].all()):
        raise RuntimeError("words of a bundle are missing: the input's rows came in other partitions when read again")
    ends = np.append(0, np.cumsum(sizes[held]))[np.cumsum(edges)]
    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids[spread(starts[held], sizes[held])], pa.int32()))
    return pa.table({"doc_id": texts["doc_id"], "ids": lists})


def encode(docs: DataFrame, path: str, pattern: str, bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """(doc_id, ids) of every row of ``docs``; ids is an array, empty for an empty text.

    ``path`` names the rank file. ``docs`` must give the same rows in the same partitions
    when read twice, as files do; otherwise the job fails.
    """
    spark = prepared(docs.sparkSession)
    ranks = spark.sparkContext.broadcast(read_ranks(spark, path))  # the vocabulary has a fixed size
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))  # several to a partition even out its load
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    words = rows.mapInArrow(_bundles(pattern, bundle_bytes, parts, "words"), _BUNDLED).select("bundle", "seal", "part", "packed", "sizes", "words")
    encoded = words.repartition("part").mapInArrow(_encoded(ranks), "bundle long, seal long, numbers binary, counts binary, ids binary")
    texts = rows.mapInArrow(_bundles(pattern, bundle_bytes, parts, "texts"), _BUNDLED).select("bundle", "seal", "doc_id", "packed")
    return texts.groupBy("bundle", "seal").cogroup(encoded.groupBy("bundle", "seal")).applyInArrow(_reassembled, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str, column: str = "ids") -> DataFrame:
    """``encoded`` with the column decoded: the bytes of its ids, joined with the token table.

    Null ids give null bytes. An id that is not in the table is an error.
    """
    spark = prepared(encoded.sparkSession)
    tokens = {i: token for token, i in read_ranks(spark, path).items()}
    sizes = np.zeros(max(tokens) + 1, np.int64)
    sizes[list(tokens)] = [len(t) for t in tokens.values()]
    shared = spark.sparkContext.broadcast((b"".join(tokens[i] for i in sorted(tokens)), sizes))
    schema = T.StructType([*encoded.schema.fields, T.StructField("decoded", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        content, sizes = np.frombuffer(shared.value[0], np.uint8), shared.value[1]
        starts = np.cumsum(sizes) - sizes
        for batch in batches:
            lists = batch[column]
            ids = lists.flatten()
            if ids.null_count:
                raise ValueError("a list of ids holds a null")
            ids = ids.to_numpy()
            if len(ids) and (ids.min() < 0 or ids.max() >= len(sizes) or not sizes[ids].all()):
                raise ValueError("an id is not in the token table")
            counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
            ends = np.append(0, np.cumsum(sizes[ids]))[np.append(0, np.cumsum(counts))]
            data = content[spread(starts[ids], sizes[ids])].tobytes()
            known = lists.is_valid().to_pylist()
            made = pa.array([data[a:b] if k else None for a, b, k in zip(ends.tolist(), ends[1:].tolist(), known)], pa.binary())
            yield pa.record_batch([*batch.columns, made], [*batch.schema.names, "decoded"])

    return encoded.mapInArrow(run, schema)
