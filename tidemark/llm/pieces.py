"""SentencePiece BPE encoding and decoding in vectorised merge rounds.

White space is the symbol ``▁`` and every non-empty text has one in front. Where no piece of
the vocabulary holds two neighbouring characters next to each other, no merge can ever
cross; a text is cut there into words, and a distinct word of a block of texts is encoded
once. All of them merge together: in a round every word merges each place of its least
pair rank, leftmost first, in flat arrays that are compacted until no pair is left.

Sequential merging could pick a pair that a merge of the same round has just made. Such a
word, seen by the ranks of the pairs that a round makes, is finished one merge at a time,
and so are words of thousands of symbols. Ids therefore equal those of one merge at a time.

Null and empty texts have no ids beside begin and end; a text of any length, repeated rows
and rows with a null id are encoded like any other; an empty table gives no rows. Other
columns are not read. A literal ``▁`` counts as white space and decodes to a blank.
"""

from __future__ import annotations

import codecs
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.llm.common import prepared, spread, utf8

SPACE = "▁"
# Bytes of text that are encoded at once; a longer text is a block of its own.
BLOCK_BYTES = 1 << 20
# Words of more symbols merge one pair at a time, which costs less than a round per rank.
LONG_WORD = 4096
_NONE = np.int32(2**31 - 1)
_CHARS = 0x110000
# Kinds of pieces, fixed values of the model file.
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6
_BPE = 2


def _slots(keys: np.ndarray, size: int) -> np.ndarray:
    """First slot of each key in a hash table; ``size`` is a power of two."""
    return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(65 - size.bit_length())).astype(np.int64)


def _hash_table(entries: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Keys and values in slots, a quarter of them filled at most; free ones have the key -1."""
    size = 1 << max(4, (4 * len(entries)).bit_length())
    keys, values = np.full(size, -1, np.int64), np.zeros(size, np.int32)
    names = np.array(list(entries), np.int64)
    for slot, (key, value) in zip(_slots(names, size).tolist(), entries.items()):
        while keys[slot] >= 0:
            slot = (slot + 1) % size
        keys[slot], values[slot] = key, value
    return keys, values


class Vocabulary:
    """Pieces of a model as arrays; symbols are piece ids, or ``size`` + code point for
    characters that are no piece."""

    def __init__(self, pieces: list[str], scores: list[float], kinds: list[int], begin: int, end: int, unknown: str):
        self.begin, self.end, self.size = begin, end, len(pieces)
        ids = {p: i for i, (p, kind) in enumerate(zip(pieces, kinds)) if kind == _NORMAL}
        levels = sorted({s for s, kind in zip(scores, kinds) if kind == _NORMAL}, reverse=True)
        level = {s: r for r, s in enumerate(levels)}
        self.rank = np.array([level.get(s, 0) for s in scores], np.int32)
        self.char_pieces = [(ord(p), i) for p, i in ids.items() if len(p) == 1]

        def symbol(part: str) -> int | None:
            return ids.get(part, self.size + ord(part) if len(part) == 1 else None)

        pairs, touching = {}, set()
        for piece, number in ids.items():
            touching.update(zip(piece, piece[1:]))
            for cut in range(1, len(piece)):
                left, right = symbol(piece[:cut]), symbol(piece[cut:])
                if left is not None and right is not None:
                    pairs[self._key(left, right)] = number
        self.pair_keys, self.pair_pieces = _hash_table(pairs)
        self.touching = np.array(sorted(ord(a) * _CHARS + ord(b) for a, b in touching), np.int64)
        # Only a blank that never follows another character inside a piece may cut words.
        self.cuts_at_spaces = all(b != SPACE or a == SPACE for a, b in touching)

        self.bytes = np.zeros(256, np.int32)
        surfaces = []
        for number, (piece, kind) in enumerate(zip(pieces, kinds)):
            if kind == _BYTE:
                self.bytes[int(piece[3:5], 16)] = number
                surfaces.append(bytes([int(piece[3:5], 16)]))
            elif kind == _CONTROL:
                surfaces.append(b"")
            else:
                surfaces.append((unknown if kind == _UNKNOWN else piece.replace(SPACE, " ")).encode())
        self.surface = np.frombuffer(b"".join(surfaces), np.uint8)
        self.surface_sizes = np.array([len(s) for s in surfaces], np.int64)
        self.surface_starts = np.cumsum(self.surface_sizes) - self.surface_sizes
        self.control = np.array([kind == _CONTROL for kind in kinds])
        self.is_byte = np.array([kind == _BYTE for kind in kinds])
        self.leads = np.array([kind == _NORMAL and piece.startswith(SPACE) for piece, kind in zip(pieces, kinds)])

    def _key(self, left, right):
        return left * (self.size + _CHARS) + right

    def symbols(self, points: np.ndarray) -> np.ndarray:
        """Symbols of code points."""
        if not hasattr(self, "_of_char"):
            table = np.arange(self.size, self.size + _CHARS, dtype=np.int32)
            for char, number in self.char_pieces:
                table[char] = number
            self._of_char = table
        return self._of_char[points]

    def merged(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece that each pair merges to, and its rank; no rank where there is no such piece."""
        keys = self._key(left.astype(np.int64), right)
        at = _slots(keys, len(self.pair_keys))
        there = self.pair_keys[at]
        open_ = np.flatnonzero((there != keys) & (there >= 0))
        while len(open_):  # another key is in this slot, so look into the next one
            at[open_] = (at[open_] + 1) % len(self.pair_keys)
            there[open_] = self.pair_keys[at[open_]]
            open_ = open_[(there[open_] != keys[open_]) & (there[open_] >= 0)]
        piece = self.pair_pieces[at]
        return piece, np.where(there == keys, self.rank[piece], _NONE)

    def joined(self, points: np.ndarray) -> np.ndarray:
        """For each code point but the last, whether some piece holds it and the next one together."""
        keys = points[:-1].astype(np.int64) * _CHARS + points[1:]
        if not len(self.touching):
            return np.zeros(len(keys), bool)
        return self.touching[np.minimum(np.searchsorted(self.touching, keys), len(self.touching) - 1)] == keys


def read_model(spark: SparkSession, path: str) -> Vocabulary:
    """The vocabulary of a model file; a model that this module cannot follow is an error."""
    from sentencepiece import sentencepiece_model_pb2

    if "://" in path:
        content = bytes(spark.read.format("binaryFile").load(path).select("content").first().content)  # of fixed size
    else:
        with open(path, "rb") as file:
            content = file.read()
    model = sentencepiece_model_pb2.ModelProto()
    model.ParseFromString(content)
    trainer, normal = model.trainer_spec, model.normalizer_spec
    kinds = [p.type for p in model.pieces]
    plain = trainer.model_type == _BPE and trainer.byte_fallback and kinds.count(_BYTE) == 256 and not trainer.treat_whitespace_as_suffix
    plain = plain and not normal.precompiled_charsmap and normal.add_dummy_prefix and not normal.remove_extra_whitespaces
    if not plain or not set(kinds) <= {_NORMAL, _UNKNOWN, _CONTROL, _BYTE}:
        raise ValueError("only BPE models with byte fallback, plain normalisation and ordinary pieces are supported")
    begin, end = trainer.bos_id, trainer.eos_id
    return Vocabulary([p.piece for p in model.pieces], [p.score for p in model.pieces], kinds, begin, end, trainer.unk_surface)


def merge_rounds(symbols: np.ndarray, starts: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all words after merging, and for each the place of its first symbol.

    ``starts`` has the place at which each word begins; no word is empty.
    """
    place = np.arange(len(symbols), dtype=np.int32)
    word = np.zeros(len(symbols), np.int32)
    word[starts[1:]] = 1
    word = np.cumsum(word, dtype=np.int32)
    sizes = np.diff(np.append(starts, len(symbols)))
    done_symbols, done_places = [], []

    def one_by_one(mask: np.ndarray) -> None:
        """Finish the words of the marked symbols."""
        for part in np.split(np.flatnonzero(mask), np.flatnonzero(np.diff(word[mask])) + 1):
            if len(part):
                left, at = _sequential(symbols[part].tolist(), vocabulary)
                done_symbols.append(np.array(left, np.int32))
                done_places.append(place[part][at])

    late = sizes[word] > LONG_WORD
    if late.any():
        one_by_one(late)
        symbols, place, word = symbols[~late], place[~late], word[~late]
    piece, rank = _pairs(symbols, word, vocabulary)
    while len(symbols):
        first = np.flatnonzero(np.diff(word, prepend=-1))
        count = np.diff(np.append(first, len(word)))
        least = np.repeat(np.minimum.reduceat(rank, first), count)
        ended = least == _NONE
        if ended.any():
            done_symbols.append(symbols[ended])
            done_places.append(place[ended])
            symbols, place, word, piece, rank, least = (x[~ended] for x in (symbols, place, word, piece, rank, least))
            if not len(symbols):
                break
        hits = np.flatnonzero(rank == least)
        # Of hits that follow each other every second one, from the left.
        opens = np.diff(hits, prepend=-2) != 1
        offset = np.arange(len(hits)) - np.flatnonzero(opens)[np.cumsum(opens) - 1]
        hits = hits[offset % 2 == 0]

        bad = _overtaken(symbols, word, piece, least, hits, vocabulary)
        if len(bad):
            mask = np.isin(word, bad)
            one_by_one(mask)
            hits = hits[~mask[hits]]
            moved = np.cumsum(~mask) - 1
            hits = moved[hits]
            symbols, place, word, piece, rank = (x[~mask] for x in (symbols, place, word, piece, rank))
        symbols[hits] = piece[hits]
        keep = np.ones(len(symbols), bool)
        keep[hits + 1] = False
        now = (np.cumsum(keep) - 1)[hits]
        symbols, place, word, piece, rank = (x[keep] for x in (symbols, place, word, piece, rank))
        # Only pairs with a new symbol have changed.
        touched = np.zeros(len(symbols), bool)
        touched[now] = True
        touched[now[now > 0] - 1] = True
        touched = np.flatnonzero(touched)
        piece[touched], rank[touched] = _pairs(symbols, word, vocabulary, touched)
    if not done_symbols:
        return np.empty(0, np.int32), np.empty(0, np.int32)
    symbols, place = np.concatenate(done_symbols), np.concatenate(done_places)
    order = np.argsort(place, kind="stable")
    return symbols[order], place[order]


def _pairs(symbols, word, vocabulary, at=None) -> tuple[np.ndarray, np.ndarray]:
    """Piece and rank of the pair that begins at each place; none at the end of a word."""
    at = np.arange(len(symbols)) if at is None else at
    piece, rank = np.zeros(len(at), np.int32), np.full(len(at), _NONE)
    inner = np.flatnonzero(at < len(symbols) - 1)
    inner = inner[word[at[inner]] == word[at[inner] + 1]]
    piece[inner], rank[inner] = vocabulary.merged(symbols[at[inner]], symbols[at[inner] + 1])
    return piece, rank


def _overtaken(symbols, word, piece, least, hits, vocabulary) -> np.ndarray:
    """Words with several merges in which one makes a pair that goes before the others."""
    several = np.zeros(len(hits), bool)
    same = word[hits[1:]] == word[hits[:-1]]
    several[1:] |= same
    several[:-1] |= same
    hits = hits[several]
    if not len(hits):
        return hits
    changed = symbols.copy()
    changed[hits] = piece[hits]
    gone = np.zeros(len(symbols), bool)
    gone[hits + 1] = True
    found = []
    after = hits + 2
    inside = after < len(symbols)
    inside[inside] = word[after[inside]] == word[hits[inside]]
    after, at = after[inside], hits[inside]
    before = hits - 1
    before = np.where(gone[before], before - 1, before)  # its left neighbour has merged by then
    led = (hits > 0) & (before >= 0)
    led[led] = word[before[led]] == word[hits[led]]
    for left, right, owner in (
        (changed[at], symbols[after], at),  # the right neighbour has not merged yet
        (changed[at], changed[after], at),
        (changed[before[led]], changed[hits[led]], hits[led]),
    ):
        rank = vocabulary.merged(left, right)[1]
        found.append(word[owner[rank <= least[owner]]])
    return np.unique(np.concatenate(found))


def _sequential(symbols: list[int], vocabulary: Vocabulary) -> tuple[list[int], list[int]]:
    """One merge at a time, least rank and then leftmost: symbols left, and where each begins."""
    size = len(symbols)
    after, before = list(range(1, size + 1)), list(range(-1, size - 1))
    pieces, ranks = (x.tolist() for x in vocabulary.merged(np.array(symbols[:-1], np.int32), np.array(symbols[1:], np.int32)))
    agenda = [(rank, i, piece, symbols[i], symbols[i + 1]) for i, (piece, rank) in enumerate(zip(pieces, ranks)) if rank != _NONE]
    heapq.heapify(agenda)
    known: dict[tuple[int, int], tuple[int, int]] = {}

    def offer(i: int) -> None:
        j = after[i]
        if j >= size:
            return
        pair = symbols[i], symbols[j]
        if pair not in known:
            piece, rank = vocabulary.merged(np.array([pair[0]], np.int32), np.array([pair[1]], np.int32))
            known[pair] = int(piece[0]), int(rank[0])
        piece, rank = known[pair]
        if rank != _NONE:
            heapq.heappush(agenda, (rank, i, piece, *pair))

    while agenda:
        _, i, piece, left, right = heapq.heappop(agenda)
        j = after[i]
        if symbols[i] != left or j >= size or symbols[j] != right:
            continue  # one of the two has merged since
        symbols[i], symbols[j] = piece, -1
        after[i] = after[j]
        if after[i] < size:
            before[after[i]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    left = [i for i, s in enumerate(symbols) if s >= 0]
    return [symbols[i] for i in left], left


def _words(texts: pa.Array, vocabulary: Vocabulary) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words of the texts, each text as word numbers in one array, and words of each text."""
    kind = pa.large_string()
    texts = pc.replace_substring(texts.cast(kind).fill_null(""), SPACE, " ")
    texts = pc.if_else(pc.equal(pc.binary_length(texts), 0), texts, pc.binary_join_element_wise(pa.scalar(" ", kind), texts, pa.scalar("", kind)))
    data, offsets = utf8(texts)
    opens = np.zeros(len(data) + 1, bool)
    if vocabulary.cuts_at_spaces and len(data):
        blank = data == 0x20
        opens[0], opens[1:-1] = True, blank[1:] & ~blank[:-1]
    opens[offsets[:-1]] = True
    opens[-1] = False
    starts = np.flatnonzero(opens)
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(np.append(starts, len(data)).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
    )
    found = words.dictionary_encode()
    return found.dictionary, found.indices.to_numpy(), np.diff(np.searchsorted(starts, offsets))


def encode_texts(texts: pa.Array, vocabulary: Vocabulary) -> pa.ListArray:
    """Ids of each text, begin and end included."""
    words, numbers, sizes = _words(texts, vocabulary)
    joined, offsets = utf8(words)
    points = np.frombuffer(joined.tobytes().decode().replace(" ", SPACE).encode("utf-32-le"), "<u4")
    heads = np.flatnonzero((joined & 0xC0) != 0x80)  # the byte at which each character begins
    word_starts = np.searchsorted(heads, offsets[:-1])
    cut = np.zeros(len(points), bool)
    cut[1:] = ~vocabulary.joined(points)
    cut[word_starts] = True
    symbols, place = merge_rounds(vocabulary.symbols(points).copy(), np.flatnonzero(cut), vocabulary)

    # Characters that are no piece become their bytes.
    lone = symbols >= vocabulary.size
    counts = np.ones(len(symbols), np.int64)
    if lone.any():
        lengths = np.diff(np.append(heads, len(joined)))[place]
        counts[lone] = lengths[lone]
        ids = np.repeat(symbols, counts)
        ids[np.repeat(lone, counts)] = vocabulary.bytes[joined[spread(heads[place[lone]], counts[lone])]]
    else:
        ids = symbols
    edges = np.append(0, np.cumsum(counts))[np.searchsorted(place, np.append(word_starts, len(points)))]
    word_sizes = np.diff(edges)

    lengths = np.add.reduceat(np.append(word_sizes[numbers], 0), np.append(0, np.cumsum(sizes))[:-1]) if len(sizes) else sizes
    lengths = np.where(sizes > 0, lengths, 0) + 2
    ends = np.cumsum(lengths)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.int32)
    edge = np.zeros(len(out), bool)
    out[ends - lengths], out[ends - 1] = vocabulary.begin, vocabulary.end
    edge[ends - lengths] = edge[ends - 1] = True
    out[~edge] = ids[spread(edges[:-1][numbers], word_sizes[numbers])]
    return pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(out, pa.int32()))


def blocks(column: pa.Array, limit: int) -> Iterator[tuple[int, int]]:
    """First row and number of rows of runs of at most ``limit`` bytes, or one longer row."""
    ends = utf8(column)[1]
    at = 0
    while at < len(column):
        stop = max(at + 1, int(np.searchsorted(ends, ends[at] + limit, side="right")) - 1)
        yield at, stop - at
        at = stop


def encode(docs: DataFrame, path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, ids) of every row of ``docs``, with begin and end ids; ``path`` names the model file."""
    spark = prepared(docs.sparkSession)
    model = spark.sparkContext.broadcast(cloudpickle.dumps(read_model(spark, path)))  # a vocabulary, of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = cloudpickle.loads(model.value)
        for batch in batches:
            for at, size in blocks(batch["text"], block_bytes):
                part = batch.slice(at, size)
                yield pa.record_batch([part["doc_id"], encode_texts(part["text"], vocabulary)], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, ids array<int>")


def decode_ids(ids: np.ndarray, lengths: np.ndarray, vocabulary: Vocabulary) -> list[str]:
    """Texts of lists of ids, given as one array and the length of each list."""
    sizes, starts = vocabulary.surface_sizes[ids], vocabulary.surface_starts[ids]
    # The blank in front of a text goes if its first visible piece begins with it.
    seen = np.flatnonzero(~vocabulary.control[ids])
    firsts = np.cumsum(lengths) - lengths
    spot = np.searchsorted(seen, firsts)
    has = spot < len(seen)
    has[has] = seen[spot[has]] < (firsts + lengths)[has]
    first = seen[spot[has]]
    first = first[vocabulary.leads[ids[first]]]
    sizes[first] -= 1
    starts[first] += 1
    # Byte pieces on either side of an invisible piece make no character together.
    left, right = seen[:-1], seen[1:]
    parted = right[vocabulary.is_byte[ids[left]] & vocabulary.is_byte[ids[right]] & (right - left > 1)]
    apart = set(np.searchsorted(firsts, parted, side="right").tolist())
    data = vocabulary.surface[spread(starts, sizes)].tobytes()
    ends = np.append(0, np.cumsum(sizes))[np.append(0, np.cumsum(lengths))].tolist()
    out = []
    for row, (a, b) in enumerate(zip(ends, ends[1:])):
        try:
            if row + 1 in apart:
                raise ValueError
            out.append(data[a:b].decode())
        except ValueError:  # also what a failed decoding is
            part = slice(firsts[row], firsts[row] + lengths[row])
            out.append(_decode_runs(ids[part], starts[part], sizes[part], vocabulary))
    return out


def _decode_runs(ids, starts, sizes, vocabulary) -> str:
    """One text, run by run of byte pieces: each byte that is no UTF-8 becomes U+FFFD."""
    codecs.register_error("each bad byte", lambda error: ("\ufffd", error.start + 1))
    out, run = [], bytearray()
    for number, start, size in zip(ids.tolist(), starts.tolist(), sizes.tolist()):
        content = vocabulary.surface[start : start + size].tobytes()
        if vocabulary.is_byte[number]:
            run += content
            continue
        out += [run.decode("utf-8", "each bad byte"), content.decode()]
        run.clear()
    return "".join([*out, run.decode("utf-8", "each bad byte")])


def decode(encoded: DataFrame, path: str, column: str = "ids", packed: str | None = None) -> DataFrame:
    """``encoded`` with a text column ``decoded``; null ids give a null text. ``packed`` names
    one more column with the ids as bytes, for files of tokens (see ``little_endian``).

    Begin and end are invisible and the blank that encoding put in front goes. An id that
    the vocabulary lacks, or a null in a list, is an error.
    """
    spark = prepared(encoded.sparkSession)
    model = spark.sparkContext.broadcast(cloudpickle.dumps(read_model(spark, path)))
    more = [T.StructField("decoded", T.StringType()), *([T.StructField(packed, T.BinaryType())] if packed else [])]
    schema = T.StructType([*encoded.schema.fields, *more])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = cloudpickle.loads(model.value)
        for batch in batches:
            lists = batch[column]
            values = lists.flatten()
            if values.null_count:
                raise ValueError("a list of ids holds a null")
            ids = values.to_numpy()
            if len(ids) and not (0 <= ids.min() and ids.max() < vocabulary.size):
                raise ValueError("an id is not in the vocabulary")
            lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)
            texts = pa.array(decode_ids(ids, lengths, vocabulary), pa.string())
            texts = pc.if_else(lists.is_valid(), texts, pa.scalar(None, pa.string()))
            made = [texts, little_endian(lists)] if packed else [texts]
            yield pa.record_batch([*batch.columns, *made], [*batch.schema.names, *[f.name for f in more]])

    return encoded.mapInArrow(run, schema)


def little_endian(ids: pa.Array) -> pa.Array:
    """Each list of ids as unsigned 32-bit integers, least byte first; null lists stay null."""
    values, lengths = ids.flatten().to_numpy(), pc.fill_null(pc.list_value_length(ids), 0).to_numpy()
    data, ends = np.ascontiguousarray(values, "<u4").tobytes(), (4 * np.append(0, np.cumsum(lengths, dtype=np.int64))).tolist()
    known = ids.is_valid().to_pylist()
    return pa.array([data[a:b] if k else None for a, b, k in zip(ends, ends[1:], known)], pa.binary())
