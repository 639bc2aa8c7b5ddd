"""Removal of byte strings that occur more than once, by difference-cover suffix sorting.

A string of ``length`` bytes is repeated if it starts at two places of the input, in one
text or in two. Sorting all suffixes byte by byte would move every byte several times, so
the suffixes are those of phrases:

1. Parse. A text is cut at anchors, the places whose next 8 bytes have the least hash of
   some WINDOW neighbouring places. Where two texts agree on ``length`` bytes they have
   the same anchors, but for the edges, so they agree on whole phrases between anchors.
2. Discard. A phrase seen once lies in no repeat. What is left is runs of phrases.
3. Suffix sort of the runs by the difference cover of 3: sort the phrase triples that
   start at places 1 and 2 mod 3, name them by rank, recurse on the names until they are
   unique or long enough, then merge the suffixes at places 0 mod 3 by their first phrase
   and the rank that follows.
4. Compare adjacent prefixes in that order. An anchor whose next phrases, up to the bytes
   every repeat must share behind its anchor, equal those of a neighbour is a candidate.
5. Each string belongs to one anchor, the first that any copy of it must share. Strings of
   candidates are compared whole, by hash within equal prefixes. Anchors that agree on all
   their strings are settled together; of others, one of a kind sends the hashes of its
   strings in one row.

Equal texts are settled by their hash and enter the sort once. Texts are named by a 64-bit
hash; the odds that two of N texts share one are N^2 / 4e19.

Null and empty texts have no bytes and lose none; texts below ``length`` bytes lose none.
Repeated rows are texts of their own and remove each other. Any doc_id, null too, is
passed on. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import forget, mixed, prepared, spread, utf8
from tidemark.session import stored

LENGTH = 400
WINDOW = 96
GRAM = 8
END = -(1 << 63)  # stands behind the last phrase of a run, before all others
# Texts that something is known of are found by a hash of so many bits before they are
# moved: the broadcast table of hashes seen has at most 2^20 rows whatever the input.
_NAME_BITS = 20
_CHUNK = 1 << 16
# Prefixes of more phrases than this, as texts of a short period have, are candidates
# without a look at their neighbours; so two levels of names are enough for the others.
DEPTH = 9
# Kinds of anchors with one prefix whose strings are compared together; with more, the
# strings are dealt out by their hashes.
_KINDS = 1000
_TURN, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0x632BE59BD9B4E019)
_BACK = np.uint64(pow(int(_TURN), -1, 1 << 64))


def anchors(data: np.ndarray) -> np.ndarray:
    """Places whose gram hash is the least of some WINDOW neighbouring places, in order."""
    if len(data) < GRAM + WINDOW:
        return np.empty(0, np.int64)
    grams = np.ndarray((len(data) - GRAM + 1,), "<u8", np.ascontiguousarray(data), strides=(1,))
    values = ((grams * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32)
    least = _sliding(values, np.minimum)  # of the window that starts there
    # A place is chosen if it has the least value of any window that holds it.
    edge = np.zeros(WINDOW - 1, np.uint32)
    most = _sliding(np.concatenate([edge, least, edge]), np.maximum)
    return np.flatnonzero(values == most)


def _sliding(values: np.ndarray, best) -> np.ndarray:
    width = 1
    while width < WINDOW:
        step = min(width, WINDOW - width)
        values = best(values[:-step], values[step:])
        width += step
    return values


def _behind(length: int) -> int:
    """Bytes behind its anchor within which a repeated string has the anchors of its copies."""
    return length + 3 - GRAM - 3 * WINDOW


def _phrases(length: int):
    """(key, at, h) of the phrases between anchors; ``at`` packs place, bytes back, bytes.

    A task parses each text once, however often it has it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            keys, places, hashes, sizes = [], [], [], []
            for key, text in zip(batch["key"].to_pylist(), batch["text"]):
                if key in seen:
                    continue
                content = text.as_py().encode()
                cut = anchors(np.frombuffer(content, np.uint8)) if len(content) >= length else ()
                if len(cut) < 2:
                    continue
                seen.add(key)
                long = np.diff(cut)
                back = np.concatenate([[0], long[:-1]])
                places.append((cut[:-1] << 16) | (back << 8) | long)
                ends = cut.tolist()
                hashes += [xxhash.xxh3_64_intdigest(content[a:b]) for a, b in zip(ends, ends[1:])]
                keys.append(key)
                sizes.append(len(long))
            if keys:
                names = np.repeat(np.array(keys, np.int64), sizes)
                values = np.maximum(np.array(hashes, np.uint64).view(np.int64), END + 1)
                whole = pa.record_batch([pa.array(names), pa.array(np.concatenate(places)), pa.array(values)], ["key", "at", "h"])
                for at in range(0, len(names), 100_000):
                    yield whole.slice(at, 100_000)

    return run


def _runs(length: int):
    """The strings to sort, from the phrases kept, in the order of (key, at); repeated ones count once.

    Rows (sid, place, c, c1, c2, key, pos, back, n, g, prefixes): runs of phrases next to each
    other, each with the two that follow.
    ``n`` counts the phrases from here that lie in the bytes behind an anchor, ``g`` is their
    hash, and ``prefixes`` has those of the first one, two ... of them, up to DEPTH, eight bytes
    each; ``n`` is 0 where they do not reach far enough to be shared.
    """
    reach = _behind(length)

    def whole_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
        held, size = [], 0
        for batch in batches:
            held.append([batch[f].to_numpy(zero_copy_only=False) for f in ("key", "at", "h")])
            size += batch.num_rows
            if size > _CHUNK:
                key, at, h = (np.concatenate(x) for x in zip(*held))
                stop = int(np.flatnonzero(key != key[-1])[-1]) + 1 if key[0] != key[-1] else 0
                if stop:
                    yield [key[:stop], at[:stop], h[:stop]]
                held, size = [[key[stop:], at[stop:], h[stop:]]], 0
        if held:
            yield [np.concatenate(x) for x in zip(*held)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = TaskContext.get().partitionId() << 33
        for key, at, h in whole_texts(batches):
            if not len(key):
                continue
            new = np.append(True, (key[1:] != key[:-1]) | (at[1:] != at[:-1]))
            key, at, h = key[new], at[new], h[new]
            pos, back, long = at >> 16, (at >> 8) & 255, at & 255
            opens = np.append(True, (key[1:] != key[:-1]) | (pos[1:] - back[1:] != pos[:-1]))
            enough = np.bincount(np.cumsum(opens) - 1, weights=long) > reach - WINDOW
            kept = enough[np.cumsum(opens) - 1]
            if not kept.any():
                continue
            key, pos, back, long, h, opens = (x[kept] for x in (key, pos, back, long, h, opens))
            rows, of = np.arange(len(pos)), np.cumsum(opens) - 1
            start = pos + (of << 36)  # later in every run than in the ones before
            ends = start + long
            last = np.searchsorted(ends, start + reach, side="right")
            far = (last > rows) & (ends[np.maximum(last - 1, 0)] - start > reach - WINDOW)
            n = np.where(far, last - rows, 0)
            prefixes, state = np.zeros((len(rows), DEPTH), np.uint64), np.zeros(len(rows), np.uint64)
            for k in range(int(n.max())):
                some = np.flatnonzero(n > k)
                made = (state[some] ^ h.view(np.uint64)[some + k]) * _TURN + _STEP
                state[some] = made ^ (made >> np.uint64(29))
                if k < DEPTH:
                    prefixes[some, k] = state[some]
            sizes = np.minimum(n, DEPTH)
            inside = np.arange(DEPTH) < sizes[:, None]
            offsets = np.concatenate([[0], np.cumsum(sizes * 8)]).astype(np.int32)
            ahead = np.concatenate([h, [END, END]])
            same = np.concatenate([of, [-1, -1]])
            c1, c2 = (np.where(same[k : k + len(of)] == of, ahead[k : k + len(of)], END) for k in (1, 2))
            columns = {"sid": of + count, "place": rows - np.flatnonzero(opens)[of], "c": h, "c1": c1, "c2": c2}
            columns |= {"key": key, "pos": pos, "back": back, "n": n, "g": state.view(np.int64)}
            lists = pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(prefixes[inside])])
            whole = pa.record_batch([*(pa.array(v, pa.int64()) for v in columns.values()), lists], [*columns, "prefixes"])
            count += int(opens.sum())
            for i in range(0, len(rows), 100_000):
                yield whole.slice(i, 100_000)

    return run


def _next(strings: DataFrame, column: str, fill: int) -> DataFrame:
    """``strings`` with the column's values one and two places on, ``fill`` behind the end.

    A string is cut into chunks that borrow two rows of the next, so no task grows with it.
    """
    chunk, size = F.floor(F.col("place") / _CHUNK), _CHUNK
    lent = strings.where((F.col("place") % size < 2) & (F.col("place") >= size)).withColumn("chunk", chunk - 1)
    both = strings.withColumn("chunk", chunk).union(lent).repartition("sid", "chunk").sortWithinPartitions("sid", "chunk", "place")
    names = strings.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in chain(batches, [None]):
            rows = held if batch is None else batch if held is None else pa.concat_batches([held, batch])
            if rows is None:
                return
            stop = len(rows) if batch is None else max(0, len(rows) - 2)  # the last two wait for those behind them
            sid, part, place, values = (rows[f].to_numpy(zero_copy_only=False) for f in ("sid", "chunk", "place", column))
            ahead = []
            for k in (1, 2):
                next_one = np.full(len(rows), fill, np.int64)
                same = (sid[k:] == sid[:-k]) & (part[k:] == part[:-k])
                next_one[:-k] = np.where(same, values[k:], fill)
                ahead.append(pa.array(next_one))
            whole = pa.record_batch([*(rows[f] for f in names), *ahead], [*names, f"{column}1", f"{column}2"])
            yield whole.slice(0, stop).filter(pa.array((place // size == part)[:stop]))
            held = rows.slice(stop)

    schema = ", ".join(f"{f} long" for f in (*names, f"{column}1", f"{column}2"))
    return both.mapInArrow(run, schema)


def _sums(counts: Sequence[str]):
    """Adds ``_seg``, the task, and ``sum_<count>``: the sums of the counts in the task's earlier rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), dict.fromkeys(counts, 0)
        for batch in batches:
            batch = batch.append_column("_seg", pa.array(np.full(batch.num_rows, part), pa.int64()))
            for c in counts:
                values = batch[c].to_numpy(zero_copy_only=False)
                upto = np.cumsum(values) + before[c]
                batch = batch.append_column(f"sum_{c}", pa.array(upto - values, pa.int64()))
                before[c] = int(upto[-1]) if len(upto) else before[c]
            yield batch

    return run


def _before(counted: DataFrame, keys: Sequence[str], counts: Sequence[str]) -> DataFrame:
    """Of distinct ``keys`` with counts: the sums of the counts of all smaller keys."""
    ordered = counted.select(*keys, *counts).repartitionByRange(*keys).sortWithinPartitions(*keys)
    schema = ", ".join(f"{c} long" for c in (*keys, *counts, "_seg", *(f"sum_{c}" for c in counts)))
    parts = stored(ordered.mapInArrow(_sums(counts), schema), "segments")
    order = Window.orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    totals = parts.groupBy("_seg").agg(*[F.sum(c).alias(f"all_{c}") for c in counts])
    offsets = totals.select("_seg", *[F.coalesce(F.sum(f"all_{c}").over(order), F.lit(0)).alias(f"off_{c}") for c in counts])
    sums = [(F.col(f"off_{c}") + F.col(f"sum_{c}")).alias(f"before_{c}") for c in counts]
    return parts.join(F.broadcast(offsets), "_seg").select(*keys, *counts, *sums)  # one row per range partition


def suffix_ranks(strings: DataFrame, need: int, span: int = 1) -> DataFrame:
    """(sid, place, rank): how many suffixes are smaller, for all places of all strings.

    ``strings`` has (sid, place, c, c1, c2): places dense from 0, a symbol and the two that
    follow. Ranks order suffixes by their first ``need`` symbols at least; suffixes that
    agree on more may share a rank.
    """
    sampled, triple = strings.where("place % 3 != 0"), ["c", "c1", "c2"]
    names = _before(sampled.groupBy(*triple).agg(F.count("*").alias("n")), triple, ["n"])
    named = sampled.select("sid", "place", *triple).join(names.hint("shuffle_hash"), triple).select("sid", "place", F.col("before_n").alias("r"))
    named = stored(named, "names")
    more = 3 * span < need and not names.where("n > 1").isEmpty()
    forget(names)
    if not more:
        return _merged(strings, named)
    deeper = named.select((F.col("sid") * 2 + F.col("place") % 3 - 1).alias("sid"), F.floor(F.col("place") / 3).alias("place"), F.col("r").alias("c"))
    deeper = stored(_next(deeper, "c", END), "triples")
    forget(named)
    ranked = suffix_ranks(deeper, need, 3 * span)
    forget(deeper)
    place = (F.col("place") * 3 + F.col("sid") % 2 + 1).alias("place")
    return _merged(strings, ranked.select(F.floor(F.col("sid") / 2).alias("sid"), place, F.col("rank").alias("r")))


def _merged(strings: DataFrame, named: DataFrame) -> DataFrame:
    """Ranks of all suffixes from those of the sampled ones, which ``named`` has as r.

    Places 0 and 1 mod 3 compare by one symbol and the rank behind it, places 0 and 2 by
    two; how many of either kind are smaller adds up to the rank. Three places are one row:
    their symbols c0 to c2 and the next, and the ranks r1, r2 and r4 of the sampled places
    from the first on, -1 where there is none.
    """
    kind, block = F.col("place") % 3, F.floor(F.col("place") / 3)

    def parts(of: DataFrame, block: Column, **values: Column) -> DataFrame:
        found = [values.get(f, F.lit(None)).cast("long").alias(f) for f in ("c0", "c1", "c2", "c3", "r1", "r2", "r4")]
        return of.select("sid", block.alias("block"), *found)

    def of_kind(k: int, column: str) -> Column:
        return F.when(kind == k, F.col(column))

    symbols = parts(strings.where(kind != 1), block, c0=of_kind(0, "c"), c1=of_kind(0, "c1"), c2=of_kind(2, "c"), c3=of_kind(2, "c1"))
    ranks = parts(named, block, r1=of_kind(1, "r"), r2=of_kind(2, "r"))
    behind = parts(named.where((kind == 1) & (F.col("place") > 1)), block - 1, r4=F.col("r"))
    filled = [F.coalesce(F.max(f), F.lit(-1)).alias(f) for f in ("r1", "r2", "r4")]
    both = symbols.union(ranks).union(behind).groupBy("sid", "block")
    full = stored(both.agg(*[F.max(f).alias(f) for f in ("c0", "c1", "c2", "c3")], *filled), "merge")
    forget(named)

    place, one, two = F.col("block") * 3, ["c0", "r1"], ["c0", "c1", "r2"]
    zero = full.select("sid", place.alias("place"), "c0", "c1", "r1", "r2")
    first = full.where("r1 >= 0").selectExpr("sid", "block * 3 + 1 as place", "r1 as r", "c1 as c0", "r2 as r1")
    second = full.where("r2 >= 0").selectExpr("sid", "block * 3 + 2 as place", "r2 as r", "c2 as c0", "c3 as c1", "r4 as r2")

    def smaller(other: DataFrame, keys: Sequence[str], zeros: str, others: str) -> DataFrame:
        """Of each key: how many places 0 and how many of the other kind have smaller ones."""
        seen = zero.select(*keys, F.lit(True).alias("zero")).union(other.select(*keys, F.lit(False)))
        counts = seen.groupBy(*keys).agg(F.count_if("zero").alias("n0"), F.count_if(~F.col("zero")).alias("n"))
        found = _before(counts, keys, ["n0", "n"])
        return found.select(*keys, F.col("before_n0").alias(zeros), F.col("before_n").alias(others))

    by_one, by_two = smaller(first, one, "one_0", "one_1"), smaller(second, two, "two_0", "two_2")
    of_one, of_two = by_one.hint("shuffle_hash"), by_two.hint("shuffle_hash")
    ranked = (
        zero.join(of_one, one).join(of_two, two).selectExpr("sid", "place", "one_0 + one_1 + two_2 as rank")
        .union(first.join(of_one, one).selectExpr("sid", "place", "one_0 + r as rank"))
        .union(second.join(of_two, two).selectExpr("sid", "place", "two_0 + r as rank"))
    )
    ranks = stored(ranked, "ranks")
    forget(full, by_one, by_two)
    return ranks


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows in suffix order, those whose whole prefix is that of a neighbour.

    Those of more than DEPTH phrases are not compared, and the first and the last row of a
    task have neighbours elsewhere; all these pass.
    """
    held, passes = None, True
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = batch if held is None else pa.concat_batches([held, batch])
        n, g = (rows[f].to_numpy(zero_copy_only=False) for f in ("n", "g"))
        data, offsets = utf8(rows["prefixes"])
        values, offsets = data.view(np.int64), offsets >> 3
        sizes = np.diff(offsets)
        found = n > DEPTH
        found[0] |= passes
        one, other = np.arange(len(n) - 1), np.arange(1, len(n))
        for a, b in ((one, other), (other, one)):
            fits = n[a] <= sizes[b]
            a, b = a[fits], b[fits]
            found[a] |= values[offsets[b] + n[a] - 1] == g[a]
        held, passes = rows.slice(len(n) - 1), bool(found[-1])
        yield rows.slice(0, len(n) - 1).filter(pa.array(found[:-1])).select(["key", "pos", "back", "g"])
    if held is not None:
        yield held.select(["key", "pos", "back", "g"])


def _candidates(strings: DataFrame) -> DataFrame:
    """(key, pos, back, g) of anchors whose prefix a neighbour in suffix order shares."""
    most = strings.agg(F.max("n")).first()[0] or 0
    ranks = suffix_ranks(strings.select("sid", "place", "c", "c1", "c2"), min(most, DEPTH))
    order = ["rank", "sid", "place"]
    ranked = strings.where("n > 0").select("sid", "place", "key", "pos", "back", "n", "g", "prefixes").join(ranks.hint("shuffle_hash"), ["sid", "place"])
    ordered = ranked.repartitionByRange(*order).sortWithinPartitions(*order).drop(*order)
    found = stored(ordered.mapInArrow(_neighbours, "key long, pos long, back long, g long"), "candidates")
    forget(ranks)
    return found


def _owned(texts: pa.StringArray, anchors_of: pa.ListArray, length: int) -> Iterator[tuple[int, bytes, dict[str, np.ndarray]]]:
    """Of each text: its row, its bytes, and the given anchors that own strings, with their first and last."""
    flat, offsets = anchors_of.flatten(), anchors_of.offsets.to_numpy()
    fields = {f.name: flat.field(f.name).to_numpy(zero_copy_only=False) for f in flat.type}
    for row, (start, stop) in enumerate(zip(offsets - offsets[0], offsets[1:] - offsets[0])):
        content, own = texts[row].as_py().encode(), {f: v[start:stop] for f, v in fields.items()}
        own["first"] = np.where(own["back"] > 0, np.maximum(0, own["pos"] - own["back"] - WINDOW + 2), 0)
        own["last"] = np.minimum(own["pos"] - WINDOW + 1, len(content) - length)
        some = np.argsort(own["first"], kind="stable")
        some = some[(own["first"] <= own["last"])[some]]
        yield row, content, {f: v[some] for f, v in own.items()}


def _contexts(length: int):
    """(key, pos, back, g, first, last, context): all strings of an anchor as one hash."""
    names = ["pos", "back", "g", "first", "last"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, hashes, columns = [], [], {f: [np.empty(0, np.int64)] for f in names}
            for row, content, own in _owned(batch["text"], batch["found"], length):
                spans = zip(own["first"].tolist(), own["last"].tolist(), own["pos"].tolist())
                hashes += [xxhash.xxh3_64_intdigest(content[a : b + length], p - a) for a, b, p in spans]
                rows.append(np.full(len(own["pos"]), row))
                for f in names:
                    columns[f].append(own[f])
            keys = batch["key"].to_numpy(zero_copy_only=False)[np.concatenate([*rows, np.empty(0, np.int64)]).astype(np.int64)]
            whole = np.array(hashes, np.uint64).view(np.int64)
            yield pa.record_batch([pa.array(c, pa.int64()) for c in (keys, *(np.concatenate(columns[f]) for f in names), whole)], ["key", *names, "context"])

    return run


@lru_cache(4)
def _powers(base: int, bits: int) -> np.ndarray:
    return np.cumprod(np.full(1 << bits, base, np.uint64))


def _string_hashes(content: bytes, first: np.ndarray, last: np.ndarray, length: int) -> Iterator[np.ndarray]:
    """For each anchor, in order of ``first``, hashes of its strings.

    They are polynomials of the mixed eight bytes at every place, modulo 2^64.
    """
    for some in np.split(np.arange(len(first)), np.flatnonzero(np.diff(first >> 20)) + 1):  # a stretch of the text at a time
        if not len(some):
            continue
        low, high = int(first[some[0]]), int(last[some].max()) + length
        data = np.frombuffer(content, np.uint8)[low:high]
        grams = mixed(np.ndarray((len(data) - 7,), "<u8", data, strides=(1,)))
        bits = max(16, len(grams).bit_length())
        grams *= _powers(int(_TURN), bits)[: len(grams)]
        upto = np.append(np.uint64(0), np.cumsum(grams))
        sums = upto[length - 7 :] - upto[: len(upto) - (length - 7)]
        # Each sum is turned back by the place it starts at.
        sums = mixed(sums * _powers(int(_BACK), bits)[: len(sums)])
        for a, b in zip((first[some] - low).tolist(), (last[some] - low).tolist()):
            yield sums[a : b + 1]


def _listed(length: int):
    """(g, part, key, first, hashes, chosen): the strings of each given anchor, by hash, in one row.

    ``first`` is where the first of them starts, the others follow byte by byte. Where many
    kinds of anchors share a prefix, ``parts`` is above 1, an anchor's strings are dealt out by
    their hashes, and ``chosen`` tells which are in the row.
    """
    kinds = {"g": pa.int64(), "part": pa.int64(), "key": pa.int64(), "first": pa.int64(), "hashes": pa.binary(), "chosen": pa.binary()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, keys = [], batch["key"].to_pylist()
            for row, content, own in _owned(batch["text"], batch["listed"], length):
                strings = _string_hashes(content, own["first"], own["last"], length)
                for made, g, first, parts in zip(strings, *(own[f].tolist() for f in ("g", "first", "parts"))):
                    if parts == 1:
                        rows.append((g, 0, keys[row], first, made.tobytes(), None))
                        continue
                    of = made % np.uint64(parts)
                    for part in np.unique(of):
                        some = np.flatnonzero(of == part).astype(np.int32)
                        rows.append((g, int(part), keys[row], first, made[some].tobytes(), some.tobytes()))
                if len(rows) > 10_000:
                    yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds.values())], list(kinds))
                    rows = []
            if rows:
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds.values())], list(kinds))

    return run


def _compared(length: int):
    """(key, start, stop) of the strings that occur twice, from rows in the order of (g, part)."""

    def spans(rows: pa.RecordBatch, group: np.ndarray) -> pa.RecordBatch:
        made = rows["hashes"].to_pylist()
        sizes = np.array([len(x) >> 3 for x in made], np.int64)
        # One group's strings differ by hash alone; the turn keeps those of others apart.
        names = np.frombuffer(b"".join(made), np.uint64) ^ (np.repeat(group, sizes).astype(np.uint64) * _TURN)
        order = np.argsort(names)
        alike = names[order[1:]] == names[order[:-1]]
        twice = np.zeros(len(names), bool)
        twice[order[1:][alike]] = twice[order[:-1][alike]] = True
        starts = spread(rows["first"].to_numpy(zero_copy_only=False), sizes)
        first = np.cumsum(sizes) - sizes
        for row, some in enumerate(rows["chosen"].to_pylist()):
            if some is not None:
                starts[first[row] : first[row] + sizes[row]] = rows["first"][row].as_py() + np.frombuffer(some, np.int32)
        own, starts = np.repeat(np.arange(len(sizes)), sizes)[twice], starts[twice]
        opens = np.ones(len(own), bool)
        opens[1:] = (own[1:] != own[:-1]) | (starts[1:] != starts[:-1] + 1)
        opened = np.flatnonzero(opens)
        closed = np.append(opened[1:], len(own)) - 1 if len(own) else opened
        keys = rows["key"].to_numpy(zero_copy_only=False)[own[opened]]
        return pa.record_batch([pa.array(c, pa.int64()) for c in (keys, starts[opened], starts[closed] + length)], ["key", "start", "stop"])

    def groups(rows: pa.RecordBatch) -> np.ndarray:
        g, part = (rows[f].to_numpy(zero_copy_only=False) for f in ("g", "part"))
        return np.cumsum(np.append(False, (g[1:] != g[:-1]) | (part[1:] != part[:-1])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # of the last group, which may go on
        for batch in batches:
            if not batch.num_rows:
                continue
            if held and all(held[0][f][0] == batch[f][at] for f in ("g", "part") for at in (0, -1)):
                held.append(batch)
                continue
            rows = pa.concat_batches([*held, batch])
            group = groups(rows)
            stop = int(np.searchsorted(group, group[-1]))
            held = [rows.slice(stop)]
            if stop:
                yield spans(rows.slice(0, stop), group[:stop])
        if held:
            rows = pa.concat_batches(held)
            yield spans(rows, groups(rows))

    return run


def _named(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", text.alias("text")).withColumn("key", F.xxhash64("text"))


def _touched(named: DataFrame, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that may have one of ``keys``, and rows that surely have none, without a shuffle."""
    short = F.pmod("key", F.lit(1 << _NAME_BITS)).cast("int")
    seen = F.broadcast(keys.select(short.alias("short")).distinct())
    marked = named.withColumn("short", short)
    return marked.join(seen, "short", "left_semi").drop("short"), marked.join(seen, "short", "left_anti").drop("short")


def repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(key, spans): of every text with repeats, the (start, stop) byte spans of its repeated strings.

    Spans may overlap; ``key`` is the hash of the text.
    """
    if _behind(length) <= WINDOW:
        raise ValueError(f"length must be at least {4 * WINDOW + GRAM - 2}")
    prepared(docs.sparkSession)
    named = _named(docs)
    phrases = stored(named.select("key", "text").mapInArrow(_phrases(length), "key long, at long, h long"), "phrases")
    # Copies of a text have each phrase at the same place of it.
    where = F.xxhash64("key", "at")
    common = phrases.groupBy("h").agg(F.min(where).alias("one"), F.max(where).alias("other")).where("one != other").select("h").hint("shuffle_hash")
    kept = phrases.join(common, "h", "left_semi").repartition("key").sortWithinPartitions("key", "at")
    schema = "sid long, place long, c long, c1 long, c2 long, key long, pos long, back long, n long, g long, prefixes binary"
    strings = stored(kept.mapInArrow(_runs(length), schema), "runs")
    forget(phrases)
    found = _candidates(strings)
    forget(strings)

    lists = found.groupBy("key").agg(F.collect_list(F.struct("pos", "back", "g")).alias("found"))
    texts = _touched(named, found)[0].groupBy("key").agg(F.first("text").alias("text"))
    texts = stored(texts.join(lists, "key"), "texts")
    forget(found)
    schema = "key long, pos long, back long, g long, first long, last long, context long"
    settled = stored(texts.mapInArrow(_contexts(length), schema), "contexts")
    classes = settled.groupBy("g", "context").agg(F.count("*").alias("n"), *[F.first(c).alias(c) for c in ("key", "pos", "back")])  # of one row
    classes = stored(classes, "classes")
    together = settled.join(classes.where("n > 1").select("g", "context").hint("shuffle_hash"), ["g", "context"], "left_semi")
    mixed = classes.groupBy("g").agg(F.count("*").alias("kinds")).where("kinds > 1")
    parts = F.floor(F.col("kinds") / _KINDS) + 1
    listed = classes.join(mixed.hint("shuffle_hash"), "g").select("key", F.struct("pos", "back", "g", parts.alias("parts")).alias("x"))
    listed = listed.groupBy("key").agg(F.collect_list("x").alias("listed"))
    schema = "g long, part long, key long, first long, hashes binary, chosen binary"
    dealt = texts.select("key", "text").join(listed, "key").mapInArrow(_listed(length), schema).repartition("g", "part").sortWithinPartitions("g", "part")
    apart = stored(dealt.mapInArrow(_compared(length), "key long, start long, stop long"), "apart")
    forget(texts)

    sizes = named.select("key", F.octet_length("text").cast("long").alias("size")).where(F.col("size") >= length)
    copies = sizes.groupBy("key").agg(F.count("*").alias("n"), F.max("size").alias("size")).where("n > 1")
    spans = (
        together.select("key", F.col("first").alias("start"), (F.col("last") + length).alias("stop"))
        .union(apart)
        .union(copies.select("key", F.lit(0).cast("long"), "size"))
    )
    return spans.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("spans"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is left of texts without their spans, and the spans merged."""
    for batch in batches:
        kept, merged = [], []
        for text, spans in zip(batch["text"], batch["spans"]):
            content, runs = text.as_py().encode(), []
            if spans.is_valid:
                start, stop = (spans.values.field(f).to_numpy(zero_copy_only=False) for f in ("start", "stop"))
                stop = np.maximum.accumulate(stop)
                opens = np.flatnonzero(np.append(True, start[1:] > stop[:-1]))
                runs = list(zip(start[opens].tolist(), stop[np.append(opens[1:], len(start)) - 1].tolist()))
            edges = [0, *[x for r in runs for x in r], len(content)]
            kept.append(b"".join(content[a:b] for a, b in zip(edges[::2], edges[1::2])))
            merged.append(len(runs))
        yield pa.record_batch([batch["doc_id"], batch["text"], pa.array(kept, pa.binary()), pa.array(merged, pa.int64())], ["doc_id", "text", "kept", "n_spans"])


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, text, kept, n_spans): the bytes left of every row, and how many runs were cut."""
    spans = stored(repeats(docs, length), "repeats")
    some, none = _touched(_named(docs), spans)
    kind = docs.schema["doc_id"].dataType.simpleString()
    cut = some.join(spans, "key", "left").select("doc_id", "text", "spans").mapInArrow(_cut, f"doc_id {kind}, text string, kept binary, n_spans long")
    return cut.union(none.select("doc_id", "text", F.col("text").cast("binary"), F.lit(0).cast("long")))
