"""Exact top-k inner products by block-at-a-time pruning.

Vectors are cut into blocks by ranges of their ids. A block keeps a forward index, its
vectors as one matrix, and the largest and least value of every term (a component). What a
query can score in a block is at most the sum over terms of its weight times the term's
largest value, or least where the weight is negative. A query scores its blocks in order
of falling bounds until the next bound is below its k-th best score.

Queries are packed in groups, and every group meets every range of blocks once, in a task
of its own; what a range found is merged by a limit of k a query. Both sides of a meeting
have a fixed size, so a meeting fits a task whatever the size of the tables.

Vectors that are null, or hold null or non-finite components, neither ask nor answer. A
row never answers for itself: rows are told apart by place, so repeated ids answer each
other. Ties go to the smaller id. Vectors of another length than the query's do not
answer it. Null ids take no part. Empty tables give an empty result. Other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import prepared
from tidemark.operators.order import global_positions

BLOCK = 64
RANGE = 4096  # vectors that a meeting scores against
GROUP = 1024  # queries of a meeting
_NONE = -(1 << 62)  # below every score


def quantised(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """(id, v): the components as floor(scale * x), of whole and finite vectors."""
    values = F.transform("embedding", lambda x: x.cast("double"))
    fit = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    whole = F.transform(values, lambda x: F.floor(x * scale).cast("long"))
    return vectors.where("vec_id is not null and embedding is not null").where(fit).select(F.col("vec_id").cast("long").alias("id"), whole.alias("v"))


def _matrices(pdf: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, places, matrix) of the rows of each vector length, in order of place."""
    pdf = pdf.sort_values("place", kind="stable")
    sizes = pdf["v"].map(len)
    for size in sorted(sizes.unique()):
        some = pdf[sizes == size]
        rows = np.array(some["v"].tolist(), np.int64).reshape(len(some), size)
        yield some["id"].to_numpy(np.int64), some["place"].to_numpy(np.int64), rows


def search(queries: tuple, documents: tuple, k: int, block: int = BLOCK) -> list[tuple[int, int, int, int]]:
    """(query place, query id, id, score) of the k best documents of every query, ties by id."""
    (q_ids, q_places, q), (ids, places, rows) = queries, documents
    starts = np.arange(0, len(rows), block)
    most, least = np.maximum.reduceat(rows, starts), np.minimum.reduceat(rows, starts)
    bounds = np.maximum(q, 0) @ most.T + np.minimum(q, 0) @ least.T
    order = np.argsort(-bounds, axis=1, kind="stable")
    best_score = np.full((len(q), k), _NONE)
    best_row = np.full((len(q), k), -1)
    active = np.arange(len(q))
    for turn in range(len(starts)):
        # Those whose next bound is below the k-th score are done; at the bound ties may be.
        active = active[bounds[active, order[active, turn]] >= best_score[active, -1]]
        if not len(active):
            break
        next_block = order[active, turn]
        for b in np.unique(next_block):
            asks = active[next_block == b]
            at = np.arange(starts[b], min(starts[b] + block, len(rows)))
            scores = q[asks] @ rows[at].T
            scores[q_places[asks][:, None] == places[at]] = _NONE
            every = np.concatenate([best_score[asks], scores], axis=1)
            which = np.concatenate([best_row[asks], np.broadcast_to(at, scores.shape)], axis=1)
            by_id = np.where(which >= 0, ids[which], np.iinfo(np.int64).max)
            top = np.lexsort((which, by_id, -every), axis=1)[:, :k]
            best_score[asks] = np.take_along_axis(every, top, axis=1)
            best_row[asks] = np.take_along_axis(which, top, axis=1)
    found = best_score > _NONE
    asks, slot = np.nonzero(found)
    return list(zip(q_places[asks].tolist(), q_ids[asks].tolist(), ids[best_row[asks, slot]].tolist(), best_score[asks, slot].tolist()))


def top_k(vectors: DataFrame, asking: Column, k: int = 5, scale: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best other rows for every row that asks.

    ``asking`` is a condition on the column ``id``. Scores are exact integer products.
    """
    prepared(vectors.sparkSession)
    placed = global_positions(quantised(vectors, scale), ["id", "v"], "place")
    rows = placed.select("id", "v", (F.col("place") - 1).alias("place"), asking.alias("asks"))
    asks = global_positions(rows.where("asks").select("id", "place", "v"), ["place"], "turn")
    groups = asks.agg(F.max("turn")).first()[0] or 0
    ranges = rows.agg(F.max("place")).first()[0]
    if not groups:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    every_group = F.explode(F.sequence(F.lit(0), F.lit((groups - 1) // GROUP).cast("long")))
    every_range = F.explode(F.sequence(F.lit(0), F.lit(ranges // RANGE).cast("long")))
    left = asks.select("id", "place", "v", F.floor((F.col("turn") - 1) / GROUP).alias("group"), every_range.alias("range"))
    right = rows.select("id", "place", "v", F.floor(F.col("place") / RANGE).alias("range"), every_group.alias("group"))

    def meet(queries: pd.DataFrame, documents: pd.DataFrame) -> pd.DataFrame:
        found = []
        by_size = {d[2].shape[1]: d for d in _matrices(documents)}
        for some in _matrices(queries):
            if some[2].shape[1] in by_size:
                found += search(some, by_size[some[2].shape[1]], k)
        return pd.DataFrame(found, columns=["place", "query_id", "vec_id", "score"]).astype("int64")

    schema = "place long, query_id long, vec_id long, score long"
    met = left.groupBy("group", "range").cogroup(right.groupBy("group", "range")).applyInPandas(meet, schema)
    order = Window.partitionBy("place").orderBy(F.desc("score"), "vec_id")
    ranked = met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
