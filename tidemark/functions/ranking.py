"""Ranking metrics over one relevant and one recommended array per row.

For arrays that are short by construction (a top-k list, a truncated history).
``operators.evaluation`` has the join form for relevant sets of any size.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidemark.functions.columns import first_n


def _top(recommended: Column, k: int | None) -> Column:
    return recommended if k is None else first_n(recommended, k)


def _gain(position: Column) -> Column:
    """Discount of a 0-based position."""
    return F.lit(1.0) / F.log2(position + F.lit(2.0))


def _discount_sum(positions: Column) -> Column:
    return F.aggregate(positions, F.lit(0.0), lambda total, p: total + _gain(p))


def ndcg_at_k(relevant: Column, recommended: Column, k: int | None = None) -> Column:
    """Every hit position counts; the ideal list has min(|set|, list length) hits."""
    top = _top(recommended, k)
    hits = F.filter(
        F.transform(top, lambda item, i: F.when(F.array_contains(relevant, item), i)), lambda i: i.isNotNull()
    )
    ideal = F.least(F.size(F.array_distinct(relevant)), F.size(top))
    ideal_positions = F.when(ideal > 0, F.sequence(F.lit(0), ideal - 1)).otherwise(F.array().cast("array<int>"))
    best = _discount_sum(ideal_positions)
    return F.when(best > 0, _discount_sum(hits) / best).otherwise(F.lit(0.0))


def recall_at_k(relevant: Column, recommended: Column, k: int | None = None) -> Column:
    """Distinct hits over the length of the relevant list, repeats included."""
    hits = F.size(F.array_intersect(relevant, _top(recommended, k)))
    return F.when(F.size(relevant) > 0, hits / F.size(relevant)).otherwise(F.lit(0.0))


def precision_at_k(relevant: Column, recommended: Column, k: int | None = None) -> Column:
    """Distinct hits over the length of the truncated list, not over k."""
    top = _top(recommended, k)
    hits = F.size(F.array_intersect(relevant, top))
    return F.when(F.size(top) > 0, hits / F.size(top)).otherwise(F.lit(0.0))


def hit_rate_at_k(target: Column, recommended: Column, k: int | None = None) -> Column:
    return F.when(F.array_contains(_top(recommended, k), target), F.lit(1.0)).otherwise(F.lit(0.0))


def mrr_at_k(relevant: Column, recommended: Column, k: int | None = None) -> Column:
    hits = F.transform(
        _top(recommended, k), lambda item, i: F.when(F.array_contains(relevant, item), F.lit(1.0) / (i + F.lit(1.0)))
    )
    return F.coalesce(F.array_max(hits), F.lit(0.0))
