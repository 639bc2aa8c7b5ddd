"""A bounded training sample of every class."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

_RANGE = 1 << 30


def bounded_sample(rows: DataFrame, label: str, most: int | dict, seed: int = 7) -> DataFrame:
    """At most ``most`` rows of each value of ``label``, drawn by a hash of doc_id.

    ``most`` is one bound, or a bound for each value. Other values are left out.

    Needs the columns doc_id and ``label``, not null. The draw depends on the ids alone,
    so every layout and every repeated task draws the same rows. A class is first thinned
    by its counted size, then cut exactly, so no task sorts more than a few times the bound.
    """
    drawn = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(_RANGE))
    counts = rows.groupBy(label).count().collect()
    share, bound = F.lit(0.0), F.lit(0)
    for value, count in counts:
        n = most.get(value, 0) if isinstance(most, dict) else most
        share = F.when(F.col(label) == F.lit(value), min(1.0, 2.0 * (n + 50) / count)).otherwise(share)
        bound = F.when(F.col(label) == F.lit(value), n).otherwise(bound)
    thin = rows.withColumn("drawn", drawn).where(F.col("drawn") < share * _RANGE)
    order = Window.partitionBy(label).orderBy("drawn", "doc_id")
    return thin.withColumn("place", F.row_number().over(order)).where(F.col("place") <= bound).drop("drawn", "place")
