"""Distribution drift of numeric columns between a reference and a current batch."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.operators.order import running_sums
from tidemark.session import stored

# Fixed value: sqrt(-ln(0.05 / 2) / 2), the large-sample two-sided 5 % point.
KS_FACTOR = 1.3581015157406195
MIN_SCALE = 0.001
KS_MAX_ROWS = 1000


def _long(df: DataFrame, columns: Sequence[str], side: str) -> DataFrame:
    complete = df.select(*columns).na.drop()
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns])
    return complete.select(F.explode(entries).alias("e")).select("e.*", F.lit(side).alias("side"))


def value_counts(reference: DataFrame, current: DataFrame, columns: Sequence[str] = ("rating", "ts")) -> DataFrame:
    """(column, value, ref, cur): rows per distinct value, counted before the shuffle."""
    both = _long(reference, columns, "ref").unionByName(_long(current, columns, "cur"))
    return both.groupBy("column", "value").agg(
        F.count_if(F.col("side") == "ref").alias("ref"), F.count_if(F.col("side") == "cur").alias("cur")
    )


def drift_distances(reference: DataFrame, current: DataFrame, columns: Sequence[str] = ("rating", "ts")) -> DataFrame:
    """Per column: row counts, largest gap of the two distributions, area between them
    and the spread of the reference."""
    placed = running_sums(value_counts(reference, current, columns), "column", "value", ["ref", "cur"], previous=True)
    spread = _long(reference, columns, "ref").groupBy("column").agg(F.stddev_pop("value").alias("ref_std"))
    # NULL where a side is empty.
    share = lambda side, own: F.try_divide(F.col(f"cum_{side}") - own, F.col(f"all_{side}"))
    gap = F.abs(share("ref", F.lit(0)) - share("cur", F.lit(0)))
    # Between two values both distributions stay at their level before the later one.
    level = F.abs(share("ref", F.col("ref")) - share("cur", F.col("cur")))
    # One row per monitored column on both sides of the join.
    return (
        placed.groupBy("column")
        .agg(
            F.max("all_ref").alias("n_ref"),
            F.max("all_cur").alias("n_cur"),
            F.max(gap).alias("ks"),
            F.coalesce(F.sum(level * (F.col("value") - F.col("prev_value"))), F.lit(0.0)).alias("wasserstein"),
        )
        .join(F.broadcast(spread), "column")
    )


def ks_critical(n_ref: Column, n_cur: Column) -> Column:
    return F.lit(KS_FACTOR) * F.sqrt(F.try_divide(n_ref + n_cur, n_ref.cast("double") * n_cur))


def column_drift(
    distances: DataFrame, method: str = "auto", wasserstein_threshold: float = 0.1
) -> DataFrame:
    """Add ``method``, ``score``, ``threshold`` and ``drifted``.

    'ks' and 'wasserstein' force one test; 'auto' takes KS for a reference of at most
    1000 rows and the normed Wasserstein distance above that.
    """
    chosen = {
        "auto": F.when(F.col("n_ref") <= KS_MAX_ROWS, F.lit("ks")).otherwise(F.lit("wasserstein")),
        "ks": F.lit("ks"),
        "wasserstein": F.lit("wasserstein"),
    }[method]
    normed = F.col("wasserstein") / F.greatest(F.col("ref_std"), F.lit(MIN_SCALE))
    is_ks = F.col("method") == "ks"
    return (
        distances.withColumn("method", chosen)
        .withColumn("score", F.when(is_ks, F.col("ks")).otherwise(normed))
        .withColumn("threshold", F.when(is_ks, ks_critical(F.col("n_ref"), F.col("n_cur"))).otherwise(F.lit(wasserstein_threshold)))
        .withColumn("drifted", F.when(is_ks, F.col("score") > F.col("threshold")).otherwise(F.col("score") >= F.col("threshold")))
    )


def dataset_drift(
    drift: DataFrame, share: float = 0.5, min_current_rows: int = 10
) -> DataFrame:
    """One row: share of drifted columns and the verdict; none for a tiny current batch."""
    return drift.agg(
        F.coalesce(F.avg(F.col("drifted").cast("double")), F.lit(0.0)).alias("drift_share"),
        F.coalesce(F.max("n_cur"), F.lit(0)).alias("current_rows"),
    ).select(
        "drift_share",
        "current_rows",
        F.when(F.col("current_rows") < min_current_rows, F.lit(False))
        .otherwise(F.col("drift_share") >= share)
        .alias("drift_detected"),
    )


# Constants of the rank error of a KLL sketch, for one rank at 99 %.
RANK_ERROR_SCALE, RANK_ERROR_POWER = 2.296, 0.9021
# Rank errors by which estimates are taken to be off, as many ranks are asked at once.
BAND = 3
SKETCH_K = 4096
GRID = 256


def column_sketches(batches: DataFrame, columns: Sequence[str] = ("rating", "ts"), k: int = SKETCH_K) -> DataFrame:
    """(batch_id, column, n, mean, m2, low, high, sketch): what drift needs of a batch, a few
    kilobytes a column. Rows with a NULL among the columns are left out, as in the exact form."""
    complete = batches.select("batch_id", *columns).na.drop(subset=list(columns))
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns])
    return (
        complete.select("batch_id", F.explode(entries).alias("e"))
        .groupBy("batch_id", "e.column")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg("e.value").alias("mean"),
            (F.var_pop("e.value") * F.count(F.lit(1))).alias("m2"),
            F.min("e.value").alias("low"),
            F.max("e.value").alias("high"),
            F.kll_sketch_agg_double("e.value", F.lit(k)).alias("sketch"),
        )
    )


def merged_sketches(sketches: DataFrame) -> DataFrame:
    """One row a column for all batches together; squares are summed around the common mean."""
    of_column = Window.partitionBy("column")  # a row for each batch
    centred = sketches.withColumn("_mean", F.sum(F.col("n") * F.col("mean")).over(of_column) / F.sum("n").over(of_column))
    spread = F.col("m2") + F.col("n") * (F.col("mean") - F.col("_mean")) * (F.col("mean") - F.col("_mean"))
    return centred.groupBy("column").agg(
        F.sum("n").alias("n"),
        F.sqrt(F.sum(spread) / F.sum("n")).alias("std"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.kll_merge_agg_double("sketch").alias("sketch"),
    )


def sketched_drift(
    reference: DataFrame, current: DataFrame, method: str = "auto", wasserstein_threshold: float = 0.1, k: int = SKETCH_K
) -> DataFrame:
    """``column_drift`` estimated from the sketches of both sides, with the half width ``band``
    of the interval that holds the exact score, and ``certain`` where it leaves the threshold out.

    Both distributions are compared at the quantiles of a grid; between two grid points they
    change by no more than the grid's step, which is part of the band.
    """
    sides = [
        merged_sketches(side).select("column", *[F.col(c).alias(f"{c}_{name}") for c in ("n", "std", "low", "high", "sketch")])
        for side, name in ((reference, "ref"), (current, "cur"))
    ]
    both = stored(sides[0].join(sides[1], "column"), "both-sketches")  # a row a column
    ranks = F.expr("array(" + ",".join(f"{i / GRID!r}D" for i in range(1, GRID)) + ")")
    ends = F.array(F.least("low_ref", "low_cur"), F.greatest("high_ref", "high_cur"))
    quantiles = F.concat(F.kll_sketch_get_quantile_double("sketch_ref", ranks), F.kll_sketch_get_quantile_double("sketch_cur", ranks), ends)
    # Spark asks a sketch for the ranks of literal values only: 2 * GRID numbers a column at most.
    grids = {row["column"]: sorted(set(row["at"])) for row in both.select("column", quantiles.alias("at")).collect()}
    placed = both.withColumns({"_at": F.lit(None).cast("array<double>"), "_gaps": F.lit(None).cast("array<double>")})
    for name, values in grids.items():
        at, mine = F.expr("array(" + ",".join(f"double('{v!r}')" for v in values) + ")"), F.col("column") == name
        gaps = F.zip_with(F.kll_sketch_get_rank_double("sketch_ref", at), F.kll_sketch_get_rank_double("sketch_cur", at), lambda x, y: F.abs(x - y))
        placed = placed.withColumns({"_at": F.when(mine, at).otherwise(F.col("_at")), "_gaps": F.when(mine, gaps).otherwise(F.col("_gaps"))})
    widths = F.transform(F.slice("_at", 2, F.size("_at") - 1), lambda x, i: x - F.element_at("_at", i + 1))
    areas = F.zip_with(widths, F.slice("_gaps", 1, F.size("_gaps") - 1), lambda w, g: w * g)
    error = F.lit(2 * BAND * RANK_ERROR_SCALE / k**RANK_ERROR_POWER + 1 / GRID)
    distances = placed.select(
        "column",
        F.col("n_ref"),
        F.col("n_cur"),
        F.array_max("_gaps").alias("ks"),
        F.aggregate(areas, F.lit(0.0), lambda s, x: s + x).alias("wasserstein"),
        F.col("std_ref").alias("ref_std"),
        error.alias("_error"),
        (F.greatest("high_ref", "high_cur") - F.least("low_ref", "low_cur")).alias("_range"),
    )
    found = column_drift(distances, method, wasserstein_threshold)
    band = F.when(F.col("method") == "ks", F.col("_error")).otherwise(F.col("_error") * F.col("_range") / F.greatest(F.col("ref_std"), F.lit(MIN_SCALE)))
    found = found.withColumn("band", band).drop("_error", "_range")
    return found.withColumn("certain", F.abs(F.col("score") - F.col("threshold")) > F.col("band"))


def detect_drift_from_sketches(
    reference: DataFrame,
    current: DataFrame,
    exact: Callable[[Sequence[str]], DataFrame],
    method: str = "auto",
    share: float = 0.5,
    min_current_rows: int = 10,
    k: int = SKETCH_K,
) -> DataFrame:
    """The verdict of ``detect_drift`` from stored sketches.

    ``exact`` gives the exact distances of some columns, from ``drift_distances``. It is asked
    only for those whose band holds the threshold, so that mostly no row is read again.
    """
    found = stored(sketched_drift(reference, current, method, k=k), "sketched-drift")
    open_columns = [r["column"] for r in found.filter(~F.col("certain")).select("column").collect()]  # monitored columns at most
    verdicts = found.filter("certain").select("drifted", "n_cur")
    if open_columns:
        verdicts = verdicts.unionByName(column_drift(exact(open_columns), method).select("drifted", "n_cur"))
    return dataset_drift(verdicts, share, min_current_rows)


def detect_drift(
    reference: DataFrame,
    current: DataFrame,
    columns: Sequence[str] = ("rating", "ts"),
    method: str = "auto",
    share: float = 0.5,
    min_current_rows: int = 10,
) -> DataFrame:
    return dataset_drift(column_drift(drift_distances(reference, current, columns), method), share, min_current_rows)
