"""Contrast and error metrics, temporal interpolation, histograms and validation reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def island_contrast(values: DataFrame, value: str = "value") -> DataFrame:
    """One row: mean over urban, mean over rural, and their difference."""
    rows = values.agg(F.avg(F.when(F.col("is_urban"), F.col(value))).alias("urban_mean"), F.avg(F.when(F.col("is_rural"), F.col(value))).alias("rural_mean"))
    return rows.withColumn("contrast", F.col("urban_mean") - F.col("rural_mean"))


def contrast_map(values: DataFrame, value: str = "value") -> DataFrame:
    """Adds ``excess``: the value less the mean over rural cells (a scalar subquery)."""
    rural = values.filter("is_rural").agg(F.avg(value)).scalar()
    return values.withColumn("excess", F.col(value) - rural)


def difference(baseline: DataFrame, scenario: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """Keys and scenario - baseline where both have a value."""
    b = baseline.select(*keys, F.col(value).alias("_b"))
    return scenario.select(*keys, F.col(value).alias("_s")).join(b, keys).select(*keys, (F.col("_s") - F.col("_b")).alias("delta"))


def errors(pairs: DataFrame, truth: str = "truth", predicted: str = "predicted", mask: Column | None = None) -> DataFrame:
    """One row: n, mae, rmse, r2 over the pairs that the mask leaves."""
    rows = pairs.filter(mask) if mask is not None else pairs
    rows = rows.filter(F.col(truth).isNotNull() & F.col(predicted).isNotNull())
    e = F.col(predicted) - F.col(truth)
    s = rows.agg(F.count("*").alias("n"), F.sum(F.abs(e)).alias("a"), F.sum(e * e).alias("q"), F.sum(truth).alias("t"), F.sum(F.col(truth) * F.col(truth)).alias("tt"))
    spread = F.col("tt") - F.col("t") * F.col("t") / F.col("n")
    return s.select("n", (F.col("a") / F.col("n")).alias("mae"), F.sqrt(F.col("q") / F.col("n")).alias("rmse"), (1.0 - F.try_divide(F.col("q").cast("double"), spread.cast("double"))).alias("r2"))


def interpolate(cube: DataFrame, value: str, max_gap: int = 12) -> DataFrame:
    """Adds ``filled``: linear in time between a pixel's neighbouring values, at most max_gap missing months.

    cube: dense (a row for each pixel and month). Ends are not extrapolated; what is there stays.
    """
    series = Window.partitionBy("row", "col").orderBy("month_idx")
    known = F.when(F.col(value).isNotNull(), F.struct(F.col("month_idx").alias("m"), F.col(value).cast("double").alias("v")))
    rows = cube.withColumn("_a", F.last(known, ignorenulls=True).over(series.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    rows = rows.withColumn("_b", F.first(known, ignorenulls=True).over(series.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
    gap = F.col("_b.m") - F.col("_a.m")
    line = F.col("_a.v") + (F.col("_b.v") - F.col("_a.v")) * (F.col("month_idx") - F.col("_a.m")) / gap
    fill = F.when(F.col(value).isNotNull(), F.col(value).cast("double")).when((gap > 0) & (gap - 1 <= max_gap), line)
    return rows.withColumn("filled", fill).drop("_a", "_b")


def histogram(values: DataFrame, value: str, bins: int) -> DataFrame:
    """bin (0 to bins - 1) and n of equal-width bins from the least to the greatest value, both included.

    Every value that is not null is in some bin; if all are equal, in the first.
    """
    rows = values.filter(F.col(value).isNotNull())
    low, high = rows.agg(F.min(value)).scalar(), rows.agg(F.max(value)).scalar()
    at = F.least(F.floor((F.col(value) - low) / ((high - low) / bins)), F.lit(bins - 1))
    return rows.groupBy(F.coalesce(F.when(high > low, at), F.lit(0)).cast("int").alias("bin")).agg(F.count("*").alias("n"))


def max_abs_difference(a: DataFrame, b: DataFrame, keys: list[str], value: str) -> DataFrame:
    """One row: compared, max_abs_diff, one_sided (values that only one side has)."""
    left, right = a.select(*keys, F.col(value).alias("_a")), b.select(*keys, F.col(value).alias("_b"))
    rows = left.join(right, keys, "full")
    return rows.agg(F.count_if(F.col("_a").isNotNull() & F.col("_b").isNotNull()).alias("compared"), F.max(F.abs(F.col("_a") - F.col("_b"))).alias("max_abs_diff"), F.count_if(F.col("_a").isNull() != F.col("_b").isNull()).alias("one_sided"))


def missingness(values: DataFrame, value: str) -> DataFrame:
    """One row: rows, missing, and how many are NaN or infinite."""
    x = F.col(value).cast("double")
    return values.agg(F.count("*").alias("rows"), F.count_if(x.isNull()).alias("missing"), F.count_if(F.isnan(x)).alias("nan"), F.count_if(F.abs(x) == float("inf")).alias("infinite"))


def no_leak(covered: DataFrame, patch: DataFrame, splits: dict[str, int]) -> DataFrame:
    """split, pixels, foreign: of the pixels of accepted tiles, how many belong to another split.

    covered: tiles.cover() of the pixels with split_id.
    """
    own = F.element_at(F.create_map(*[F.lit(x) for kv in splits.items() for x in kv]), F.col("split"))
    rows = covered.join(patch.select("row_off", "col_off", "split"), ["row_off", "col_off"])
    return rows.groupBy("split").agg(F.count("*").alias("pixels"), F.count_if((F.col("split_id") != own) & (F.col("split_id") != 0)).alias("foreign"))


def profile(pixel: DataFrame, height: int, width: int) -> DataFrame:
    """axis, at, split_id along the middle row and the middle column."""
    mid = pixel.filter(F.col("row") == height // 2).select(F.lit("row").alias("axis"), F.col("col").alias("at"), "split_id")
    return mid.unionByName(pixel.filter(F.col("col") == width // 2).select(F.lit("col").alias("axis"), F.col("row").alias("at"), "split_id"))
