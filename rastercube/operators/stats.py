"""Temporal means and the train-only statistics of bands."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegralType

from rastercube.functions.scalar import MIN_STD, gap_fraction, guarded_std, population_std

#: The largest whole number whose square has 63 bits.
MAX_ROOT = 3_037_000_499


class StatsError(ValueError):
    pass


def temporal_mean(cube: DataFrame, bands: list[str]) -> DataFrame:
    """row, col and the mean over months of each band; null where a pixel has no value."""
    return cube.groupBy("row", "col").agg(*[F.avg(F.col(b).cast("double")).alias(b) for b in bands])


def pixel_sums(values: DataFrame, bands: list[str]) -> DataFrame:
    """row, col and for each band over its months the count n, sum t, and sum of squares q + r.

    Whole numbers are summed as decimals, so no digit is lost and the order does not matter;
    only of their squares those beyond 63 bits go as doubles, into r.
    """
    parts: list[Column] = []
    for b in bands:
        x = F.col(b).cast("double")
        total, squares, rest = F.sum(x), F.sum(x * x), F.lit(0.0)
        if isinstance(values.schema[b].dataType, IntegralType):
            whole = F.col(b).cast("long")
            small = whole.between(-MAX_ROOT, MAX_ROOT)
            total, squares = (F.sum(v.cast("decimal(19,0)")) for v in (whole, F.when(small, whole * whole)))
            rest = F.sum(F.when(~small, x * x))
        parts += [F.count(b).alias(f"{b}_n"), total.alias(f"{b}_t"), squares.alias(f"{b}_q"), rest.alias(f"{b}_r")]
    return values.groupBy("row", "col").agg(*parts)


def _as_double(sums: DataFrame, name: str) -> Column:
    """A sum as a double; a decimal by its low 64 bits and the rest, as SQL engines cast whole numbers of 128 bits."""
    x = F.col(name)
    if not isinstance(sums.schema[name].dataType, DecimalType):
        return x
    low = x % F.lit(Decimal(2**64))
    return low.cast("double") + (x - low).cast("double")


def weighted_sums(weight: DataFrame, *parts: tuple[DataFrame, list[str], int]) -> DataFrame:
    """One row a band: channel, n, n_max, total, squares, each pixel counted w times.

    weight: row, col, w. Each part is (values by row, col, its bands, months that a pixel can
    have). Values are summed by pixel first, before the shuffle, so what meets the weights is a
    row a pixel; a pixel in k accepted tiles counts k times without being multiplied.
    """
    rows = weight
    for values, bands, _ in parts:
        rows = rows.join(pixel_sums(values, bands), ["row", "col"], "left")
    sums = [F.sum(F.coalesce(f"{b}_{k}", F.lit(0)) * F.col("w")).alias(f"{b}_{k}") for _, bands, _ in parts for b in bands for k in "ntqr"]
    one = rows.agg(F.sum("w").alias("_w"), *sums)
    stack = [F.struct(F.lit(b).alias("channel"), F.coalesce(f"{b}_n", F.lit(0)).cast("long").alias("n"), (F.coalesce("_w", F.lit(0)) * months).cast("long").alias("n_max"), _as_double(one, f"{b}_t").alias("total"), (_as_double(one, f"{b}_q") + F.col(f"{b}_r")).alias("squares")) for _, bands, months in parts for b in bands]
    return one.select(F.explode(F.array(*stack)).alias("s")).select("s.*")


def band_stats(sums: DataFrame, max_gap: float = 0.10) -> DataFrame:
    """channel, n, n_max, mean, std, fill, gap_fraction, degenerate, over_gap of weighted_sums().

    The fill is the mean; a standard deviation of next to nothing becomes 1 and marks the
    channel. A band without values has no mean.
    """
    n = F.nullif(F.col("n"), F.lit(0))
    rows = sums.withColumn("_std", population_std(n, F.col("total"), F.col("squares")))
    mean, gap = F.col("total") / n, gap_fraction(F.col("n"), F.nullif(F.col("n_max"), F.lit(0)))
    return rows.select("channel", "n", "n_max", mean.alias("mean"), guarded_std(F.col("_std")).alias("std"), mean.alias("fill"), gap.alias("gap_fraction"), (F.col("_std") <= MIN_STD).alias("degenerate"), (gap > max_gap).alias("over_gap"))


def train_stats(cube: DataFrame, terrain: DataFrame, weight: DataFrame, dynamic: list[str], static: list[str], months: int, max_gap: float = 0.10) -> DataFrame:
    """band_stats() of dynamic bands over the cube's months and of static bands over the terrain means."""
    parts = [(cube, dynamic, months)] * bool(dynamic) + [(terrain, static, 1)] * bool(static)
    return band_stats(weighted_sums(weight, *parts), max_gap)


def require_stats(stats: DataFrame) -> DataFrame:
    empty = [r["channel"] for r in stats.filter("n = 0").select("channel").collect()]
    if empty:
        raise StatsError(f"no valid train pixel in {empty}")
    return stats
