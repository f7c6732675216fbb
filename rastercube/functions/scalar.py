"""Column expressions: months, finite values, scaling, pixel geometry, legend lines."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

TRAIN, VAL, TEST, OUTSIDE = 1, 2, 3, 0
SPLITS = {"train": TRAIN, "val": VAL, "test": TEST}
#: A standard deviation of this or less counts as none.
MIN_STD = 1e-8


def month_index(year: Column, month: Column, first_year: int, first_month: int = 1) -> Column:
    """Months since a first month."""
    return ((year - first_year) * 12 + (month - first_month)).cast("int")


def month_label(year: Column, month: Column) -> Column:
    return F.format_string("%04d-%02d", year.cast("int"), month.cast("int"))


def label_of_index(index: Column, first_year: int, first_month: int = 1) -> Column:
    months = index + (first_year * 12 + first_month - 1)
    return month_label(F.floor(months / 12), F.pmod(months, F.lit(12)) + 1)


def previous_label(label: Column) -> Column:
    """The label of the month before; January's is December of the year before."""
    months = F.substring(label, 1, 4).cast("int") * 12 + F.substring(label, 6, 2).cast("int") - 2
    return month_label(F.floor(months / 12), F.pmod(months, F.lit(12)) + 1)


def finite(x: Column) -> Column:
    """x, or null where it is NaN or infinite: to be applied once, where data come in."""
    x = x.cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) < F.lit(math.inf)), x)


def filled(x: Column, fill: Column) -> Column:
    return F.coalesce(x, fill)


def zscore(x: Column, mean: Column, std: Column) -> Column:
    return (x - mean) / std


def guarded_std(std: Column, least: float = MIN_STD) -> Column:
    return F.when(std <= least, F.lit(1.0)).otherwise(std)


def population_std(n: Column, total: Column, squares: Column) -> Column:
    """From sums: sqrt(E[x^2] - E[x]^2), never of a negative number."""
    mean = total / n
    return F.sqrt(F.greatest(squares / n - mean * mean, F.lit(0.0)))


def gap_fraction(n: Column, n_max: Column) -> Column:
    return F.lit(1.0) - n / n_max


def purity(count: Column, size: int) -> Column:
    """Share of a tile's pixels, rounded half to even at six places."""
    return F.bround(count / float(size * size), 6)


def needed(threshold: float, size: int) -> int:
    """Fewest pixels of one split that make a tile pure."""
    return math.ceil(threshold * size * size)


def pixel_centre(row: Column, col: Column, transform: tuple[float, float, float, float, float, float]) -> tuple[Column, Column]:
    """(x, y) of a pixel's centre; transform is affine (a, b, c, d, e, f) without shear."""
    a, _, c, _, e, f = transform
    return F.lit(c) + (col + 0.5) * a, F.lit(f) + (row + 0.5) * e


def rotated(x: Column, y: Column, degrees: float) -> tuple[Column, Column]:
    """(across, along): coordinates on axes turned by an angle."""
    cos, sin = math.cos(math.radians(degrees)), math.sin(math.radians(degrees))
    return x * cos - y * sin, y * cos + x * sin


def legend_class(line: Column) -> Column:
    """The class number of a legend line, null if it has none."""
    return F.when(F.trim(line).rlike(r"^\d+\s"), F.regexp_extract(F.trim(line), r"^(\d+)\s+(.*)$", 1).cast("int"))


def legend_label(line: Column) -> Column:
    return F.regexp_extract(F.trim(line), r"^(\d+)\s+(.*)$", 2)


def covering_starts(at: Column, length: int, size: int, stride: int) -> Column:
    """The tile starts whose tiles cover a row or column: the join key of tiles and pixels, by arithmetic."""
    last = length - size
    if last < 0:
        return F.array().cast("array<int>")
    low = F.greatest(F.lit(0), F.ceil((at - (size - 1)) / float(stride))).cast("int")
    high = F.least(F.floor(at / float(stride)), F.lit(last // stride)).cast("int")
    regular = F.when(low <= high, F.transform(F.sequence(low, high), lambda k: (k * stride).cast("int"))).otherwise(F.array().cast("array<int>"))
    return F.when(at >= last, F.array_union(regular, F.array(F.lit(last)))).otherwise(regular)
