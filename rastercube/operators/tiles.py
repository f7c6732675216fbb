"""Overlapping square tiles, the purity rule, and patch records."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rastercube.functions.scalar import SPLITS, covering_starts, needed, purity


class PatchError(ValueError):
    pass


def cover(pixel: DataFrame, height: int, width: int, size: int, stride: int) -> DataFrame:
    """Each pixel once for each tile that covers it: adds row_off, col_off.

    The range join of tiles and pixels as arithmetic: a pixel's few tiles follow from its
    position, and what comes next is an equi-group on (row_off, col_off).
    """
    rows = pixel.withColumn("row_off", F.explode(covering_starts(F.col("row"), height, size, stride)))
    return rows.withColumn("col_off", F.explode(covering_starts(F.col("col"), width, size, stride)))


def tile_counts(pixel: DataFrame, height: int, width: int, size: int, stride: int) -> DataFrame:
    """row_off, col_off, n_train, n_val, n_test of every candidate tile."""
    counted = [F.count_if(F.col("split_id") == i).alias(f"n_{name}") for name, i in SPLITS.items()]
    return cover(pixel, height, width, size, stride).groupBy("row_off", "col_off").agg(*counted)


def assign(tiles: DataFrame, size: int, threshold: float) -> DataFrame:
    """Adds split: the one whose pixels reach the threshold, null if none; an error if several do."""
    least = needed(threshold, size)
    reached = sum((F.col(f"n_{s}") >= least).cast("int") for s in SPLITS)
    winner = F.coalesce(*[F.when(F.col(f"n_{s}") >= least, F.lit(s)) for s in SPLITS])
    return tiles.withColumn("split", F.when(reached > 1, F.raise_error(F.lit("a tile is pure in two splits")).cast("string")).otherwise(winner))


def patches(assigned: DataFrame, size: int) -> DataFrame:
    """Patch records of the accepted tiles, numbered in row-major order (hundreds of rows: one window)."""
    accepted = assigned.filter("split is not null")
    number = F.row_number().over(Window.orderBy("row_off", "col_off")) - 1
    own = F.greatest(*[F.when(F.col("split") == s, F.col(f"n_{s}")) for s in SPLITS])
    return accepted.select(number.cast("int").alias("patch_id"), "split", "row_off", "col_off", F.lit(size).alias("height"), F.lit(size).alias("width"), purity(own, size).alias("purity"), *[F.col(f"n_{s}") for s in SPLITS])


def summary(assigned: DataFrame, size: int) -> DataFrame:
    """One row: candidates, accepted, rejected, their share, and the best purity of the rejected."""
    best = F.greatest(*[F.col(f"n_{s}") for s in SPLITS])
    out = F.col("split").isNull()
    rejected = assigned.agg(F.count("*").alias("candidates"), F.count("split").alias("accepted"), F.count_if(out).alias("rejected"), *[f(F.when(out, best)).alias(n) for n, f in (("lo", F.min), ("hi", F.max), ("total", F.sum))])
    area = float(size * size)
    return rejected.select("candidates", "accepted", "rejected", (F.col("rejected") / F.col("candidates")).alias("rejected_fraction"), (F.col("lo") / area).alias("purity_min"), (F.col("hi") / area).alias("purity_max"), (F.col("total") / (F.col("rejected") * area)).alias("purity_mean"))


def require_patches(patch: DataFrame) -> None:
    if patch.isEmpty():
        raise PatchError("no tile is pure enough")


def by_split(df: DataFrame, out: str = "n") -> DataFrame:
    """split and a count, with a row for each split whether there are any or not."""
    names = df.sparkSession.createDataFrame([(s,) for s in SPLITS], "split string")
    return names.join(df.groupBy("split").agg(F.count("*").alias("_n")), "split", "left").select("split", F.coalesce("_n", F.lit(0)).cast("long").alias(out))


def weights(pixel: DataFrame, patch: DataFrame, height: int, width: int, size: int, stride: int, split: str = "train") -> DataFrame:
    """row, col, w: in how many accepted tiles of a split a pixel of that split lies."""
    own = patch.filter(F.col("split") == split).select("row_off", "col_off")
    covered = cover(pixel.filter(F.col("split_id") == SPLITS[split]).select("row", "col"), height, width, size, stride)
    return covered.join(own, ["row_off", "col_off"], "left_semi").groupBy("row", "col").agg(F.count("*").alias("w"))
