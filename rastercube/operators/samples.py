"""Lazy reconstruction of samples: window scan, static override, fill, normalisation, validity mask."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rastercube.functions.scalar import filled, zscore


def window_scan(cube: DataFrame, row_off: int, col_off: int, size: int, bands: list[str] | None = None, month: int | None = None) -> DataFrame:
    """One tile of the cube: ranges of row and col that reach the scan, and only the bands asked for."""
    rows = cube.filter(F.col("row").between(row_off, row_off + size - 1) & F.col("col").between(col_off, col_off + size - 1))
    if month is not None:
        rows = rows.filter(F.col("month_idx") == month)
    return rows if bands is None else rows.select("month_idx", "row", "col", *bands)


def static_override(cube: DataFrame, terrain: DataFrame, static: list[str]) -> DataFrame:
    """The cube with its static bands replaced by their temporal means, by name."""
    means = terrain.select(F.col("row").alias("_r"), F.col("col").alias("_c"), *[F.col(b).alias(f"_{b}") for b in static])
    rows = cube.join(means, (cube["row"] == means["_r"]) & (cube["col"] == means["_c"]), "left")
    return rows.select(*[F.col(f"_{c}").alias(c) if c in static else cube[c] for c in cube.columns])


def normalised(values: DataFrame, stats: DataFrame, value: str = "value") -> DataFrame:
    """Long rows (channel, value, ...) with filled and z; stats (a row a band) is broadcast."""
    rows = values.join(F.broadcast(stats.select("channel", "fill", "mean", "std")), "channel")
    rows = rows.withColumn("filled", filled(F.col(value), F.col("fill")))
    return rows.withColumn("z", zscore(F.col("filled"), F.col("mean"), F.col("std"))).drop("fill", "mean", "std")


def melt(cube: DataFrame, bands: list[str]) -> DataFrame:
    """Wide to long: month_idx, row, col, channel_idx, channel, value."""
    parts = F.array(*[F.struct(F.lit(i).alias("channel_idx"), F.lit(b).alias("channel"), F.col(b).cast("double").alias("value")) for i, b in enumerate(bands)])
    return cube.select("month_idx", "row", "col", F.explode(parts).alias("s")).select("month_idx", "row", "col", "s.*")


def dense(cube: DataFrame, pixel: DataFrame, months: DataFrame) -> DataFrame:
    """The cube with a row for every pixel and month; what was absent is null.

    months: month_idx. A pixel explodes into the months (an array of a catalogue's size), so
    there is no cross join.
    """
    every = months.agg(F.sort_array(F.collect_list("month_idx")).alias("m"))
    grid = pixel.select("row", "col").withColumn("month_idx", F.explode(every.scalar()))
    return grid.join(cube, ["row", "col", "month_idx"], "left")


def tile_planes(sample: DataFrame, cube: DataFrame, terrain: DataFrame, stats: DataFrame, bands: list[str], static: list[str]) -> DataFrame:
    """row_off, col_off, month_idx, channel_idx, channel and cells (i, j, z in row-major order) of every tile that samples use.

    The cube is normalised once, a cell at a time; then a plane is put together once a tile,
    month and band, however many samples read it.
    """
    tiles = sample.select("row_off", "col_off", "height", "width").distinct()
    cell = F.explode(F.expr("flatten(transform(sequence(0, height - 1), i -> transform(sequence(0, width - 1), j -> struct(row_off + i as row, col_off + j as col, i as i, j as j))))"))
    place = tiles.select("row_off", "col_off", cell.alias("p")).select("row_off", "col_off", "p.*")
    rows = normalised(melt(static_override(cube, terrain, static) if static else cube, bands), stats)
    inside = place.join(rows, ["row", "col"])
    cells = F.array_sort(F.collect_list(F.struct("i", "j", "z"))).alias("cells")
    return inside.groupBy("row_off", "col_off", "month_idx", "channel_idx", "channel").agg(cells)


def sample_planes(sample: DataFrame, cube: DataFrame, terrain: DataFrame, stats: DataFrame, bands: list[str], static: list[str]) -> DataFrame:
    """sample_id, t, channel_idx, channel, cells: tile_planes() dealt out to the samples by an equi-join on tile and month."""
    wanted = sample.select("sample_id", "row_off", "col_off", F.posexplode("input_month_indices").alias("t", "month_idx"))
    planes = tile_planes(sample, cube, terrain, stats, bands, static)
    return planes.join(wanted, ["row_off", "col_off", "month_idx"]).select("sample_id", "t", "channel_idx", "channel", "cells")


def sample_values(sample: DataFrame, cube: DataFrame, terrain: DataFrame, stats: DataFrame, bands: list[str], static: list[str]) -> DataFrame:
    """X in long form: sample_id, t, channel_idx, channel, i, j, z."""
    return sample_planes(sample, cube, terrain, stats, bands, static).select("sample_id", "t", "channel_idx", "channel", F.inline("cells"))


def targets(sample: DataFrame, cube: DataFrame, stats: DataFrame, band: str) -> DataFrame:
    """y and mask in long form: sample_id, i, j, y, mask; mask says the raw value was there, before the fill."""
    cell = F.explode(F.expr("flatten(transform(sequence(0, height - 1), i -> transform(sequence(0, width - 1), j -> struct(row_off + i as row, col_off + j as col, i as i, j as j))))"))
    place = sample.select("sample_id", F.col("target_month_index").alias("month_idx"), cell.alias("p")).select("sample_id", "month_idx", "p.*")
    raw = place.join(cube.select("row", "col", "month_idx", F.col(band).cast("double").alias("value")), ["row", "col", "month_idx"], "left").withColumn("channel", F.lit(band))
    return normalised(raw, stats).select("sample_id", "i", "j", F.col("z").alias("y"), F.col("value").isNotNull().alias("mask"))


def tensors(planes: DataFrame) -> DataFrame:
    """sample_id, t, channel_idx and a plane's values in row-major order, of sample_planes()."""
    return planes.select("sample_id", "t", "channel_idx", F.col("cells.z").alias("values"))
