"""Land cover: majority resampling, urban and rural masks, the outward ring."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rastercube.functions.projection import utm, utm_zone
from rastercube.functions.scalar import pixel_centre

#: Classes that a rural mask retains, and the built-up class (values of the public land-cover legend).
RURAL = (10, 20, 30, 40, 60)
URBAN = 50


class MaskError(ValueError):
    pass


def vote(cells: DataFrame, nodata: int = 0) -> DataFrame:
    """row, col, class: the most frequent class among the rows of each cell.

    Nodata rows don't vote; of tied classes the lowest wins; a cell of nodata has no row.
    """
    rows = cells.filter(F.col("class").isNotNull() & (F.col("class") != nodata))
    votes = rows.groupBy("row", "col", "class").agg(F.count("*").alias("n"))
    best = F.max(F.struct("n", (-F.col("class")).alias("c")))
    return votes.groupBy("row", "col").agg((-best["c"]).alias("class"))


def majority(fine: DataFrame, factor: int, nodata: int = 0) -> DataFrame:
    """vote() of each factor x factor block of fine cells."""
    block = lambda c: F.floor(F.col(c) / factor).cast("int").alias(c)
    return vote(fine.select(block("row"), block("col"), "class"), nodata)


def align(fine: DataFrame, source: tuple[float, ...], transform: tuple[float, ...], height: int, width: int, source_crs: str | None = None, crs: str | None = None, nodata: int = 0) -> DataFrame:
    """row, col, class on a grid: vote() of the source cells whose centres lie in each of its cells.

    A centre goes through the source's transform, from WGS 84 degrees to a UTM zone where the
    systems differ, and through the inverse of the grid's, so source and grid meet by an
    equal key. Transforms have no shear. Where a resampler weighs cells by the area they
    share with a grid cell, this counts centres: an approximation where cells are cut.
    """
    x, y = pixel_centre(F.col("row"), F.col("col"), source)
    if source_crs != crs:
        zone = utm_zone(crs or "")
        if source_crs != "EPSG:4326" or not zone:
            raise MaskError(f"no way from {source_crs} to {crs}")
        x, y = utm(x, y, *zone)
    a, _, c, _, e, f = transform
    at = fine.select(F.floor((y - F.lit(f)) / e).cast("int").alias("row"), F.floor((x - F.lit(c)) / a).cast("int").alias("col"), "class")
    return vote(at.filter(F.col("row").between(0, height - 1) & F.col("col").between(0, width - 1)), nodata)


def urban(land: DataFrame, study: DataFrame | None = None, urban_class: int = URBAN) -> DataFrame:
    """row, col of the urban cells, inside the study area if there is one."""
    rows = land.filter(F.col("class") == urban_class).select("row", "col")
    return rows if study is None else rows.join(study.select("row", "col"), ["row", "col"], "left_semi")


def ring(cells: DataFrame, radius: float, height: int, width: int) -> DataFrame:
    """row, col of all grid cells at a distance of more than 0 and at most radius (in cells) from some cell.

    By interval dilation: runs of cells in a row become intervals; each interval, widened by
    floor(sqrt(r^2 - dy^2)), is sent to the rows dy away; overlapping intervals of a row
    are merged and laid out. No cell meets another cell.
    """
    reach = math.floor(radius)
    run = F.col("col") - F.row_number().over(Window.partitionBy("row").orderBy("col"))
    runs = cells.select("row", "col").distinct().withColumn("g", run).groupBy("row", "g").agg(F.min("col").alias("a"), F.max("col").alias("b"))
    widths = F.array(*[F.struct(F.lit(dy).alias("dy"), F.lit(math.floor(math.sqrt(radius * radius - dy * dy))).alias("w")) for dy in range(-reach, reach + 1)])
    spread = runs.withColumn("d", F.explode(widths)).select((F.col("row") + F.col("d.dy")).alias("row"), F.greatest(F.col("a") - F.col("d.w"), F.lit(0)).alias("a"), F.least(F.col("b") + F.col("d.w"), F.lit(width - 1)).alias("b"))
    spread = spread.filter(F.col("row").between(0, height - 1))
    order = Window.partitionBy("row").orderBy("a", "b")
    before = F.max("b").over(order.rowsBetween(Window.unboundedPreceding, -1))
    island = spread.withColumn("new", F.when(before.isNull() | (F.col("a") > before + 1), 1).otherwise(0)).withColumn("k", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    merged = island.groupBy("row", "k").agg(F.min("a").alias("a"), F.max("b").alias("b"))
    all_cells = merged.select(F.col("row").cast("int").alias("row"), F.explode(F.transform(F.sequence("a", "b"), lambda c: c.cast("int"))).alias("col"))
    return all_cells.join(cells.select("row", "col"), ["row", "col"], "left_anti")


def rural(land: DataFrame, around: DataFrame, study: DataFrame | None = None, classes: tuple[int, ...] = RURAL) -> DataFrame:
    """row, col of the ring's cells of a retained class, inside the study area if there is one."""
    rows = land.filter(F.col("class").isin(*classes)).join(around, ["row", "col"], "left_semi").select("row", "col")
    return rows if study is None else rows.join(study.select("row", "col"), ["row", "col"], "left_semi")


def mask_table(grid: DataFrame, urban_cells: DataFrame, rural_cells: DataFrame) -> DataFrame:
    """grid with is_urban and is_rural."""
    u = urban_cells.select("row", "col", F.lit(True).alias("_u")).distinct()
    r = rural_cells.select("row", "col", F.lit(True).alias("_r")).distinct()
    rows = grid.join(u, ["row", "col"], "left").join(r, ["row", "col"], "left")
    return rows.withColumn("is_urban", F.coalesce("_u", F.lit(False))).withColumn("is_rural", F.coalesce("_r", F.lit(False))).drop("_u", "_r")


def mask_report(masks: DataFrame, clipped: bool = True) -> DataFrame:
    """One row: counts, overlap, percentages of the study area (column in_study) and the verdict.

    Masks that are not clipped to the study area are percentages of all cells.
    """
    study = F.col("in_study")
    rows = masks.agg(F.count_if("is_urban").alias("urban"), F.count_if("is_rural").alias("rural"), F.count_if(study).alias("study"), F.count_if(F.col("is_urban") & F.col("is_rural")).alias("overlap"), F.count("*").alias("cells"))
    ratio = F.try_divide(F.col("urban").cast("double"), F.col("rural").cast("double"))
    base = F.col("study") if clipped else F.col("cells")
    share = lambda c: F.coalesce(F.try_divide(F.col(c) * 100.0, base), F.lit(0.0)).alias(f"{c}_pct")
    valid = (F.col("overlap") == 0) & (F.col("urban") > 0) & (F.col("rural") > 0)
    return rows.select("*", share("urban"), share("rural"), valid.alias("valid"), F.coalesce((ratio > 50) | (ratio < 1 / 50), F.lit(True)).alias("unbalanced"))


def ring_report(land: DataFrame, around: DataFrame, classes: tuple[int, ...] = RURAL) -> DataFrame:
    """One row: ring cells, and how many of them are dropped because their class is not retained (or unknown)."""
    rows = around.select("row", "col").join(land, ["row", "col"], "left")
    kept = F.coalesce(F.col("class").isin(*classes), F.lit(False))
    return rows.agg(F.count("*").alias("ring"), F.count_if(~kept).alias("dropped_by_class"))


def mask_findings(masks: DataFrame, land: DataFrame, known: list[int], height: int, width: int, clipped: bool = True) -> DataFrame:
    """level (error or warning), finding and detail of what is wrong with some masks; no rows if nothing is.

    masks: row, col, is_urban, is_rural (booleans, or numbers as read from a file), in_study.
    Errors: cells beyond the grid or not all of it, values other than 0 and 1, overlap, an empty
    mask. Warnings: classes that the legend lacks, very unequal masks.
    """
    number = {c: F.col(c).cast("double") for c in ("is_urban", "is_rural")}
    on = masks.select("row", "col", "in_study", *[(x == 1).alias(c) for c, x in number.items()], *[(~x.isin(0.0, 1.0) | x.isNull()).alias(f"_{c}") for c, x in number.items()])
    inside = F.col("row").between(0, height - 1) & F.col("col").between(0, width - 1)
    shape = on.agg(F.count("*").alias("cells"), F.count_if(~inside).alias("outside"), F.count_if("_is_urban").alias("bad_urban"), F.count_if("_is_rural").alias("bad_rural"))
    one = mask_report(on, clipped).drop("cells").join(shape, F.lit(True))  # one row each
    text = lambda *x: F.concat(*[F.lit(y) if isinstance(y, str) else y[0].cast("string") for y in x])
    c = F.col
    rules = [
        ("error", "shape", (c("cells") != height * width) | (c("outside") > 0), text([c("cells")], " cells, ", [c("outside")], f" beyond the {height} x {width} grid")),
        ("error", "overlap", c("overlap") > 0, text([c("overlap")], " cells are urban and rural")),
        ("error", "urban empty", c("urban") == 0, text("no urban cell")),
        ("error", "rural empty", c("rural") == 0, text("no rural cell")),
        ("error", "urban values", c("bad_urban") > 0, text([c("bad_urban")], " urban values are not 0 or 1")),
        ("error", "rural values", c("bad_rural") > 0, text([c("bad_rural")], " rural values are not 0 or 1")),
        ("warning", "unbalanced", (c("urban") > 0) & (c("rural") > 0) & c("unbalanced"), text("urban and rural differ more than fiftyfold")),
    ]
    stack = F.filter(F.array(*[F.struct(F.lit(a).alias("level"), F.lit(b).alias("finding"), when.alias("is"), d.alias("detail")) for a, b, when, d in rules]), lambda s: s["is"])
    found = one.select(F.inline(stack)).select("level", "finding", "detail")
    strange = unexpected_classes(land, known).select(F.lit("warning").alias("level"), F.lit("unknown class").alias("finding"), F.col("class").cast("string").alias("detail"))
    return found.unionByName(strange)


def legend_findings(legend: dict[int, str], resolution: tuple[float, float], urban_class: int = URBAN, classes: tuple[int, ...] = RURAL) -> list[str]:
    """Warnings about a legend: another cell size than 30, an urban class that isn't built-up, retained classes it lacks."""
    found = []
    if tuple(map(abs, resolution)) != (30.0, 30.0):
        found.append(f"cells measure {resolution[0]:g} x {abs(resolution[1]):g}, not 30 x 30")
    if "built" not in legend.get(urban_class, "").lower():
        found.append(f"class {urban_class} is called {legend.get(urban_class, 'nothing')!r}, not built-up")
    return found + [f"class {c} is not in the legend" for c in classes if c not in legend]


def unexpected_classes(land: DataFrame, known: list[int]) -> DataFrame:
    return land.select("class").distinct().filter(~F.col("class").isin(*known, 0))


def require_masks(report: DataFrame) -> None:
    r = report.first()
    if r["overlap"]:
        raise MaskError(f"{r['overlap']} cells are urban and rural")
    if not r["urban"] or not r["rural"]:
        raise MaskError("a mask is empty")
