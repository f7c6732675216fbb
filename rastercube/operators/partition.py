"""Pixels, polygons and the directional-quantile split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rastercube.functions.projection import utm, utm_zone
from rastercube.functions.scalar import OUTSIDE, SPLITS, TEST, TRAIN, VAL, pixel_centre, rotated


class SplitError(ValueError):
    pass


def pixels(spark: SparkSession, height: int, width: int) -> DataFrame:
    """row, col of every pixel of a grid."""
    return spark.range(height * width).select(F.expr(f"cast(id div {width} as int)").alias("row"), (F.col("id") % width).cast("int").alias("col"))


def quantile(df: DataFrame, value: Column, p: float, bins: int = 4096) -> DataFrame:
    """One row, ``q``: the exact quantile by linear interpolation; null if there are no values.

    Distinct values are counted, their counts summed in bins of equal width, and only the
    values of the bins that hold the two ranks meet in one task: about 1 / bins of them, also
    where every pixel has a value of its own (a rotated axis).
    """
    counts = df.select(value.cast("double").alias("v")).filter("v is not null").groupBy("v").agg(F.count("*").alias("n"))
    low, high = counts.agg(F.min("v")).scalar(), counts.agg(F.max("v")).scalar()
    at = F.least(F.floor((F.col("v") - low) / (high - low) * bins), F.lit(bins - 1))
    counts = counts.withColumn("b", F.coalesce(F.when(high > low, at), F.lit(0)).cast("int"))
    one = Window.partitionBy()  # a row a bin
    upto = one.orderBy("b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    table = counts.groupBy("b").agg(F.sum("n").alias("_s")).withColumn("_end", F.sum("_s").over(upto))
    rank = p * (F.sum("_s").over(one) - 1)
    held = table.withColumn("_rank", rank).filter((F.col("_end") - F.col("_s") <= F.ceil("_rank")) & (F.col("_end") > F.floor("_rank")))
    held = held.select(F.col("b").alias("_b"), "_rank", (F.col("_end") - F.col("_s")).alias("_before"))
    rows = counts.join(F.broadcast(held), F.col("b") == F.col("_b"))  # at most as many rows as bins
    inside = Window.partitionBy("_b").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("_last", F.col("_before") + F.sum("n").over(inside) - 1)
    pick = lambda f: F.min(F.when(F.col("_last") >= f("_rank"), F.col("v")))
    ends = rows.agg(pick(F.floor).alias("a"), pick(F.ceil).alias("z"), F.max(F.col("_rank") - F.floor("_rank")).alias("_t"))
    return ends.select(((1 - F.col("_t")) * F.col("a") + F.col("_t") * F.col("z")).alias("q"))


def directional_split(pixel: DataFrame, test: float, val: float, degrees: float = 0.0) -> DataFrame:
    """Adds split_id: TEST is the part of the region that lies furthest along the axis, VAL of
    what is left the part furthest across it, TRAIN all else, OUTSIDE what is not in the region.

    pixel: in_region, x, y. val is a share of the whole region. A value that equals a cut is
    beyond it. The cuts are scalar sub-queries: no job runs while the plan is made. A region
    without pixels is an error when the split is asked for.
    """
    across, along = rotated(F.col("x"), F.col("y"), degrees)
    rows = pixel.withColumn("_across", across).withColumn("_along", along)
    region = rows.filter("in_region")
    first = quantile(region, F.col("_along"), 1 - test).scalar()
    second = quantile(region.filter(F.col("_along") < first), F.col("_across"), 1 - val / (1 - test)).scalar()
    split = F.when(~F.col("in_region"), OUTSIDE).when(F.col("_along") >= first, TEST).when(F.col("_across") >= second, VAL).otherwise(TRAIN)
    none = F.raise_error(F.lit("the region has no pixels")).cast("int")
    return rows.withColumn("split_id", F.when(first.isNull(), none).otherwise(split.cast("int"))).drop("_across", "_along")


def split_counts(pixel: DataFrame, pixel_area: float = 1.0) -> DataFrame:
    """split, pixels, percent of the region and area; the three splits always have a row."""
    spark = pixel.sparkSession
    names = spark.createDataFrame([(k, v) for k, v in SPLITS.items()], "split string, split_id int")
    counts = pixel.filter(F.col("split_id") != OUTSIDE).groupBy("split_id").agg(F.count("*").alias("n"))
    total = pixel.filter(F.col("split_id") != OUTSIDE).agg(F.count("*")).scalar()
    n = F.coalesce("n", F.lit(0))
    return names.join(counts, "split_id", "left").select("split", n.cast("long").alias("pixels"), (n * 100.0 / total).alias("percent"), (n * pixel_area).alias("area"))


def require_pixels(pixel: DataFrame, least: int) -> None:
    few = {r["split"]: r["pixels"] for r in split_counts(pixel).collect() if r["pixels"] < least}
    if few:
        raise SplitError(f"fewer than {least} pixels in {few}")


def require_region(pixel: DataFrame) -> None:
    if pixel.filter("in_region").isEmpty():
        raise SplitError("the region has no pixels")


def edges(spark: SparkSession, polygons: list[list[list[tuple[float, float]]]]) -> DataFrame:
    """poly, x1, y1, x2, y2 of the rings of some polygons (each a list of rings of points)."""
    rows = [(i, float(a[0]), float(a[1]), float(b[0]), float(b[1])) for i, rings in enumerate(polygons) for ring in rings for a, b in zip(ring, ring[1:] + ring[:1], strict=True)]
    if not rows:
        raise SplitError("the boundary has no polygons")
    return spark.createDataFrame(rows, "poly int, x1 double, y1 double, x2 double, y2 double")


def geojson_edges(spark: SparkSession, path: str, crs: str | None = None) -> DataFrame:
    """edges() of the Polygon and MultiPolygon features of a GeoJSON file; of none, an error.

    The format's coordinates are WGS 84 degrees, unless the file names another system; with
    ``crs``, they are projected to it.
    """
    kind = "crs struct<properties: struct<name: string>>, features array<struct<geometry: struct<type: string, coordinates: string>>>"
    document = spark.read.option("multiLine", "true").schema(kind).json(path)
    geometry = document.select(F.posexplode("features").alias("poly", "f")).select("poly", "f.geometry.*").filter(F.col("type").isin("Polygon", "MultiPolygon"))
    if geometry.isEmpty():
        raise SplitError(f"no polygons in {path}")
    rings = "array<array<array<double>>>"
    many = F.when(F.col("type") == "Polygon", F.array(F.from_json("coordinates", rings))).otherwise(F.from_json("coordinates", f"array<{rings}>"))
    ring = geometry.withColumn("part", F.explode(many)).withColumn("ring", F.explode("part"))
    side = F.explode(F.expr("transform(sequence(0, size(ring) - 2), i -> struct(ring[i] as a, ring[i + 1] as b))"))
    edge = ring.withColumn("s", side).select("poly", *[F.col(f"s.{p}")[k].alias(f"{n}{i}") for i, p in ((1, "a"), (2, "b")) for k, n in ((0, "x"), (1, "y"))])
    if crs is None:
        return edge
    name = document.select("crs.properties.name").first()[0]
    code = name.rsplit(":", 1)[-1] if name else "4326"
    return project(edge, crs, "EPSG:4326" if code == "CRS84" else f"EPSG:{code}")


def project(edge: DataFrame, crs: str, source: str = "EPSG:4326") -> DataFrame:
    """Edges in the coordinates of a grid; only WGS 84 degrees to a UTM zone are known, and equal systems."""
    if crs == source:
        return edge
    if source != "EPSG:4326" or not (zone := utm_zone(crs)):
        raise SplitError(f"no way from {source} to {crs}")
    ends = {}
    for i in (1, 2):
        ends[f"x{i}"], ends[f"y{i}"] = utm(F.col(f"x{i}"), F.col(f"y{i}"), *zone)
    return edge.select("poly", *[c.alias(n) for n, c in ends.items()])


def crossings(edge: DataFrame, transform: tuple[float, ...], height: int) -> DataFrame:
    """row, poly and the sorted x at which a polygon's edges cross the row's centre line (half-open: y1 <= y < y2).

    An edge names the rows between its ends by arithmetic, so rows and edges never meet.
    """
    e, f = transform[4], transform[5]
    lo, hi = F.least("y1", "y2"), F.greatest("y1", "y2")
    a, b = (lo, hi) if e > 0 else (hi, lo)
    first = F.greatest(F.floor((a - f) / e - 0.5) - 1, F.lit(0))
    last = F.least(F.ceil((b - f) / e - 0.5) + 1, F.lit(height - 1))
    rows = edge.withColumn("row", F.explode(F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))))
    _, y = pixel_centre(F.col("row"), F.lit(0), transform)
    rows = rows.withColumn("_y", y).filter((lo <= F.col("_y")) & (F.col("_y") < hi))
    x = F.col("x1") + (F.col("_y") - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))
    return rows.select(F.col("row").cast("int").alias("row"), "poly", x.alias("c")).groupBy("row", "poly").agg(F.sort_array(F.collect_list("c")).alias("c"))


def rasterize(pixel: DataFrame, edge: DataFrame, transform: tuple[float, ...], height: int) -> DataFrame:
    """Adds inside: whether a pixel's centre (row, x) lies in any polygon, by the even-odd rule.

    Rings that cross themselves count by the same rule, which is this engine's repair of
    invalid polygons: a part that a ring encloses twice is outside, where a repair by
    noding may keep it. Each row has a short list of crossings a polygon, and a pixel counts
    those to its right.
    """
    spans = crossings(edge, transform, height).groupBy("row").agg(F.collect_list("c").alias("_polys"))
    odd = F.expr("exists(_polys, p -> size(filter(p, c -> c > x)) % 2 = 1)")
    return pixel.join(spans, "row", "left").withColumn("inside", F.coalesce(odd, F.lit(False))).drop("_polys")
