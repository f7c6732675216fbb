"""Month catalogue: discovery from file names, guards, and the tables behind them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rastercube.functions.scalar import month_label

#: Monthly rasters have this in their name, and YEAR_MONTH in the name's stem.
FILE_MARK = "18features"
MONTH_PATTERN = r"(\d{4})_(\d{2})"


class CatalogError(ValueError):
    pass


def list_files(spark: SparkSession, folder: str, pattern: str = f"*{FILE_MARK}*.tif") -> DataFrame:
    """path of every monthly raster under a folder; contents are not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder).select("path")


def discover(paths: DataFrame) -> DataFrame:
    """path, year, month of every file whose name has the mark; null where it names no month."""
    name = F.element_at(F.split("path", "/"), -1)
    stem = F.regexp_replace(name, r"\.[^.]*$", "")
    part = lambda k: F.when(stem.rlike(MONTH_PATTERN), F.regexp_extract(stem, MONTH_PATTERN, k).cast("int"))
    return paths.filter(F.contains(name, F.lit(FILE_MARK)) & name.endswith(".tif")).select("path", part(1).alias("year"), part(2).alias("month"))


def duplicates(found: DataFrame) -> DataFrame:
    return found.groupBy("year", "month").agg(F.count("*").alias("files")).filter("files > 1")


def with_index(found: DataFrame) -> DataFrame:
    """Adds month_idx (0 for the first month there is, one up for each that follows) and label.

    The window has one row a file of a month: a catalogue, not data.
    """
    order = F.row_number().over(Window.orderBy("year", "month")) - 1
    return found.select(order.cast("int").alias("month_idx"), "year", "month", month_label(F.col("year"), F.col("month")).alias("label"), "path")


def calendar(found: DataFrame) -> DataFrame:
    """Every month from the first to the last that was found, as year, month and label."""
    m = F.col("year") * 12 + F.col("month") - 1
    span = found.agg(F.min(m).alias("a"), F.max(m).alias("b")).filter("a is not null").select(F.explode(F.sequence("a", "b")).alias("m"))
    return span.select(F.floor(F.col("m") / 12).cast("int").alias("year"), (F.col("m") % 12 + 1).cast("int").alias("month")).withColumn("label", month_label(F.col("year"), F.col("month")))


def missing(found: DataFrame) -> DataFrame:
    return calendar(found).join(found.select("year", "month"), ["year", "month"], "left_anti").select("label")


def require_complete(found: DataFrame) -> DataFrame:
    """found with month_idx and label; raises if it is empty, or has unnamed, repeated or missing months."""
    if found.isEmpty():
        raise CatalogError("no monthly rasters found")
    unnamed = found.filter("year is null").limit(1).collect()
    if unnamed:
        raise CatalogError(f"no month in the file name {unnamed[0]['path']}")
    twice = duplicates(found).orderBy("year", "month").limit(5).collect()
    if twice:
        raise CatalogError(f"more than one file for {[(r['year'], r['month']) for r in twice]}")
    gaps = [r["label"] for r in missing(found).orderBy("label").limit(24).collect()]
    if gaps:
        raise CatalogError(f"missing months: {gaps}")
    return with_index(found)


GRID_FIELDS = ["width", "height", "count", "crs", "transform", "dtype", "descriptions"]


def rounded_transform(places: int = 10):
    return F.transform("transform", lambda x: F.round(x, places))


def grid_groups(metadata: DataFrame) -> DataFrame:
    """Distinct grids among files and how many have each; a clean catalogue has one row."""
    return metadata.withColumn("transform", rounded_transform()).groupBy(*GRID_FIELDS).agg(F.count("*").alias("files"))


def require_one_grid(metadata: DataFrame) -> dict:
    rows = grid_groups(metadata).orderBy(F.desc("files")).limit(2).collect()
    if not rows:
        raise CatalogError("no rasters to inspect")
    if len(rows) > 1:
        differing = [f for f in GRID_FIELDS if rows[0][f] != rows[1][f]]
        raise CatalogError(f"rasters differ in {differing}")
    return rows[0].asDict()


def require_channels(descriptions: list[str | None], expected: list[str]) -> None:
    if all(d is None for d in descriptions):
        raise CatalogError("the rasters name no bands")
    if list(descriptions) != list(expected):
        raise CatalogError(f"bands are {descriptions}, not {expected}")


def band_order(metadata: DataFrame, expected: list[str]) -> DataFrame:
    """Adds status: ok, unnamed (no band has a name) or differs."""
    unnamed = F.forall("descriptions", lambda x: x.isNull())
    same = F.col("descriptions").eqNullSafe(F.array(*[F.lit(x) for x in expected]))
    return metadata.withColumn("status", F.when(unnamed, "unnamed").when(same, "ok").otherwise("differs"))


def parse_legend(lines: DataFrame, fallback: dict[int, str], column: str = "line") -> DataFrame:
    """class, label of the lines "<digits> <label>"; the fallback if no line is one."""
    from rastercube.functions.scalar import legend_class, legend_label

    found = lines.select(legend_class(F.col(column)).alias("class"), legend_label(F.col(column)).alias("label")).filter("class is not null")
    if found.isEmpty():
        return lines.sparkSession.createDataFrame(sorted(fallback.items()), "class int, label string")
    return found


def legend(tags: DataFrame, fallback: dict[int, str]) -> DataFrame:
    """class, label, version and source of a raster's legend tag, from its tags (name, value).

    version is the tag algorithm_version, else product_version, else "unknown"; source is
    "tag", or "fallback" if the legend is absent or has no line of a class.
    """
    value = lambda name: F.max(F.when((F.col("name") == name) & (F.col("value") != ""), F.col("value")))
    one = tags.agg(value("legend").alias("legend"), F.coalesce(value("algorithm_version"), value("product_version"), F.lit("unknown")).alias("version")).first()
    lines = tags.sparkSession.createDataFrame([(x,) for x in (one["legend"] or "").splitlines()] or [("",)], "line string")
    from rastercube.functions.scalar import legend_class

    parsed = not lines.filter(legend_class(F.col("line")).isNotNull()).isEmpty()
    return parse_legend(lines, fallback).select("class", "label", F.lit(one["version"]).alias("version"), F.lit("tag" if parsed else "fallback").alias("source"))
