"""The masks build: land cover, boundary and reference grid in; urban and rural masks, findings and metadata out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rastercube.functions.scalar import pixel_centre
from rastercube.operators import landcover, partition
from rastercube.sources import catalog, geotiff, sinks

#: Labels for land cover whose file has no legend (values of the public land-cover legend).
FALLBACK_LEGEND = {10: "Tree cover", 20: "Shrubland", 30: "Grassland", 40: "Cropland", 50: "Built-up", 60: "Bare / sparse vegetation", 70: "Snow and ice", 80: "Permanent water bodies", 90: "Herbaceous wetland", 95: "Mangroves", 100: "Moss and lichen"}


@dataclass(frozen=True)
class MaskConfig:
    """Paths of the inputs, where masks go, and how they are made."""

    land_cover: str
    boundary: str
    reference_grid: str
    output_dir: str
    buffer_metres: float = 5000.0
    urban_class: int = landcover.URBAN
    rural_classes: tuple[int, ...] = landcover.RURAL
    clip: bool = True
    overwrite: bool = False


@dataclass(frozen=True)
class Masks:
    """A finished masks build."""

    masks: DataFrame
    metadata: dict
    errors: list[str]
    warnings: list[str]


def _one_file(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def study_area(spark: SparkSession, boundary: str, grid: geotiff.Grid) -> DataFrame:
    """row, col, in_study of every cell of a grid: whether its centre lies inside the boundary's polygons."""
    cells = partition.pixels(spark, grid.height, grid.width)
    x, y = pixel_centre(F.col("row"), F.col("col"), grid.transform)
    inside = partition.rasterize(cells.withColumn("x", x).withColumn("y", y), partition.geojson_edges(spark, boundary, grid.crs), grid.transform, grid.height)
    return inside.select("row", "col", F.col("inside").alias("in_study"))


def build(spark: SparkSession, config: MaskConfig) -> Masks:
    """Make, check and write the masks; what is wrong with them is raised after they are written.

    The grid is that of the reference raster and is never resampled. Land cover comes onto it by
    majority; the urban mask is the built-up class, the rural one the retained classes
    within the buffer around it, both inside the study area if they are clipped.
    """
    grid = geotiff.reference_grid(_one_file(spark, config.reference_grid))
    files = _one_file(spark, config.land_cover)
    source = geotiff.reference_grid(files)
    rows = catalog.legend(geotiff.tags(files), FALLBACK_LEGEND).collect()  # a row a class
    legend, version, origin = {r["class"]: r["label"] for r in rows}, rows[0]["version"], rows[0]["source"]
    warnings = landcover.legend_findings(legend, (grid.transform[0], grid.transform[4]), config.urban_class, config.rural_classes)
    if origin == "fallback":
        warnings.append("the land cover has no legend that can be read")

    out, name = config.output_dir.rstrip("/"), lambda x: f"{config.output_dir.rstrip('/')}/{x}"
    land = sinks.table(landcover.align(geotiff.land_cover(files), source.transform, grid.transform, grid.height, grid.width, source.crs, grid.crs), name("land_cover"), config.overwrite)
    area = sinks.table(study_area(spark, config.boundary, grid), name("study_area"), config.overwrite)
    study = area.filter("in_study") if config.clip else None
    urban = sinks.table(landcover.urban(land, study, config.urban_class), name("urban"), config.overwrite)
    if urban.isEmpty():
        raise landcover.MaskError("no urban cell, so no ring around it")
    around = landcover.ring(urban, config.buffer_metres / grid.transform[0], grid.height, grid.width)
    around = sinks.table(around, name("ring"), config.overwrite)
    masks = sinks.table(landcover.mask_table(area, urban, landcover.rural(land, around, study, config.rural_classes)), name("masks"), config.overwrite)

    report = landcover.mask_report(masks, config.clip).first().asDict() | landcover.ring_report(land, around, config.rural_classes).first().asDict()
    found = landcover.mask_findings(masks, land, list(legend), grid.height, grid.width, config.clip).collect()  # a row a rule or class
    errors = [f"{r['finding']}: {r['detail']}" for r in found if r["level"] == "error"]
    warnings += [f"{r['finding']}: {r['detail']}" for r in found if r["level"] == "warning"]

    epsg = int(grid.crs.removeprefix("EPSG:"))
    tags = {"worldcover_version": version, "urban_class": str(config.urban_class)}, {"worldcover_version": version, "rural_classes": ",".join(map(str, config.rural_classes)), "buffer_m": str(int(config.buffer_metres))}
    for kind, own in zip(("urban", "rural"), tags, strict=True):
        geotiff.save(masks.select("row", "col", F.col(f"is_{kind}").cast("int").alias(f"{kind}_mask")), name(f"{kind}_mask"), grid.height, grid.width, [f"{kind}_mask"], "uint8", grid.transform, epsg, 0, config.overwrite, own)
    metadata = {
        "worldcover_version": version, "worldcover_legend_source": origin, "worldcover_source": config.land_cover, "study_boundary_source": config.boundary, "reference_grid_source": config.reference_grid,
        "urban_class": config.urban_class, "urban_class_label": legend.get(config.urban_class, "unknown"), "rural_buffer_m": config.buffer_metres, "rural_buffer_km": config.buffer_metres / 1000,
        "rural_classes": list(config.rural_classes), "rural_class_labels": {str(c): legend.get(c, "unknown") for c in config.rural_classes},
        "clip_to_study_boundary": config.clip, "crs": grid.crs, "resolution_m": grid.transform[0], "width": grid.width, "height": grid.height, "transform": list(grid.transform), "mask_dtype": "uint8", "mask_nodata": 0,
        "urban_pixel_count": report["urban"], "rural_pixel_count": report["rural"], "study_pixel_count": report["study"], "urban_pct_of_study": report["urban_pct"], "rural_pct_of_study": report["rural_pct"],
        "percentage_basis": "study_boundary" if config.clip else "full_reference_grid", "percentage_denominator_pixels": report["study"] if config.clip else report["cells"], "urban_rural_overlap_pixels": report["overlap"],
        "rural_ring_pixel_count_before_class_filter": report["ring"], "rural_ring_pixels_dropped_by_class_filter": report["dropped_by_class"],
        "validation": {"errors": errors, "warnings": warnings},
    }
    sinks.json_document(spark, f"{out}/mask_metadata.json", metadata, overwrite=True)
    if errors:
        raise landcover.MaskError("; ".join(errors))
    return Masks(masks, metadata, errors, warnings)
