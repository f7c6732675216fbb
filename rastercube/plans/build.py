"""The whole build: region and cube in; split, patches, statistics and sample index out."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rastercube.config import Config, as_yaml
from rastercube.functions.scalar import MIN_STD, pixel_centre
from rastercube.operators import partition, sequence, stats, tiles, verify
from rastercube.operators import samples as rebuild
from rastercube.plans.masks import study_area
from rastercube.sources import catalog, geotiff, sinks


@dataclass(frozen=True)
class Dataset:
    """Tables of a finished build; samples are rebuilt from the cube when they are asked for."""

    config: Config
    cube: DataFrame
    pixel: DataFrame
    terrain: DataFrame
    patch: DataFrame
    band_stats: DataFrame
    sample: DataFrame
    labels: list[str]

    def length(self, split: str) -> int:
        """How many samples a split has."""
        return sequence.length(self.sample, split)

    def at(self, split: str, positions: list[int]) -> DataFrame:
        """Sample records at positions of a split (from 0, by sample_id), with ``position``."""
        rows = sequence.of_split(self.sample, split)
        return sequence.at_positions(rows, F.array(*[F.lit(int(i)).cast("long") for i in positions]))

    def inputs(self, split: str, ids: list[int] | None = None) -> DataFrame:
        """X in long form of a split's samples, or of some of them by sample_id."""
        rows = self._pick(split, ids)
        d = self.config.data
        return rebuild.sample_values(rows, self.cube, self.terrain, self.band_stats, list(d.channel_names), list(d.static_channels))

    def targets(self, split: str, ids: list[int] | None = None) -> DataFrame:
        return rebuild.targets(self._pick(split, ids), self.cube, self.band_stats, self.config.data.target_channel)

    def _pick(self, split: str, ids: list[int] | None) -> DataFrame:
        rows = sequence.of_split(self.sample, split)
        return rows if ids is None else rows.filter(F.col("sample_id").isin(*ids))


def build(config: Config, catalogue: DataFrame, cube: DataFrame, pixel: DataFrame, height: int, width: int, overwrite: bool = False) -> Dataset:
    """Run all stages and write their tables under the output folder.

    catalogue: month_idx, label. cube: month_idx, row, col and the channels, not finite as
    null. pixel: row, col, x, y, in_region. With test_months, only the first months (at least
    one more than a sequence) are used. Small dimension tables are written; tensors never are.
    """
    config, spark = config.validate(), cube.sparkSession
    d, s, out = config.data, config.split, config.paths.output_dir
    every = catalogue.count()
    if d.test_months is not None:
        n = max(d.test_months, d.sequence_length + 1)
        catalogue, cube = catalogue.filter(F.col("month_idx") < n), cube.filter(F.col("month_idx") < n)
    labels = [r["label"] for r in catalogue.select("label", "month_idx").orderBy("month_idx").collect()]  # a row a month
    static, dynamic = list(d.static_channels), config.dynamic_channels

    partition.require_region(pixel)
    split = sinks.table(partition.directional_split(pixel, s.test_fraction, s.val_fraction, s.rotation_deg), f"{out}/pixel", overwrite)
    partition.require_pixels(split, s.min_pixels_per_split)
    assigned = tiles.assign(tiles.tile_counts(split, height, width, d.patch_size, d.stride), d.patch_size, d.purity_threshold)
    patch = sinks.table(tiles.patches(assigned, d.patch_size), f"{out}/patch", overwrite)
    tiles.require_patches(patch)
    summary = sinks.table(tiles.summary(assigned, d.patch_size), f"{out}/patch_summary", overwrite)
    terrain = sinks.table(stats.temporal_mean(cube, static), f"{out}/terrain", overwrite) if static else cube.select("row", "col").limit(0)
    weight = sinks.table(tiles.weights(split, patch, height, width, d.patch_size, d.stride), f"{out}/weight", overwrite)
    bands = stats.train_stats(cube, terrain, weight, dynamic, static, len(labels), d.max_gap_fraction)
    bands = stats.require_stats(sinks.table(bands, f"{out}/band_stats", overwrite))
    sample = sinks.table(sequence.samples(patch, labels, d.sequence_length), f"{out}/sample", overwrite)
    sinks.json_lines(sample, f"{out}/sample_index.jsonl", ["sample_id"], overwrite)
    sinks.json_lines(patch, f"{out}/patch_index.jsonl", ["patch_id"], overwrite)
    sinks.json_lines(catalogue, f"{out}/month_catalog.jsonl", ["month_idx"], overwrite)

    # a row a band, a split or nothing: small documents
    rows = {r["channel"]: r.asDict() for r in bands.collect()}
    order = [c for c in d.channel_names if c in rows]
    pick = lambda k: [rows[c][k] for c in order]
    sinks.json_document(spark, f"{out}/normalization_stats.json", {"channels": order, "means": pick("mean"), "stds": pick("std"), "fill_values": pick("fill"), "valid_counts": pick("n"), "gap_fractions": pick("gap_fraction"), "degenerate_channels": [c for c in order if rows[c]["degenerate"]], "over_gap_channels": [c for c in order if rows[c]["over_gap"]], "min_std_guard": MIN_STD}, overwrite)
    shares = {r["split"]: r.asDict() for r in partition.split_counts(split).collect()}
    sinks.json_document(spark, f"{out}/split_config.json", {"method": s.method, "rotation_deg": s.rotation_deg, "test_fraction": s.test_fraction, "val_fraction": s.val_fraction, "pixels": {k: v["pixels"] for k, v in shares.items()}, "pixel_pct": {k: v["percent"] for k, v in shares.items()}}, overwrite)
    spark.createDataFrame([(as_yaml(config),)], "value string").coalesce(1).write.mode("overwrite" if overwrite else "errorifexists").text(f"{out}/effective_config.yaml")
    counts = {r["split"]: r["n"] for r in tiles.by_split(patch).collect()}
    positions = len(labels) - d.sequence_length
    total = max(1, sum(counts.values()))
    metadata = {"created_utc": datetime.now(timezone.utc).isoformat(), "mode": "full" if d.test_months is None else "test", "months_used": labels, "sequence_length": d.sequence_length, "patch_size": d.patch_size, "stride": d.stride, "temporal_positions": positions}
    metadata |= {"patches": counts, "samples": {k: v * positions for k, v in counts.items()}, "sample_pct": {k: 100.0 * v / total for k, v in counts.items()}, "projected_samples": {k: v * (every - d.sequence_length) for k, v in counts.items()}, "patch_summary": summary.first().asDict()}
    sinks.json_document(spark, f"{out}/metadata.json", metadata, overwrite)
    return Dataset(config, cube, split, terrain, patch, bands, sample, labels)


def open_dataset(spark: SparkSession, config: Config, cube: DataFrame) -> Dataset:
    """The Dataset of an earlier build, from its output folder and the cube it was made of."""
    out = config.paths.output_dir
    read = lambda name: spark.read.parquet(f"{out}/{name}")
    labels = sinks.read_json(spark, f"{out}/metadata.json")["months_used"]
    terrain = read("terrain") if config.data.static_channels else cube.select("row", "col").limit(0)
    return Dataset(config, cube.filter(F.col("month_idx") < len(labels)), read("pixel"), terrain, read("patch"), read("band_stats"), read("sample"), labels)


def from_rasters(spark: SparkSession, config: Config, overwrite: bool = False) -> Dataset:
    """Rasters and a boundary to a finished dataset: discovery, grid and channel guards, cube, region, build().

    The cube is written by month and in tile order; all that follows reads it from there.
    """
    config = config.validate()
    d, p = config.data, config.paths
    found = catalog.require_complete(catalog.discover(catalog.list_files(spark, p.input_dir)))
    # pairs of a month and a path: a catalogue
    catalogue = sinks.table(found, f"{p.output_dir}/months", overwrite)
    rasters = geotiff.files(spark, p.input_dir, f"*{catalog.FILE_MARK}*.tif")
    grid = catalog.require_one_grid(geotiff.metadata(rasters))
    catalog.require_channels(grid["descriptions"], list(d.channel_names))
    sinks.cube(geotiff.cube(catalogue, rasters, list(d.channel_names)), f"{p.output_dir}/cube", d.patch_size, overwrite)
    cube = spark.read.parquet(f"{p.output_dir}/cube")
    shape = geotiff.Grid(grid["width"], grid["height"], grid["count"], grid["crs"], tuple(grid["transform"]), grid["dtype"], tuple(grid["descriptions"]))
    x, y = pixel_centre(F.col("row"), F.col("col"), shape.transform)
    pixel = study_area(spark, p.boundary, shape).select("row", "col", x.alias("x"), y.alias("y"), F.col("in_study").alias("in_region"))
    return build(config, catalogue.select("month_idx", "label"), cube, pixel, shape.height, shape.width, overwrite)


def verify_dataset(made: Dataset, shares: tuple[float, ...] = (0.0, 0.5, 1.0), planes: DataFrame | None = None, target: DataFrame | None = None) -> DataFrame:
    """verify.split_report() of samples at fixed shares of each split.

    planes and target are what a training job would read; by default they are rebuilt.
    """
    d = made.config.data
    picked = sequence.picks(made.sample, shares)
    x = planes if planes is not None else rebuild.sample_planes(picked, made.cube, made.terrain, made.band_stats, list(d.channel_names), list(d.static_channels))
    y = target if target is not None else rebuild.targets(picked, made.cube, made.band_stats, d.target_channel)
    return verify.split_report(picked, x, y, made.cube, made.band_stats, d.target_channel, d.sequence_length, len(d.channel_names), made.labels)
