"""Monthly raster time series as Spark DataFrames."""

from rastercube.config import Config, DataConfig, Paths, SplitConfig, load
from rastercube.functions.scalar import OUTSIDE, TEST, TRAIN, VAL
from rastercube.operators.partition import directional_split
from rastercube.operators.stats import temporal_mean, train_stats
from rastercube.operators.tiles import patches, tile_counts
from rastercube.plans.build import Dataset, build, from_rasters, open_dataset, verify_dataset
from rastercube.plans.masks import MaskConfig
from rastercube.plans.masks import build as build_masks
from rastercube.sources.catalog import discover, require_channels, require_complete, require_one_grid

__all__ = [
    "Config", "DataConfig", "Dataset", "MaskConfig", "OUTSIDE", "Paths", "SplitConfig", "TEST", "TRAIN", "VAL",
    "build", "build_masks", "directional_split", "discover", "from_rasters", "load", "open_dataset", "patches",
    "require_channels", "require_complete", "require_one_grid", "temporal_mean", "tile_counts", "train_stats", "verify_dataset",
]
