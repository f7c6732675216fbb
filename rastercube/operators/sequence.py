"""Sliding month windows over patches: the sample index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


class SequenceError(ValueError):
    pass


def samples(patch: DataFrame, labels: list[str], length: int) -> DataFrame:
    """Sample records: every patch at every position of a window of ``length`` input months and one target.

    Ids follow from the patch and the position, so there is no global window. labels: the
    catalogue's month labels, in order.
    """
    positions = len(labels) - length
    if length < 1 or positions < 1:
        raise SequenceError(f"{len(labels)} months are too few for sequences of {length} and a target")
    names = F.array(*[F.lit(x) for x in labels])
    rows = patch.withColumn("seq_start_index", F.explode(F.sequence(F.lit(0), F.lit(positions - 1))))
    at = F.col("seq_start_index")
    return rows.select(
        (F.col("patch_id").cast("long") * positions + at).alias("sample_id"), "split", "patch_id", "row_off", "col_off", "height", "width", "seq_start_index",
        F.sequence(at, at + (length - 1)).alias("input_month_indices"), (at + length).alias("target_month_index"),
        F.slice(names, at + 1, length).alias("input_months"), F.element_at(names, at + length + 1).alias("target_month"),
    )


def of_split(sample: DataFrame, split: str) -> DataFrame:
    if split not in ("train", "val", "test"):
        raise SequenceError(f"unknown split {split}")
    found = sample.filter(F.col("split") == split)
    if found.isEmpty():
        raise SequenceError(f"no samples in {split}")
    return found


def _placed(sample: DataFrame) -> DataFrame:
    """split, patch_id, and how many samples of the split come before the patch, and are in it and in the split.

    Windows over patches, of which there are few, not over samples.
    """
    patch = sample.groupBy("split", "patch_id").agg(F.count("*").alias("_n"), F.min("sample_id").alias("_first"))
    whole = Window.partitionBy("split")
    before = F.sum("_n").over(whole.orderBy("_first").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_n")
    return patch.select(F.col("split").alias("_s"), F.col("patch_id").alias("_p"), before.alias("_before"), "_n", F.sum("_n").over(whole).alias("_all"), "_first")


def at_positions(sample: DataFrame, wanted: Column) -> DataFrame:
    """sample with ``position``: of each split the samples at the positions (from 0, by sample_id) of an array of longs.

    wanted: an expression over _all, the number of samples in a split. A patch's samples have
    consecutive ids, so a position names a patch and a place in it.
    """
    at = _placed(sample).withColumn("position", F.explode(F.array_distinct(wanted)))
    at = at.filter((F.col("position") >= F.col("_before")) & (F.col("position") < F.col("_before") + F.col("_n")))
    at = at.select("_s", (F.col("_first") + F.col("position") - F.col("_before")).alias("_id"), "position")
    return sample.join(at, (sample["sample_id"] == at["_id"]) & (sample["split"] == at["_s"])).drop("_s", "_id")


def picks(sample: DataFrame, shares: tuple[float, ...] = (0.0, 0.5, 1.0)) -> DataFrame:
    """Of each split the samples at fixed shares of its length, by sample_id; 1.0 is the last."""
    n = F.col("_all")
    return at_positions(sample, F.array(*[F.least(F.floor(n * x), n - 1).cast("long") for x in shares])).drop("position")


def length(sample: DataFrame, split: str) -> int:
    """How many samples a split has."""
    return of_split(sample, split).count()


def next_value(cube: DataFrame, column: str, steps: int = 1) -> DataFrame:
    """Adds ``target``: the value of the month ``steps`` later at the same pixel (null if absent).

    An equi-join, exact in the month, whatever months a pixel lacks.
    """
    later = cube.select("row", "col", (F.col("month_idx") - steps).alias("month_idx"), F.col(column).alias("target"))
    return cube.join(later, ["row", "col", "month_idx"], "left")


def windows(cube: DataFrame, column: str, length: int) -> DataFrame:
    """row, col, month_idx and the values of the ``length`` months up to it, by month."""
    span = Window.partitionBy("row", "col").orderBy("month_idx").rangeBetween(-(length - 1), 0)
    return cube.select("row", "col", "month_idx", F.collect_list(column).over(span).alias("values"))
