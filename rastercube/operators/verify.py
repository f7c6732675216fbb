"""Checks of a build's samples against the raw cube and against their index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rastercube.functions.scalar import SPLITS, previous_label, zscore


class VerifyError(ValueError):
    pass


def index_faults(length: int, labels: list[str] | None = None) -> dict[str, Column]:
    """Conditions, by name, that a record of the sample index must not meet."""
    months, names = F.col("input_month_indices"), F.col("input_months")
    steps = F.expr("transform(sequence(1, greatest(size(input_month_indices) - 1, 1)), k -> coalesce(get(input_month_indices, k) - get(input_month_indices, k - 1), 1))")
    found = {
        "bad_length": F.size(months) != length,
        "gaps": F.exists(steps, lambda x: x != 1),
        "bad_target": F.element_at(months, -1) + 1 != F.col("target_month_index"),
        "bad_last_month": F.element_at(names, -1) != previous_label(F.col("target_month")),
    }
    if labels is not None:
        every = F.array(*[F.lit(x) for x in labels])
        found["bad_labels"] = ~names.eqNullSafe(F.transform(months, lambda i: F.get(every, i)))
    return found


def index_report(sample: DataFrame, length: int, labels: list[str] | None = None) -> DataFrame:
    """One row: samples, how many break each rule of their index, and how many ids are not unique (all should be 0)."""
    broken = [F.count_if(c).alias(n) for n, c in index_faults(length, labels).items()]
    return sample.agg(F.count("*").alias("samples"), *broken, (F.count("*") - F.count_distinct("sample_id")).alias("repeated_ids"))


def plane_report(planes: DataFrame, sample: DataFrame) -> DataFrame:
    """sample_id, planes, bad_planes (cells that are too many or few), nan and infinite of a build's X.

    planes: sample_id, t, channel_idx, cells (i, j, z).
    """
    z = F.col("cells.z")
    rows = planes.join(sample.select("sample_id", (F.col("height") * F.col("width")).alias("_area")), "sample_id")
    count = lambda f: F.sum(F.size(F.filter(z, f))).cast("long")
    return rows.groupBy("sample_id").agg(
        F.count("*").alias("planes"), F.count_if(F.size("cells") != F.col("_area")).alias("bad_planes"),
        count(F.isnan).alias("nan"), count(lambda x: F.abs(x) == float("inf")).alias("infinite"),
    )


def target_report(target: DataFrame, sample: DataFrame, cube: DataFrame, stats: DataFrame, band: str, tolerance: float = 1e-6) -> DataFrame:
    """sample_id, cells, valid, masks_wrong, off and max_diff: a build's y and mask against the raw cube.

    target: sample_id, i, j, y, mask. A mask must say whether the raw value is there; where it
    is, y must be its z-score within the tolerance.
    """
    place = sample.select("sample_id", "row_off", "col_off", F.col("target_month_index").alias("month_idx"))
    rows = target.join(place, "sample_id").withColumn("row", F.col("row_off") + F.col("i")).withColumn("col", F.col("col_off") + F.col("j"))
    raw = cube.select("month_idx", "row", "col", F.col(band).cast("double").alias("raw"))
    one = F.broadcast(stats.filter(F.col("channel") == band).select("mean", "std"))  # one row
    rows = rows.join(raw, ["month_idx", "row", "col"], "left").withColumn("channel", F.lit(band)).join(one, F.lit(True))
    diff = F.when(F.col("raw").isNotNull(), F.abs(F.col("y") - zscore(F.col("raw"), F.col("mean"), F.col("std"))))
    return rows.groupBy("sample_id").agg(
        F.count("*").alias("cells"), F.count_if("mask").alias("valid"), F.count_if(F.col("mask") != F.col("raw").isNotNull()).alias("masks_wrong"),
        F.count_if(diff > tolerance).alias("off"), F.max(diff).alias("max_diff"),
    )


def split_report(sample: DataFrame, planes: DataFrame, target: DataFrame, cube: DataFrame, stats: DataFrame, band: str, length: int, bands: int, labels: list[str] | None = None) -> DataFrame:
    """A row a split: how many of the given samples there are, and sums of what each check finds.

    errors counts samples with a wrong shape, mask or value; NaN and infinite values and
    months out of order are warnings, counted apart.
    """
    x, y = plane_report(planes, sample), target_report(target, sample, cube, stats, band)
    faults = index_faults(length, labels)
    order = F.lit(False)
    for c in faults.values():
        order = order | F.coalesce(c, F.lit(True))
    rows = sample.select("sample_id", "split", (F.col("height") * F.col("width")).alias("_area"), order.alias("_order")).join(x, "sample_id", "left").join(y, "sample_id", "left")
    zero = lambda c: F.coalesce(c, F.lit(0))
    shape = (zero("planes") != length * bands) | (zero("bad_planes") > 0) | (zero("cells") != F.col("_area"))
    wrong = shape | (zero("masks_wrong") > 0) | (zero("off") > 0)
    found = rows.groupBy("split").agg(
        F.count("*").alias("samples"), F.count_if(shape).alias("bad_shapes"), F.sum("nan").alias("nan"), F.sum("infinite").alias("infinite"),
        F.sum("masks_wrong").alias("masks_wrong"), F.sum("off").alias("values_off"), F.max("max_diff").alias("max_diff"),
        (F.sum("valid") / F.sum("cells")).alias("valid_share"), F.count_if("_order").alias("months_out_of_order"), F.count_if(wrong).alias("errors"),
    )
    return found


def require(report: DataFrame) -> list[dict]:
    """The rows of split_report(); raises if one has errors or a split has no row."""
    rows = [r.asDict() for r in report.orderBy("split").collect()]  # three rows
    bad = {r["split"]: r["errors"] for r in rows if r["errors"]}
    if absent := set(SPLITS) - {r["split"] for r in rows}:
        raise VerifyError(f"no samples in {sorted(absent)}")
    if bad:
        raise VerifyError(f"samples with errors: {bad}")
    return rows
