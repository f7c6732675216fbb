"""Where results go: Parquet tables, JSON lines in id order, and small JSON documents."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(df: DataFrame, path: str, overwrite: bool = False, partition_by: list[str] | None = None) -> DataFrame:
    """Write Parquet (an existing table is an error unless it may be overwritten) and read it again."""
    df.write.mode("overwrite" if overwrite else "errorifexists").parquet(path, partitionBy=partition_by)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cube(df: DataFrame, path: str, tile: int = 128, overwrite: bool = False) -> None:
    """The cube by month, each month's rows in tile order, so that a window scan skips row groups."""
    order = [F.floor(F.col("row") / tile), F.floor(F.col("col") / tile), "row", "col"]
    df.repartition("month_idx").sortWithinPartitions("month_idx", *order).write.mode("overwrite" if overwrite else "errorifexists").partitionBy("month_idx").parquet(path)


def json_lines(df: DataFrame, path: str, order: list[str], overwrite: bool = False) -> None:
    """One object a line; files in name order hold the rows in order (range-partitioned, not one task)."""
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite" if overwrite else "errorifexists").json(path)


def json_document(spark: SparkSession, path: str, content: dict | list, overwrite: bool = False) -> None:
    """A JSON document, indented, as the one text file of a folder; values that JSON lacks become text."""
    text = json.dumps(content, indent=2, default=str)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite" if overwrite else "errorifexists").text(path)


def read_json(spark: SparkSession, path: str):
    """The content of a json_document()."""
    return json.loads("\n".join(r[0] for r in spark.read.option("wholetext", "true").text(path).collect()))  # one small file


def sample_index(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """The sample index that json_lines wrote, by sample_id, of one split if asked for."""
    kind = "sample_id long, split string, patch_id int, row_off int, col_off int, height int, width int, seq_start_index int, input_month_indices array<int>, target_month_index int, input_months array<string>, target_month string"
    rows = spark.read.schema(kind).json(path)
    return (rows if split is None else rows.filter(F.col("split") == split)).orderBy("sample_id")
