"""The order of rows in files, for rules by which the last row wins or ties keep the order of the input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ORDINAL = "struct<file: string, block: long, row: long>"


def file_order() -> Column:
    """A row's place: its file, the block of the file that its task reads, and its place in that; right behind a file scan only."""
    return F.struct(F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))


def numbered(rows: DataFrame, name: str = "row_number") -> DataFrame:
    """rows with a column ordinal (as file_order gives it), numbered by it from 1 in its stead.

    Blocks are numbered in parallel, each by its own rows; only their sizes, a row for each block, are summed up in one task and sent to all.
    """
    block, before = ["ordinal.file", "ordinal.block"], Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy(*block).agg(F.count("*").alias("_size"), F.min("ordinal.row").alias("_first"))
    starts = sizes.withColumn("_before", F.coalesce(F.sum("_size").over(before), F.lit(0)))
    at = (F.col("ordinal.file") == F.col("file")) & (F.col("ordinal.block") == F.col("block"))
    return rows.join(F.broadcast(starts), at).withColumn(name, F.col("ordinal.row") - F.col("_first") + F.col("_before") + 1).drop("ordinal", "file", "block", "_size", "_first", "_before")


def ordinal_of(rows: DataFrame, ordinal: str | None = None) -> str | None:
    """The column that tells the order of rows: the given one, else `ordinal` if they have it."""
    return ordinal or ("ordinal" if "ordinal" in rows.columns else None)
