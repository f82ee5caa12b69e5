"""Where a row stands in its source."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.quality import POSITION


def position() -> Column:
    """File, start of the block, and a number that rises within the block: unique, and the order of
    the file however its blocks are spread over tasks."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    ).alias(POSITION)


def parquet_position() -> Column:
    """The same for Parquet, which knows its row numbers: stable under any pushdown or retry."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")
    ).alias(POSITION)


def opened(read: Callable[[], DataFrame], path: str) -> DataFrame:
    """Run a reader and say plainly when the source is missing."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"Source file not found: {path}") from error
        raise
