"""Digests of rows, to compare wide rows by two numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_digest(columns: list[Column]) -> list[Column]:
    """Two 64-bit hashes of the columns as text. A hash skips nulls, so each column goes in with a mark for them."""
    marked = [part for c in columns for part in (c.cast("string"), c.isNull())]
    return [F.xxhash64(F.lit(seed), *marked) for seed in (1, 2)]
