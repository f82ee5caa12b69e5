"""Surrogate keys: dense numbers without a single-partition window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.session import settled

# monotonically_increasing_id() puts the partition number above bit 33 and the row's place below.
_PLACE_BITS = 33
_PLACE_MASK = (1 << _PLACE_BITS) - 1


def number_rows(df: DataFrame, key: str, order_by: list[str], start: int = 0) -> DataFrame:
    """Add `key` = start+1, start+2, ... in the order of `order_by`, which must identify a row.

    Rows are sorted by range across all executors and settled on shared storage, since range bounds
    are sampled and a second evaluation could draw others. Then each partition's count, summed over the
    partitions before it, is the offset of its rows. The offsets hold one row per partition, so the
    window over them and their broadcast are bounded by the partition count.
    """
    placed = settled(
        df.drop(key)
        .repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_slot", F.monotonically_increasing_id())
    )
    part = F.shiftright("_slot", _PLACE_BITS)
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(part.alias("_part"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    place = F.col("_slot").bitwiseAND(F.lit(_PLACE_MASK))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(key, (F.lit(start + 1) + F.col("_offset") + place).cast("bigint"))
        .drop("_part", "_slot", "_offset")
    )


def number_new_rows(
    df: DataFrame, key: str, order_by: list[str], existing: DataFrame, highest: int | None = None
) -> DataFrame:
    """Number the rows whose `key` is NULL after the highest key of `existing`; keep the other keys.

    The rows are read twice, those to be numbered and the others, so they are settled first. A caller that
    knows the highest key saves the look through `existing`.
    """
    df = settled(df)
    if highest is None:
        highest = existing.agg(F.coalesce(F.max(key), F.lit(0))).first()[0]
    fresh = number_rows(df.where(F.col(key).isNull()), key, order_by, highest)
    return df.where(F.col(key).isNotNull()).unionByName(fresh)
