"""Rejected rows as records of one common shape."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.moments import moment
from tidemark.operators.quality import BAD, REASON, named


def reject_records(rejected: DataFrame, source_table: str, batch_id: str, run_ts: datetime) -> DataFrame:
    """Source table, batch, the row as JSON with its NULLs, and the reason. Of a record that could not be parsed, the
    JSON also has the text."""
    parsed = [named(c) for c in rejected.columns if c != BAD]

    def as_json(columns: list[Column]) -> Column:
        return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})

    row = as_json(parsed)
    if BAD in rejected.columns:
        row = F.when(named(BAD).isNotNull(), as_json([*parsed, named(BAD)])).otherwise(row)
    reason = F.coalesce(F.col(REASON), F.lit("Unknown")) if REASON in rejected.columns else F.lit("Unknown")
    return rejected.select(
        F.lit(source_table).alias("source_table"),
        F.lit(batch_id).alias("batch_id"),
        row.alias("raw_data"),
        reason.alias("reject_reason"),
        moment(run_ts).alias("rejected_at"),
    )
