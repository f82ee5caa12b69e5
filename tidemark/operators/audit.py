"""Audit columns and alignment with a target table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.moments import day, moment


def add_audit_columns(
    df: DataFrame, source_system: str, batch_id: str, run_ts: datetime, source_file: str | Column
) -> DataFrame:
    """Say where each row came from and when; `source_file` keeps the base name only."""
    file = F.lit(source_file) if isinstance(source_file, str) else source_file
    return df.withColumns(
        {
            "source_file": F.substring_index(file, "/", -1),
            "source_system": F.lit(source_system),
            "batch_id": F.lit(batch_id),
            "load_timestamp": moment(run_ts),
            "load_date": day(run_ts),
            "is_rejected": F.lit(False),
            "reject_reason": F.lit(None).cast("string"),
        }
    )


def align_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The target's columns in its order and types: unknown ones dropped, missing ones NULL."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f"`{f.name}`") if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )
