"""Runs, errors, watermarks and schema changes, as small appended rows."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.moments import moment
from tidemark.operators.history import one_per_key
from tidemark.schemas import schema_of
from tidemark.warehouse import Warehouse

FIRST_WATERMARK = "1970-01-01 00:00:00"


def new_batch_id(name: str, now: datetime) -> str:
    """NAME_yyyymmdd_HHMMSS_ and eight hex digits."""
    return f"{name.upper()}_{now:%Y%m%d_%H%M%S}_{uuid.uuid4().hex[:8].upper()}"


def one_row(spark: SparkSession, schema: T.StructType, values: dict) -> DataFrame:
    """A row of driver-side values; columns not given are NULL."""
    columns = []
    for f in schema:
        v = values.get(f.name)
        c = moment(v) if isinstance(v, datetime) else F.lit(v)
        columns.append(c.cast(f.dataType).alias(f.name))
    return spark.range(1).coalesce(1).select(*columns)


class PipelineRun:
    """Records a run: RUNNING at the start, then SUCCESS, PARTIAL if rows were rejected, or FAILED.

    Each state is an appended row; `run_states` gives the last one of each run. An error is logged and
    goes on to the caller.
    """

    def __init__(
        self,
        warehouse: Warehouse,
        name: str,
        layer: str = "bronze",
        source_system: str = "",
        source_table: str = "",
        target_table: str = "",
        run_mode: str = "FULL",
        triggered_by: str = "manual",
        batch_id: str | None = None,
        clock=datetime.now,
    ):
        self.warehouse, self.name, self.clock = warehouse, name, clock
        self.labels = {
            "layer": layer, "source_system": source_system, "source_table": source_table,
            "target_table": target_table, "run_mode": run_mode, "triggered_by": triggered_by,
        }
        self.start_time = clock()
        self.batch_id = batch_id or new_batch_id(name, self.start_time)
        self.records_read = self.records_inserted = self.records_updated = 0
        self.records_rejected = self.records_skipped = 0
        self.status = "RUNNING"

    def _record(self, end: datetime | None, error: str | None) -> None:
        seconds = round((end - self.start_time).total_seconds(), 2) if end else None
        row = {
            **self.labels,
            "batch_id": self.batch_id, "pipeline_name": self.name, "status": self.status,
            "start_time": self.start_time, "end_time": end, "duration_seconds": seconds,
            "total_records_read": self.records_read, "records_inserted": self.records_inserted,
            "records_updated": self.records_updated, "records_rejected": self.records_rejected,
            "records_skipped": self.records_skipped, "error_message": error,
            "recorded_at": end or self.start_time,
        }
        table = "metadata.pipeline_runs"
        self.warehouse.append(one_row(self.warehouse.spark, schema_of(table), row), table)

    def __enter__(self) -> PipelineRun:
        self._record(None, None)
        return self

    def __exit__(self, kind, error, trace) -> bool:
        end = self.clock()
        if kind is not None:
            self.status = "FAILED"
            log_error(self.warehouse, self.batch_id, self.name, error, end)
        else:
            self.status = "PARTIAL" if self.records_rejected else "SUCCESS"
        self._record(end, str(error) if error is not None else None)
        return False


def run_states(runs: DataFrame) -> DataFrame:
    """The last recorded state of each run."""
    return one_per_key(runs, ["batch_id"], ["recorded_at", "end_time"])


def loads_of(runs: DataFrame, table: str) -> DataFrame:
    """batch, run_mode and end of the finished bronze loads of a table."""
    suffix = f".bronze.{table}"
    done = run_states(runs).where((F.col("pipeline_name") == f"bronze.{table}") & F.col("status").isin("SUCCESS", "PARTIAL"))
    return done.select(F.replace("batch_id", F.lit(suffix), F.lit("")).alias("batch"), "run_mode", "start_time")


def superseded(loads: DataFrame) -> DataFrame:
    """The batches loaded before the last full load, which holds all that they held. loads: batch, run_mode,
    start_time."""
    last = loads.agg(F.max(F.when(F.col("run_mode") == "FULL", F.struct("start_time", "batch"))).alias("last"))
    return loads.join(F.broadcast(last), F.struct("start_time", "batch") < F.col("last")).select("batch").distinct()


def log_error(warehouse: Warehouse, batch_id: str, name: str, error: BaseException, now: datetime) -> None:
    table = "metadata.error_log"
    row = {
        "batch_id": batch_id, "pipeline_name": name, "error_type": type(error).__name__,
        "error_message": str(error), "logged_at": now,
    }
    warehouse.append(one_row(warehouse.spark, schema_of(table), row), table)


def last_watermarks(watermarks: DataFrame) -> DataFrame:
    """The last value written for each source."""
    return watermarks.groupBy("source_table").agg(
        F.max_by("last_loaded_value", F.struct("last_updated", "last_loaded_value")).alias("last_loaded_value"),
        F.max("last_updated").alias("last_updated"),
    )


def get_watermark(warehouse: Warehouse, source_table: str) -> str:
    known = warehouse.read("metadata.watermarks").where(F.col("source_table") == source_table)
    row = last_watermarks(known).first()
    return row["last_loaded_value"] if row else FIRST_WATERMARK


def update_watermark(warehouse: Warehouse, source_table: str, value: str, now: datetime) -> None:
    table = "metadata.watermarks"
    row = {"source_table": source_table, "last_loaded_value": value, "last_updated": now}
    warehouse.append(one_row(warehouse.spark, schema_of(table), row), table)


def schema_changes(table: str, old: T.StructType, new: T.StructType) -> list[dict]:
    """Columns added, dropped or of another type."""
    before = {f.name: f.dataType.simpleString() for f in old}
    after = {f.name: f.dataType.simpleString() for f in new}
    changes = []
    for name in list(before) + [n for n in after if n not in before]:
        was, now = before.get(name), after.get(name)
        if was != now:
            kind = "ADD_COLUMN" if was is None else "DROP_COLUMN" if now is None else "TYPE_CHANGE"
            changes.append(
                {
                    "table_name": table, "change_type": kind, "column_name": name,
                    "old_definition": was, "new_definition": now,
                }
            )
    return changes


def last_schema(changes: DataFrame, table: str, declared: T.StructType) -> T.StructType:
    """The columns a source had when it was last loaded: the declared ones and what the log says since. The log has a
    row for each change, not for each load."""
    fields = {f.name: f for f in declared}
    logged = changes.where(F.col("table_name") == table).orderBy("detected_at", "batch_id", "column_name")
    for row in logged.collect():
        if row["change_type"] == "DROP_COLUMN":
            fields.pop(row["column_name"], None)
        else:
            fields[row["column_name"]] = T.StructField(row["column_name"], T._parse_datatype_string(row["new_definition"]))
    return T.StructType(list(fields.values()))


def log_schema_changes(
    warehouse: Warehouse, table: str, old: T.StructType, new: T.StructType, batch_id: str, now: datetime
) -> int:
    changes = schema_changes(table, old, new)
    target = "metadata.schema_changes"
    for change in changes:
        row = {**change, "batch_id": batch_id, "detected_at": now}
        warehouse.append(one_row(warehouse.spark, schema_of(target), row), target)
    return len(changes)
