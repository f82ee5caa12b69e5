"""Raw files as they arrive: each one enters bronze exactly once.

The same reading, checks and writes as in a full run, driven by a file stream that keeps its place in a
checkpoint and stops when it has caught up. The stream carries only the names of new files: each of them is then
read by as many tasks as its size asks for, and its bad records go to the rejects.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Observation
from pyspark.sql.streaming import StreamingQuery

from tidemark.pipeline import Source, load_bronze
from tidemark.warehouse import Warehouse

#: Files of one batch at most: their names go through the driver.
BATCH_FILES = 1_000
_FILES = "path string, modificationTime timestamp, length bigint, content binary"


def ingest_arrivals(
    warehouse: Warehouse,
    source: Source,
    folder: str,
    checkpoint: str,
    run_ts: datetime,
    batch_name: str,
    batch_files: int = BATCH_FILES,
) -> StreamingQuery:
    """Load the files of a folder that no earlier call has loaded; returns the finished-or-running query.

    Batch ids come from the stream's own batch numbers, so a batch repeated after a failure replaces
    what its first attempt wrote.
    """
    reader = warehouse.spark.readStream.format("binaryFile").schema(_FILES).option("maxFilesPerTrigger", batch_files)
    names = reader.load(folder).select("path")  # the content is not read

    def load(batch: DataFrame, number: int) -> None:
        files = [r["path"] for r in batch.collect()]
        if files:
            seen = Observation()
            rows = source.read_files(warehouse.spark, files, seen)
            load_bronze(warehouse, rows, source, f"{batch_name}_{number:08d}", run_ts, seen)

    return (
        names.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
