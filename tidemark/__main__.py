"""Command line, for spark-submit: run the whole pipeline or one layer, export, or show a summary."""

from __future__ import annotations

import argparse
import sys
from datetime import datetime

from pyspark.sql import SparkSession

from tidemark import pipeline
from tidemark.warehouse import EXPORTED, Warehouse


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tidemark")
    parser.add_argument("work", choices=["run", "bronze", "silver", "gold", "publish", "export", "summary"])
    parser.add_argument("root", help="folder of the warehouse")
    parser.add_argument("--raw", help="folder of the raw files")
    parser.add_argument("--target", help="folder for the exported CSV")
    parser.add_argument("--at", type=datetime.fromisoformat, default=None, help="time of the run, by default now")
    parser.add_argument("--batch", default=None, help="batch id, by default a new one")
    parser.add_argument("--incremental", action="store_true", help="read only rows after the watermarks")
    parser.add_argument("--manual-rules", action="store_true", help="use the rules of a manual run")
    chosen = parser.parse_args(arguments)
    if chosen.work in ("run", "bronze") and not chosen.raw:
        parser.error("--raw is needed")
    if chosen.work == "export" and not chosen.target:
        parser.error("--target is needed")

    spark = SparkSession.builder.appName("tidemark").getOrCreate()
    at = chosen.at or datetime.now()
    sources = pipeline.MANUAL_SOURCES if chosen.manual_rules else pipeline.SOURCES
    warehouse = Warehouse(spark, chosen.root)
    outcome = None
    if chosen.work in ("run", "bronze"):
        load = pipeline.run if chosen.work == "run" else pipeline.run_bronze
        outcome = load(spark, chosen.raw, chosen.root, at, sources, chosen.incremental, chosen.batch)
    elif chosen.work == "silver":
        outcome = pipeline.run_silver(spark, chosen.root, at, chosen.batch)
    elif chosen.work == "gold":
        outcome = pipeline.run_gold(spark, chosen.root, at, chosen.batch)
    elif chosen.work == "publish":
        print("\n".join(warehouse.publish()))
    elif chosen.work == "export":
        for table, result in warehouse.export_csv(chosen.target, EXPORTED).items():
            print(table, result)
    else:
        for part in pipeline.summary(warehouse).values():
            part.show(100, truncate=False)
    if outcome is None:
        return 0
    for table, rows in outcome.rows.items():
        print(f"{table:<24} {rows:>14,}")
    for table, error in outcome.errors.items():
        print(f"{table:<24} {error}", file=sys.stderr)
    return 1 if outcome.errors else 0


if __name__ == "__main__":
    sys.exit(main())
