"""Compares a Spark query with its SQL counterpart, value for value and type for type."""

from __future__ import annotations

import glob
import os

import duckdb
import pyarrow as pa


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _kind(t: pa.DataType) -> str:
    if pa.types.is_large_string(t):
        return "string"
    if pa.types.is_timestamp(t):
        return "timestamp"
    return str(t)


def _rows(table: pa.Table, names: list[str]) -> list[tuple]:
    columns = [table.column(n).to_pylist() for n in names]
    return sorted(zip(*columns, strict=True), key=repr) if columns else []


def differences(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    got = spark_df.toArrow()
    want = con.sql(sql).to_arrow_table()
    if sorted(got.column_names) != sorted(want.column_names):
        return [f"columns {sorted(got.column_names)} / {sorted(want.column_names)}"]
    names = sorted(got.column_names)
    found = []
    for n in names:
        a, b = _kind(got.schema.field(n).type), _kind(want.schema.field(n).type)
        if a != b:
            found.append(f"type of {n}: {a} / {b}")
    if got.num_rows != want.num_rows:
        found.append(f"rows {got.num_rows} / {want.num_rows}")
    mine, theirs = _rows(got, names), _rows(want, names)
    wrong = [(x, y) for x, y in zip(mine, theirs, strict=False) if x != y]
    if wrong:
        found.append(f"{len(wrong)} rows differ, first {dict(zip(names, zip(*wrong[0])))}")
    return found
