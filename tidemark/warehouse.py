"""Tables on shared storage.

Three kinds of table, all plain Parquet:

* partitioned by batch: writing a batch again replaces that batch and nothing else;
* in parts, which are buckets of the key or months: a write makes new files for the parts it touches, below
  `version=n/part=p`, and a row in the table's `commits` names the version that each part is at;
* whole: each write makes a new `version=n` folder, and the commit makes it the current one.

A version is read only after its commit, so a lost job leaves the old one in force, and a table may be read
while its next version is written. Files of earlier versions stay, so a commit can also be compared with an
earlier one, part by part. One writer per table.

A table with history holds its current rows in parts and appends the rows that a version closed below
`closed/version=n`, so history is never rewritten.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from datetime import datetime
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.moments import moment
from tidemark.operators.audit import align_columns
from tidemark.schemas import TABLES, schema_of
from tidemark.session import shuffles_dropped

# How each table is written: the partition columns of a batch table, or one of the words below.
BATCHED = {
    **{f"bronze.{t}": ["batch_id"] for t in ("customers", "orders", "products", "order_items", "sellers", "payments")},
    "bronze.rejected_records": ["batch_id", "source_table"],
    "silver.order_items": ["batch_id"],
    "silver.payments": ["batch_id"],
    "metadata.dq_results": ["batch_id", "table_name"],
}
APPENDED = [
    "metadata.pipeline_runs", "metadata.watermarks", "metadata.error_log", "metadata.schema_changes",
]
HISTORY = ["silver.customers", "silver.sellers", "gold.dim_customer", "gold.dim_seller"]
# Tables in buckets of these keys.
KEYED = {
    "silver.customers": ["customer_id"],
    "silver.orders": ["order_id"],
    "silver.products": ["product_id"],
    "silver.sellers": ["seller_id"],
    "gold.dim_customer": ["customer_id"],
    "gold.dim_product": ["product_id"],
    "gold.dim_seller": ["seller_id"],
}
# Tables in months, as yyyymm; a row without a date is in month 0.
MONTHLY = {
    "gold.fact_sales": "coalesce(order_date_key div 100, 0)",
    "gold.revenue_mart": "year * 100 + month",
    "gold.mart_state": "year * 100 + month",
}
#: Buckets of a new table, unless the session says otherwise in this setting: some gigabytes of table each.
BUCKETS, BUCKETS_SETTING = 8, "spark.tidemark.buckets"
PART = "part"
#: Quotes in a field are doubled and blanks kept, as common CSV has it.
CSV_OPTIONS = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
COMMIT = "version bigint, committed_at timestamp_ntz, parts map<bigint,bigint>, buckets int, notes map<string,string>"


@dataclass(frozen=True)
class Commit:
    """What a version of a table consists of: the version of each part, the buckets, and what its writer noted."""

    version: int = 0
    parts: dict[int, int] = field(default_factory=dict)
    buckets: int | None = None
    notes: dict[str, str] = field(default_factory=dict)

    def since(self, earlier: Commit) -> list[int]:
        """The parts written, or emptied, after an earlier commit of the table."""
        if self.buckets != earlier.buckets:  # buckets were dealt anew
            return sorted(self.parts)
        return sorted(p for p in self.parts.keys() | earlier.parts.keys() if self.parts.get(p) != earlier.parts.get(p))


def _empty(schema: T.StructType) -> str:
    fields = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}" for f in schema)
    return f"SELECT {fields} WHERE false"


class Warehouse:
    """Reads and writes the tables of `schemas.TABLES` below one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{table.replace('.', '/')}"

    def _load(self, path: str, schema: T.StructType) -> DataFrame | None:
        try:
            return self.spark.read.schema(schema).parquet(path)
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def commit(self, table: str, version: int | None = None) -> Commit:
        """The commit in force, or that of an earlier version; version 0 is the table before its first."""
        commits = self._load(f"{self.path(table)}/commits", T.StructType.fromDDL(COMMIT))
        if commits is None or version == 0:
            return Commit()
        if version is not None:
            commits = commits.where(F.col("version") == version)
        row = commits.orderBy(F.desc("version")).first()
        return Commit(row["version"], row["parts"] or {}, row["buckets"], row["notes"] or {}) if row else Commit()

    def version(self, table: str) -> int:
        """The committed version; 0 before the first."""
        return self.commit(table).version

    def read(self, table: str, parts: Iterable[int] | None = None, version: int | None = None) -> DataFrame:
        """The table as last committed, or at an earlier version; empty if it was never written.

        Given parts, only their files are opened; of a table with history these hold its current rows.
        """
        schema = schema_of(table)
        if table in BATCHED or table in APPENDED:
            df = self._load(self.path(table), schema)
        elif table in KEYED or table in MONTHLY:
            found = self.commit(table, version)
            wanted = found.parts if parts is None else [p for p in dict.fromkeys(parts) if p in found.parts]
            folders = [f"{self.path(table)}/data/version={found.parts[p]}/{PART}={p}" for p in wanted]
            df = self.spark.read.schema(schema).parquet(*folders) if folders else None
            if table in HISTORY and parts is None and found.version:
                closed = self._closed(table, found.version)
                df = df if closed is None else closed if df is None else df.unionByName(closed)
        else:
            at = self.commit(table, version).version
            df = self._load(f"{self.path(table)}/data/version={at}", schema) if at else None
        if df is None:
            return self.spark.sql(_empty(schema))
        return df.select(*schema.names)

    def _closed(self, table: str, version: int) -> DataFrame | None:
        schema = schema_of(table)
        rows = self._load(f"{self.path(table)}/closed", T.StructType([*schema.fields, T.StructField("version", T.LongType())]))
        return None if rows is None else rows.where(F.col("version") <= version).select(*schema.names)

    def _buckets(self, table: str, known: Commit) -> int | None:
        if table not in KEYED:
            return None
        return known.buckets or int(self.spark.conf.get(BUCKETS_SETTING, str(BUCKETS)))

    def _part(self, table: str, buckets: int | None) -> Column:
        if table in MONTHLY:
            return F.expr(MONTHLY[table]).cast("bigint")
        return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in KEYED[table]]), F.lit(buckets))

    def part_of(self, table: str) -> Column:
        """The part that a row with the table's key belongs to."""
        return self._part(table, self._buckets(table, self.commit(table)))

    def parts_of(self, table: str, df: DataFrame) -> list[int]:
        """The parts that rows with the table's key belong to: at most as many as the table has buckets or months."""
        return sorted(r[0] for r in df.select(self.part_of(table).alias(PART)).distinct().collect())

    def exists(self, table: str) -> bool:
        if table in BATCHED or table in APPENDED:
            return self._load(self.path(table), schema_of(table)) is not None
        return self.version(table) > 0

    def tables(self, layer: str | None = None) -> list[str]:
        """The tables that have been written."""
        return [t for t in TABLES if (layer is None or t.startswith(layer + ".")) and self.exists(t)]

    def write_batch(self, df: DataFrame, table: str, *batch: str) -> None:
        """Write one batch in place of whatever that batch wrote before, also if it has no rows now.

        `batch` gives the values of the table's partition columns, which name the folder.
        """
        keys = BATCHED[table]
        if len(batch) != len(keys):
            raise ValueError(f"{table} is written by {', '.join(keys)}")
        folder = "/".join(f"{k}={quote(v, safe='')}" for k, v in zip(keys, batch, strict=True))
        with shuffles_dropped(self.spark):
            align_columns(df, schema_of(table)).drop(*keys).write.mode("overwrite").parquet(f"{self.path(table)}/{folder}")

    def append(self, df: DataFrame, table: str) -> None:
        align_columns(df, schema_of(table)).write.mode("append").parquet(self.path(table))

    def replace(self, df: DataFrame, table: str, run_ts: datetime, notes: dict[str, str] | None = None) -> None:
        """Write the whole table anew and commit it. A table in buckets takes the session's number of them."""
        if table in KEYED or table in MONTHLY:
            self.write_parts(df, table, None, run_ts, notes)
            return
        known = self.commit(table)
        with shuffles_dropped(self.spark):
            align_columns(df, schema_of(table)).write.mode("overwrite").parquet(f"{self.path(table)}/data/version={known.version + 1}")
        self._commit(table, Commit(known.version + 1, {}, None, notes or {}), run_ts)

    def write_parts(
        self,
        df: DataFrame | Iterable[DataFrame],
        table: str,
        parts: list[int] | None,
        run_ts: datetime,
        notes: dict[str, str] | None = None,
        closed: DataFrame | None = None,
    ) -> None:
        """Put these rows in place of the given parts, or of all, and leave the files of the others as they are.

        The rows must belong to those parts. Several frames are written one after the other and committed together,
        so what a write needs of disk beside the table is that of the largest. Notes are added to the ones before.
        `closed` are rows of a table with history that this version closes.
        """
        known = self.commit(table)
        following = known.version + 1
        buckets = self._buckets(table, Commit() if parts is None else known)
        folder = f"{self.path(table)}/data/version={following}"
        mode = "overwrite"  # also of what a lost write left there
        for piece in [df] if isinstance(df, DataFrame) else df:
            rows = align_columns(piece, schema_of(table)).withColumn(PART, self._part(table, buckets))
            with shuffles_dropped(self.spark):
                # Neighbours in one file, and a part of any size spread over as many tasks as it needs.
                rows.hint("rebalance", PART).write.mode(mode).partitionBy(PART).parquet(folder)
            mode = "append"
        if closed is not None:
            with shuffles_dropped(self.spark):
                align_columns(closed, schema_of(table)).write.mode("overwrite").parquet(f"{self.path(table)}/closed/version={following}")
        listed = self._load(folder, T.StructType.fromDDL(f"{PART} bigint"))
        written = {r[0]: following for r in listed.distinct().collect()}
        kept = {} if parts is None else {p: v for p, v in known.parts.items() if p not in set(parts)}
        self._commit(table, Commit(following, kept | written, buckets, known.notes | (notes or {})), run_ts)

    def note(self, table: str, notes: dict[str, str], run_ts: datetime) -> None:
        """Commit the table as it is, with other notes."""
        known = self.commit(table)
        if any(known.notes.get(k) != v for k, v in notes.items()):
            self._commit(table, Commit(known.version + 1, known.parts, known.buckets, known.notes | notes), run_ts)

    def _commit(self, table: str, commit: Commit, run_ts: datetime) -> None:
        row = (commit.version, run_ts, commit.parts, commit.buckets, commit.notes)
        rows = self.spark.createDataFrame([row], COMMIT).coalesce(1)
        rows.write.mode("append").parquet(f"{self.path(table)}/commits")

    def publish(self) -> list[str]:
        """Make every table readable in SQL as `layer.table`, at its current version."""
        for layer in dict.fromkeys(t.split(".")[0] for t in TABLES):
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
        for table in TABLES:
            if table in BATCHED:
                self._publish_batches(table)
                continue
            try:
                self.spark.sql(f"CREATE OR REPLACE VIEW {table} AS {self._select(table)}")
            except AnalysisException as error:
                # Never written, or written without a row: there is no file to take the columns from.
                if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                    raise
                self.spark.sql(f"CREATE OR REPLACE VIEW {table} AS {_empty(schema_of(table))}")
        return list(TABLES)

    def _publish_batches(self, table: str) -> None:
        """A table over the batches' folders with the declared types: a batch id stays the text it is."""
        kind = self.spark.sql(f"SHOW VIEWS IN {table.split('.')[0]} LIKE '{table.split('.')[1]}'")
        self.spark.sql(f"DROP {'TABLE' if kind.isEmpty() else 'VIEW'} IF EXISTS {table}")
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema_of(table))
        keys = ", ".join(BATCHED[table])
        self.spark.sql(
            f"CREATE TABLE {table} ({columns}) USING parquet PARTITIONED BY ({keys}) LOCATION '{self.path(table)}'"
        )
        if self.exists(table):
            self.spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")

    def _select(self, table: str) -> str:
        schema = schema_of(table)
        fields = ", ".join(f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in schema)
        if table in APPENDED:
            return f"SELECT {fields} FROM parquet.`{self.path(table)}`"
        found = self.commit(table)
        if table not in KEYED and table not in MONTHLY:
            return f"SELECT {fields} FROM parquet.`{self.path(table)}/data/version={found.version}`"
        by_version: dict[int, list[int]] = {}
        for part, version in found.parts.items():
            by_version.setdefault(version, []).append(part)
        wanted = [f"(version = {v} AND {PART} IN ({', '.join(map(str, sorted(p)))}))" for v, p in sorted(by_version.items())]
        selects = [f"SELECT {fields} FROM parquet.`{self.path(table)}/data` WHERE {' OR '.join(wanted)}"] if wanted else []
        if table in HISTORY and self._closed(table, found.version) is not None:
            selects.append(f"SELECT {fields} FROM parquet.`{self.path(table)}/closed` WHERE version <= {found.version}")
        return " UNION ALL ".join(selects) or _empty(schema)

    def export_csv(self, target: str, tables: list[str]) -> dict[str, str]:
        """Write tables as CSV folders with a header; a table that fails does not stop the others."""
        outcome = {}
        for table in tables:
            try:
                name = table.split(".")[1]
                self.read(table).write.mode("overwrite").options(**CSV_OPTIONS).csv(f"{target.rstrip('/')}/{name}")
                outcome[table] = "exported"
            except Exception as error:  # noqa: BLE001 - reported per table
                outcome[table] = f"failed: {error}"
        return outcome


# The tables exported for the reporting tool.
EXPORTED = ["gold.fact_sales", "gold.dim_customer", "gold.dim_seller", "gold.dim_product", "gold.dim_date"]
