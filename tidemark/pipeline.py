"""The whole run: raw files to bronze, silver and gold."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import lookups
from tidemark.functions.moments import moment, to_moment
from tidemark.functions.numbers import to_decimal
from tidemark.operators.audit import add_audit_columns
from tidemark.operators.history import CHANGE, changed_versions, dimension_changes, one_per_key, upsert
from tidemark.operators.keys import number_new_rows
from tidemark.operators.quality import BAD, POSITION, REASON, Validator, named
from tidemark.operators.rejects import reject_records
from tidemark.plans import dimensions, increment, reports, silver
from tidemark.plans.fact import build_fact_sales, with_sales_keys
from tidemark.plans.kpis import build_kpi_summary
from tidemark.plans.mart import month_states, revenue_by_month, with_metrics
from tidemark.runs import (
    PipelineRun,
    get_watermark,
    last_schema,
    loads_of,
    log_schema_changes,
    new_batch_id,
    one_row,
    run_states,
    superseded,
    update_watermark,
)
from tidemark.schemas import FILE_ORDER, NUMBER_LIMITS, SOURCE_COLUMNS, TEXT_LIMITS, schema_of, text_schema
from tidemark.session import ensure_checkpoint_dir, settled, shuffles_dropped
from tidemark.sources import leaf_fields, newer_than, read_csv, read_json, read_xml
from tidemark.warehouse import CSV_OPTIONS, EXPORTED, KEYED, MONTHLY, Warehouse


@dataclass(frozen=True)
class Source:
    """A raw file, how to read it and which rules its rows must meet."""

    table: str
    file: str
    system: str
    not_null: tuple[str, ...]
    unique: tuple[str, ...] = ()
    numeric: tuple[str, ...] = ()
    domain: tuple[str, tuple[str, ...]] | None = None
    watermark_col: str | None = None
    limits: bool = True  # reject rows with text or numbers that their column can't hold
    multi_line: bool | None = None  # CSV: fields hold line breaks; found out per file unless said
    lines: bool = False  # JSON: one record a line, which many tasks can read
    record_path: str | None = None  # JSON: where in a document the records are
    record_tag: str | None = "product"  # XML

    def read(self, spark: SparkSession, raw_dir: str, seen: Observation | None = None) -> DataFrame:
        return self.read_files(spark, f"{raw_dir.rstrip('/')}/{self.file}", seen)

    def read_files(self, spark: SparkSession, path: str | list[str], seen: Observation | None = None) -> DataFrame:
        """The rows of a file or several, with their places; records that can't be parsed are rows of their own.
        `seen` is for `load_bronze`, which learns from it the fields that the columns leave out."""
        columns, kept = SOURCE_COLUMNS[self.table], {"keep_position": True}
        if self.system == "CSV":
            return read_csv(spark, path, multi_line=self.multi_line, **kept)
        kept["keep_bad"] = True
        if self.system == "JSON":
            layout = {"lines": self.lines, "record_path": self.record_path}
            return read_json(spark, path, columns=columns, seen=seen if self.has_fields else None, **layout, **kept)
        return read_xml(spark, path, record_tag=self.record_tag, columns=columns, **kept)

    @property
    def has_fields(self) -> bool:
        """Whether a read says which fields its records have, beside the columns."""
        return self.system == "JSON" and self.record_path is None

    def rules(self, validator: Validator) -> Validator:
        validator.check_parsed()
        validator.check_nulls(self.not_null)
        if self.unique:
            validator.check_unique(self.unique)
        if self.numeric:
            validator.check_numeric(self.numeric)
        if self.domain:
            validator.check_value_in_set(*self.domain)
        if self.limits:
            validator.check_lengths(TEXT_LIMITS[self.table], "ERROR")
            validator.check_precision(NUMBER_LIMITS.get(self.table, {}), "ERROR")
            if self.table == "order_items":
                total = to_decimal(F.col("price"), 12, 2) + to_decimal(F.col("freight_value"), 12, 2)
                validator.check_computed("total_item_value", total, 12, 2)
            if self.table == "products":
                sizes = [to_decimal(F.col(f"product_{c}_cm"), 12, 4) for c in ("length", "height", "width")]
                validator.check_computed("product_volume_cm3", F.round(sizes[0] * sizes[1] * sizes[2], 2), 12, 2)
        return validator


# The six sources with their files and rules.
SOURCES = [
    Source("customers", "customers.csv", "CSV", ("customer_id",), ("customer_id",)),
    Source("sellers", "sellers.csv", "CSV", ("seller_id",), ("seller_id",)),
    Source(
        "products", "products.xml", "XML", ("product_id",), ("product_id",),
        ("product_weight_g", "product_length_cm"),
    ),
    Source(
        "orders", "orders.json", "JSON", ("order_id", "customer_id"), ("order_id",),
        domain=("order_status", tuple(lookups.ORDER_STATUSES)), watermark_col="order_purchase_timestamp",
    ),
    Source(
        "order_items", "order_items.csv", "CSV", ("order_id", "product_id", "seller_id"),
        numeric=("price", "freight_value"), watermark_col="shipping_limit_date",
    ),
    Source("payments", "payments.json", "JSON", ("order_id",), numeric=("payment_value",)),
]

# The stricter-looking rules of a single manual run: a lone key must be unique, which for items and
# payments keeps one row per order.
MANUAL_SOURCES = [
    Source("customers", "customers.csv", "CSV", ("customer_id",), ("customer_id",)),
    Source("sellers", "sellers.csv", "CSV", ("seller_id",), ("seller_id",)),
    Source("products", "products.xml", "XML", ("product_id",), ("product_id",)),
    Source("orders", "orders.json", "JSON", ("order_id", "customer_id")),
    Source("order_items", "order_items.csv", "CSV", ("order_id",), ("order_id",)),
    Source("payments", "payments.json", "JSON", ("order_id",), ("order_id",)),
]


@dataclass
class Outcome:
    """Rows per table and the errors of tables that failed."""

    batch_id: str
    rows: dict[str, int] = field(default_factory=dict)
    errors: dict[str, str] = field(default_factory=dict)


def stage(warehouse: Warehouse, df: DataFrame, table: str, batch_id: str) -> DataFrame:
    """Write parsed rows once below the shared root and read them back as Parquet, so that checks and
    writes scan columns instead of parsing text again, over rows whose places are fixed."""
    path = f"{warehouse.root}/staging/{batch_id}/{table}"
    rows = df if POSITION in df.columns else df.withColumn(POSITION, F.monotonically_increasing_id())
    rows.write.mode("overwrite").parquet(path)
    return warehouse.spark.read.schema(rows.schema).parquet(path)


def load_bronze(
    warehouse: Warehouse,
    df: DataFrame,
    source: Source,
    batch_id: str,
    run_ts: datetime,
    seen: Observation | None = None,
) -> dict[str, int]:
    """Check the rows and write the valid ones to bronze, the others to the rejects.

    The rows are staged with the outcome of each check beside them. One job writes the valid rows and, as observed metrics, counts every check and takes the highest
    watermark; a second one writes what was rejected, and the CSV is made of that.
    """
    table = f"bronze.{source.table}"
    checks = source.rules(Validator(df, table, batch_id))
    staged = checks.staged(lambda rows: stage(warehouse, rows, source.table, batch_id))
    found = T.StructType([f for f in staged.schema if f.name in checks.columns and f.name != BAD])
    if seen is not None and source.has_fields:
        found = leaf_fields(seen.get["schema"])
    before = last_schema(warehouse.read("metadata.schema_changes"), table, text_schema(SOURCE_COLUMNS[source.table]))
    if found.fields:  # a source without a record has lost no column
        log_schema_changes(warehouse, table, before, found, batch_id, run_ts)
    metrics = [*checks.count_columns(), F.count_if(checks.is_rejected()).alias("rejected")]
    if source.watermark_col:
        # Over the valid rows only, which are the ones the table will hold.
        stamp = F.when(~checks.is_rejected(), to_moment(F.col(source.watermark_col)))
        metrics.append(F.max(stamp).cast("string").alias("watermark"))
    counted = Observation()
    marked = checks.marked().observe(counted, *metrics)
    valid = marked.where(~checks.is_rejected())
    place = staged.schema[POSITION].dataType
    at, row = F.col(POSITION), None
    if isinstance(place, T.StructType) and POSITION in place.names:  # one of several records of a document
        row, at, place = at["record"], at[POSITION], place[POSITION].dataType
    known_file = isinstance(place, T.StructType) and "file" in place.names
    file = at["file"] if known_file else F.lit(source.file)
    if row is None:
        row = at["row"] if known_file else at
    placed = valid.withColumns({"source_block": at["block"] if known_file else F.lit(0), "source_row": row})
    warehouse.write_batch(add_audit_columns(placed, source.system, batch_id, run_ts, file), table, batch_id)
    counts = counted.get
    watermark = counts.get("watermark")

    schema = "total bigint, rejected bigint" + "".join(f", {k} bigint" for k in counts if k.startswith("failed"))
    known = one_row(warehouse.spark, T.StructType.fromDDL(schema), counts)
    warehouse.write_batch(checks.results(run_ts, known), "metadata.dq_results", batch_id, table)

    # Also without a rejected row: a batch that was mended has no rejects left.
    rejected = checks.rejected() if counts["rejected"] else staged.select(*map(named, checks.columns)).withColumn(REASON, F.lit("")).limit(0)
    records = reject_records(rejected, source.table, batch_id, run_ts)
    warehouse.write_batch(records, "bronze.rejected_records", batch_id, source.table)
    if counts["rejected"]:
        folder = f"{warehouse.root}/rejected/{source.table}_{batch_id}_{run_ts:%Y%m%d_%H%M%S}_rejected.csv"
        written = warehouse.read("bronze.rejected_records").where(
            (F.col("batch_id") == batch_id) & (F.col("source_table") == source.table)
        )
        parsed = F.from_json("raw_data", rejected.schema).alias("row")
        written.select(parsed).select("row.*").write.mode("overwrite").options(**CSV_OPTIONS).csv(folder)
    inserted = counts["total"] - counts["rejected"]
    if inserted:
        update_watermark(warehouse, source.table, watermark or run_ts.strftime("%Y-%m-%d %H:%M:%S"), run_ts)
    return {"read": counts["total"], "inserted": inserted, "rejected": counts["rejected"]}


def _written(df: DataFrame, write: Callable[[DataFrame], None], **metrics) -> dict[str, int]:
    seen = Observation()
    write(df.observe(seen, *[c.alias(name) for name, c in metrics.items()]))
    return seen.get


def load_silver(warehouse: Warehouse, table: str, batch_id: str, run_ts: datetime) -> dict[str, int]:
    """Transform one batch of a bronze table and merge it into its silver table.

    Of a table in buckets only those are read and written that the batch has keys of, and of one with history only
    those in which a key is new or changed.
    """
    bronze = silver.batch_slice(warehouse.read(f"bronze.{table}"), batch_id)
    if bronze.isEmpty():
        return {"inserted": 0, "updated": 0}
    target = f"silver.{table}"
    if table in ("customers", "sellers"):
        transform = silver.transform_customers if table == "customers" else silver.transform_sellers
        key = "customer_id" if table == "customers" else "seller_id"
        incoming = transform(bronze, batch_id, run_ts.date())
        return merge_versions(warehouse, target, incoming, key, run_ts, order_by=FILE_ORDER)
    if table == "products":
        return merge_rows(warehouse, target, silver.transform_products(bronze, batch_id), run_ts, FILE_ORDER)
    if table == "orders":
        return merge_rows(warehouse, target, silver.transform_orders(bronze), run_ts, FILE_ORDER)
    transform = silver.transform_order_items if table == "order_items" else silver.transform_payments
    incoming = transform(bronze, batch_id)
    counts = _written(incoming, lambda df: warehouse.write_batch(df, target, batch_id), inserted=F.count(F.lit(1)))
    return {**counts, "updated": 0}


def latest_load(warehouse: Warehouse, table: str) -> str:
    """The batch that a bronze table loaded last: by the run records, so that of bronze only that batch's folder is
    opened; only without any record by a look through the table."""
    newest = F.max_by("batch", F.struct("start_time", "batch"))
    noted = loads_of(warehouse.read("metadata.pipeline_runs"), table).agg(newest).first()[0]
    return noted or silver.latest_batch(warehouse.read(f"bronze.{table}")).first()[0]


def merge_rows(
    warehouse: Warehouse, target: str, incoming: DataFrame, run_ts: datetime, order_by: list[str] | None = None
) -> dict[str, int]:
    """Insert or update by the table's key, in the buckets that the rows belong to."""
    with shuffles_dropped(warehouse.spark):
        incoming = settled(incoming)
    parts = warehouse.parts_of(target, incoming)
    merged = upsert(warehouse.read(target, parts), incoming, KEYED[target], run_ts=run_ts, order_by=order_by)
    touched = F.count_if(F.col("updated_at") == moment(run_ts))
    counts = _written(merged, lambda df: warehouse.write_parts(df, target, parts, run_ts), inserted=touched)
    return {**counts, "updated": 0}


def merge_versions(
    warehouse: Warehouse,
    target: str,
    incoming: DataFrame,
    key: str,
    run_ts: datetime,
    surrogate: str | None = None,
    notes: dict[str, str] | None = None,
    order_by: list[str] | None = None,
) -> dict[str, int]:
    """Bring a table with history up to the rows of a batch, in the buckets in which a key is new or changed."""
    columns = [c for c in incoming.columns if c in schema_of(target).names]
    batch = settled(one_per_key(incoming.where(F.col(key).isNotNull()), [key], order_by).select(*columns))
    known = warehouse.read(target, warehouse.parts_of(target, batch))
    changes = settled(dimension_changes(known, batch, key, dimensions.COMPARED))
    counted = {r[CHANGE]: r["n"] for r in changes.groupBy(CHANGE).agg(F.count(F.lit(1)).alias("n")).collect()}
    counts = {"inserted": counted.get("new", 0), "updated": counted.get("changed", 0)}
    parts = warehouse.parts_of(target, changes)
    notes = dict(notes or {})
    if not parts:
        warehouse.note(target, notes, run_ts)
        return counts
    rows = changed_versions(warehouse.read(target, parts), batch, key, changes, run_ts.date(), run_ts)
    if surrogate:
        highest = highest_key(warehouse, target, surrogate)
        fresh = F.col(CHANGE).isin("new", "changed")
        rows = rows.withColumn(surrogate, F.when(~fresh, F.col(surrogate)))
        rows = number_new_rows(rows, surrogate, [key], known, highest)
        notes["highest"] = str(highest + sum(counts.values()))
    else:
        rows = settled(rows)
    ended = F.col(CHANGE) == "closed"
    warehouse.write_parts(rows.where(~ended), target, parts, run_ts, notes, closed=rows.where(ended))
    return counts


def highest_key(warehouse: Warehouse, table: str, surrogate: str) -> int:
    """The highest surrogate key given so far: noted by the last write, or else looked up."""
    noted = warehouse.commit(table).notes.get("highest")
    return int(noted) if noted else warehouse.read(table).agg(F.coalesce(F.max(surrogate), F.lit(0))).first()[0]


def load_dim(warehouse: Warehouse, name: str, run_ts: datetime) -> dict[str, int]:
    """Bring one gold dimension up to its silver table: to the buckets of it written since the last time."""
    target = f"gold.{name}"
    if name == "dim_date":
        built = dimensions.build_dim_date(dimensions.date_bounds(warehouse.spark))
        counts = _written(built, lambda df: warehouse.replace(df, target, run_ts), inserted=F.count(F.lit(1)))
        return {**counts, "updated": 0}
    source = {"dim_customer": "silver.customers", "dim_product": "silver.products", "dim_seller": "silver.sellers"}[name]
    now = warehouse.commit(source)
    seen = warehouse.commit(source, int(warehouse.commit(target).notes.get("source", 0)))
    notes = {"source": str(now.version)}
    parts = now.since(seen)
    if not parts:
        return {"inserted": 0, "updated": 0}
    incoming = warehouse.read(source, parts)
    if name == "dim_product":
        incoming = settled(incoming)
        touched, highest = warehouse.parts_of(target, incoming), highest_key(warehouse, target, "product_key")
        built = dimensions.build_dim_product(incoming, warehouse.read(target, touched), run_ts, highest)
        top = F.coalesce(F.max("product_key"), F.lit(0))
        notes["highest"] = str(max(highest, built.agg(top).first()[0]))
        replaced = F.count_if(F.col("updated_at") == moment(run_ts))
        counts = _written(
            built, lambda df: warehouse.write_parts(df, target, touched, run_ts, notes), inserted=replaced
        )
        return {**counts, "updated": 0}
    key, surrogate, columns = (
        ("customer_id", "customer_key", dimensions.CUSTOMER)
        if name == "dim_customer"
        else ("seller_id", "seller_key", dimensions.SELLER)
    )
    return merge_versions(warehouse, target, incoming.where("is_current").select(*columns), key, run_ts, surrogate, notes)


#: Items or sales that a full build of the fact or the mart joins at a time, unless the session says otherwise in this
#: setting: what its shuffles need of disk is theirs (some 200 bytes each), not that of the whole table.
SLICE, SLICE_SETTING = 32_000_000, "spark.tidemark.slice"


def _slices(rows: DataFrame, part: Column) -> list[list[int]]:
    """The parts that rows belong to, as many together as hold a slice of them, or one; none if all rows are one slice.
    Rows whose part is NULL are in none."""
    limit = int(rows.sparkSession.conf.get(SLICE_SETTING, str(SLICE)))
    if rows.count() <= limit:  # by the files' own counts
        return []
    found = rows.where(part.isNotNull()).groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()
    slices: list[list[int]] = []
    held = limit
    for row in found:
        if held + row["n"] > limit:
            slices.append([])
            held = 0
        slices[-1].append(row["part"])
        held += row["n"]
    return slices


DIMENSION_KEYS = {"dim_customer": "customer_key", "dim_product": "product_key", "dim_seller": "seller_key"}


def load_fact(
    warehouse: Warehouse, run_ts: datetime, batches: list[str] | None = None, rebuild: bool = False
) -> dict[str, int]:
    """Bring the fact up to silver and the dimensions, from the given silver batches or from those in force: the last
    full load of a table takes the place of all loaded before it.

    If every load that the fact was built from is still in force, only the orders that something has changed for
    are built anew, and only the months they were or are in are written; else, or on request, all of it, by as many
    buckets of the orders at a time as hold a slice of the items.
    """
    runs = warehouse.read("metadata.pipeline_runs")

    def in_force(table: str) -> tuple[DataFrame, dict[str, str]]:
        """The rows of the loads in force, and when each was loaded: an entry per load since the last full one."""
        df = warehouse.read(table)
        if batches is not None:
            return df.where(F.col("batch_id").isin(batches)), dict.fromkeys(batches, "given")
        loads = loads_of(runs, table.split(".")[1])
        present = df.select(F.col("batch_id").alias("batch")).distinct().join(superseded(loads), "batch", "left_anti")
        rows = present.join(loads, "batch", "left").groupBy("batch").agg(F.max("start_time").cast("string").alias("at"))
        found = {r["batch"]: r["at"] or "" for r in rows.collect()}
        return df.where(F.col("batch_id").isin(list(found))), found

    target = "gold.fact_sales"
    known = warehouse.commit(target)
    items, item_loads = in_force("silver.order_items")
    payments, payment_loads = in_force("silver.payments")
    orders = warehouse.read("silver.orders")
    dims = {name: warehouse.read(f"gold.{name}") for name in DIMENSION_KEYS}
    order_commit = warehouse.commit("silver.orders")
    highest = {name: highest_key(warehouse, f"gold.{name}", key) for name, key in DIMENSION_KEYS.items()}
    notes = {
        "orders": str(order_commit.version), "items": json.dumps(item_loads), "payments": json.dumps(payment_loads),
        **{name: str(n) for name, n in highest.items()},
    }
    start = int(known.notes.get("highest", 0))

    def written(pieces: list[Callable[[int], DataFrame]], parts: list[int] | None, count: Column) -> dict[str, int]:
        """Write pieces one after the other, each a function of the highest key given before it."""
        seen = {"top": start, "inserted": 0}

        def observed() -> Iterator[DataFrame]:
            for piece in pieces:
                top = Observation()
                yield piece(seen["top"]).observe(top, F.max("sales_key").alias("top"), count.alias("inserted"))
                seen["top"] = max(seen["top"], top.get["top"] or 0)
                seen["inserted"] += top.get["inserted"]

        # The highest key is known when the rows are written, so it is noted by a commit of its own.
        warehouse.write_parts(observed(), target, parts, run_ts, notes)
        warehouse.note(target, {"highest": str(seen["top"])}, run_ts)
        return {"inserted": seen["inserted"]}

    before = [json.loads(known.notes.get(k, "{}")) for k in ("items", "payments")]
    stands = all(now.get(b) == at for was, now in zip(before, (item_loads, payment_loads), strict=True) for b, at in was.items())
    earlier = warehouse.commit("silver.orders", int(known.notes.get("orders", 0)))
    if rebuild or not known.version or not stands or earlier.buckets != order_commit.buckets:
        of_order = warehouse.part_of("silver.orders")  # an item whose order is unknown has a bucket, too

        def piece(items: DataFrame, orders: DataFrame, payments: DataFrame) -> Callable[[int], DataFrame]:
            fact = build_fact_sales(items, orders, payments, *[dims[n] for n in DIMENSION_KEYS])
            return lambda top: with_sales_keys(fact, top, run_ts)

        pieces = [
            piece(items.where(of_order.isin(some)), warehouse.read("silver.orders", some), payments.where(of_order.isin(some)))
            for some in _slices(items, F.when(F.col("order_id").isNotNull(), of_order))
        ]
        return written(pieces or [piece(items, orders, payments)], None, F.count(F.lit(1)))

    moved = order_commit.since(earlier)
    changed = increment.differing(
        warehouse.read("silver.orders", moved, earlier.version), warehouse.read("silver.orders", moved),
        ["order_id"], ["customer_id", "order_status", "delivery_days", "is_late_delivery", "order_purchase_timestamp", "order_delivered_at"],
    )

    def added(df: DataFrame, was: dict[str, str]) -> DataFrame:
        return df.where(~F.col("batch_id").isin(list(was))) if was else df

    fresh = {
        name: df.where(F.col(DIMENSION_KEYS[name]) > int(known.notes.get(name, 0)))
        for name, df in dims.items()
    }
    # For a dimension without a new key no order or item is looked through.
    fresh = {name: None if rows.isEmpty() else rows for name, rows in fresh.items()}
    with shuffles_dropped(warehouse.spark):
        affected = settled(
            increment.affected_orders(
                changed, added(items, before[0]), added(payments, before[1]), orders, items,
                fresh["dim_customer"], fresh["dim_product"], fresh["dim_seller"],
            )
        )
        rebuilt = settled(increment.rebuilt_orders(affected, items, orders, payments, *[dims[n] for n in DIMENSION_KEYS]))
    old = warehouse.read(target).select("order_id", "order_date_key").join(affected, "order_id", "left_semi")
    months = sorted({*increment.months_of(old), *increment.months_of(rebuilt)})
    if not months:
        warehouse.note(target, notes, run_ts)
        return {"inserted": 0}
    kept = warehouse.read(target, months).join(affected, "order_id", "left_anti")
    return written(
        [lambda top: kept.unionByName(with_sales_keys(rebuilt, top, run_ts))], months, F.count_if(F.col("created_at") == moment(run_ts))
    )


def load_mart(warehouse: Warehouse, run_ts: datetime, rebuild: bool = False) -> dict[str, int]:
    """Bring the mart up to the fact. Months are summed from the fact where it, or a product's category, changed;
    later months go on from the state at the end of the month before, and are written only if a figure differs."""
    target, state = "gold.revenue_mart", "gold.mart_state"
    fact, known = warehouse.commit("gold.fact_sales"), warehouse.commit(target)
    sources = ["gold.dim_product", "gold.dim_date"]
    now = {s: warehouse.commit(s) for s in sources}
    notes = {"gold.fact_sales": str(fact.version), **{s: str(c.version) for s, c in now.items()}}
    products, dates = warehouse.read("gold.dim_product"), warehouse.read("gold.dim_date")
    customers = warehouse.read("gold.dim_customer")
    states = warehouse.commit(state)
    whole = rebuild or not known.version or known.notes.get("gold.dim_date") != notes["gold.dim_date"]
    whole = whole or states.notes.get("mart") != str(known.version)
    if whole:
        months = set(fact.parts)
    else:
        months = set(fact.since(warehouse.commit("gold.fact_sales", int(known.notes["gold.fact_sales"]))))
        seen = warehouse.commit("gold.dim_product", int(known.notes["gold.dim_product"]))
        parts = now["gold.dim_product"].since(seen)
        if parts:
            column = ["product_key", "product_category_english"]
            moved = increment.differing(
                warehouse.read("gold.dim_product", parts, seen.version).select(*column),
                products.select(*column) if seen.buckets != now["gold.dim_product"].buckets else warehouse.read("gold.dim_product", parts).select(*column),
                ["product_key"], ["product_category_english"],
            )
            sold = warehouse.read("gold.fact_sales").select("order_date_key", "product_key")
            months |= set(increment.months_of(sold.join(moved, "product_key", "left_semi")))
    months.discard(0)  # no date, no month
    if not months and not whole:
        warehouse.note(target, notes, run_ts)
        warehouse.note(state, {"mart": str(warehouse.version(target))}, run_ts)
        return {"inserted": 0}
    first = min(months, default=0)
    opened = max((p for p in states.parts if p < first), default=None) if not whole else None
    opening = None if opened is None else warehouse.read(state, [opened])
    later = [] if whole else sorted(p for p in known.parts if p >= first and p not in months)

    def sums_of(some: list[int]) -> DataFrame:
        return revenue_by_month(warehouse.read("gold.fact_sales", some), dates, customers, products)

    stored = warehouse.read(target, later)
    with shuffles_dropped(warehouse.spark):
        slices = _slices(warehouse.read("gold.fact_sales", sorted(months)), F.expr(MONTHLY["gold.fact_sales"]))
        sums = reduce(DataFrame.unionByName, [settled(sums_of(s)) for s in slices]) if slices else sums_of(sorted(months))
        rows = settled(with_metrics(sums.unionByName(stored.select(*sums.columns)), run_ts, opening))
    present = sorted(r[0] for r in rows.select(F.expr(MONTHLY[target])).distinct().collect())
    touched = months
    if later:
        figures = [c for c in rows.columns if c != "computed_at"]
        of_later = rows.where(F.expr(MONTHLY[target]).isin(later))
        odd = increment.differing(stored, of_later, ["year", "month"], figures)
        touched = months | {r["year"] * 100 + r["month"] for r in odd.collect()}
    out = rows if whole else rows.where(F.expr(MONTHLY[target]).isin(sorted(touched)))
    counts = _written(
        out, lambda df: warehouse.write_parts(df, target, None if whole else sorted(touched), run_ts, notes), inserted=F.count(F.lit(1))
    )
    of_months = month_states(rows, present, opening) if present else warehouse.read(state).limit(0)
    replaced = None if whole else sorted({*present, *(p for p in states.parts if p >= first)})
    warehouse.write_parts(of_months, state, replaced, run_ts, {"mart": str(warehouse.version(target))})
    return counts


def load_kpis(warehouse: Warehouse, run_ts: datetime) -> dict[str, int]:
    kpis = build_kpi_summary(
        warehouse.read("gold.fact_sales"),
        warehouse.read("gold.dim_customer"),
        warehouse.read("gold.dim_product"),
        warehouse.read("gold.revenue_mart"),
        run_ts.date(),
        run_ts,
    )
    return _written(kpis, lambda df: warehouse.replace(df, "gold.kpi_summary", run_ts), inserted=F.count(F.lit(1)))


def seed_lookups(warehouse: Warehouse, run_ts: datetime) -> None:
    """Write the lookup tables and the date dimension unless they are there."""
    if not warehouse.exists("silver.state_lookup"):
        warehouse.replace(lookups.state_lookup(warehouse.spark), "silver.state_lookup", run_ts)
    if not warehouse.exists("silver.category_lookup"):
        warehouse.replace(lookups.category_lookup(warehouse.spark), "silver.category_lookup", run_ts)
    if not warehouse.exists("gold.dim_date"):
        load_dim(warehouse, "dim_date", run_ts)


class _Recorder:
    """Runs the steps of a layer one by one, each as a recorded run of its own."""

    def __init__(self, spark: SparkSession, root: str, batch_id: str):
        ensure_checkpoint_dir(spark)  # before the first step, not in the middle of one
        self.warehouse = Warehouse(spark, root)
        self.outcome = Outcome(batch_id)

    def step(self, name: str, work: Callable[[], dict[str, int]], **labels) -> None:
        run_id = f"{self.outcome.batch_id}.{name}"
        layer = name.split(".")[0]
        try:
            with PipelineRun(self.warehouse, name, layer=layer, target_table=name, batch_id=run_id, **labels) as record:
                counts = work()
                record.records_read = counts.get("read", 0)
                record.records_inserted = counts.get("inserted", 0)
                record.records_updated = counts.get("updated", 0)
                record.records_rejected = counts.get("rejected", 0)
            self.outcome.rows[name] = counts.get("inserted", 0) + counts.get("updated", 0)
        except Exception as error:  # noqa: BLE001 - recorded, and the other tables go on
            self.outcome.errors[name] = f"{type(error).__name__}: {error}"


def run_bronze(
    spark: SparkSession,
    raw_dir: str,
    root: str,
    run_ts: datetime,
    sources: list[Source] | None = None,
    incremental: bool = False,
    batch_id: str | None = None,
) -> Outcome:
    """Check the raw files and load them. `incremental` reads, from sources that have a watermark
    column, only the rows after their watermark."""
    recorder = _Recorder(spark, root, batch_id or new_batch_id("bronze", run_ts))
    warehouse, batch = recorder.warehouse, recorder.outcome.batch_id

    def ingest(source: Source) -> dict[str, int]:
        seen = Observation()
        df = source.read(spark, raw_dir, seen)
        if incremental and source.watermark_col:
            df = newer_than(df, source.watermark_col, get_watermark(warehouse, source.table))
        return load_bronze(warehouse, df, source, batch, run_ts, seen)

    for source in SOURCES if sources is None else sources:
        recorder.step(
            f"bronze.{source.table}", lambda s=source: ingest(s), source_system=source.system,
            source_table=source.file, run_mode="INCREMENTAL" if incremental else "FULL",
        )
    return recorder.outcome


def run_silver(spark: SparkSession, root: str, run_ts: datetime, batch_id: str | None = None) -> Outcome:
    """Bring silver up to a bronze batch; without one, to the batch that each table loaded last."""
    recorder = _Recorder(spark, root, batch_id or new_batch_id("silver", run_ts))
    warehouse = recorder.warehouse
    seed_lookups(warehouse, run_ts)

    def transform(table: str) -> dict[str, int]:
        return load_silver(warehouse, table, batch_id or latest_load(warehouse, table), run_ts)

    for table in SOURCE_COLUMNS:
        recorder.step(f"silver.{table}", lambda t=table: transform(t), source_table=f"bronze.{table}")
    return recorder.outcome


def run_gold(spark: SparkSession, root: str, run_ts: datetime, batch_id: str | None = None) -> Outcome:
    """Rebuild the gold layer from silver: dimensions, fact, mart and key figures."""
    recorder = _Recorder(spark, root, batch_id or new_batch_id("gold", run_ts))
    warehouse = recorder.warehouse
    seed_lookups(warehouse, run_ts)
    for name in ("dim_customer", "dim_product", "dim_seller"):
        recorder.step(f"gold.{name}", lambda n=name: load_dim(warehouse, n, run_ts))
    recorder.step("gold.fact_sales", lambda: load_fact(warehouse, run_ts))
    recorder.step("gold.revenue_mart", lambda: load_mart(warehouse, run_ts))
    recorder.step("gold.kpi_summary", lambda: load_kpis(warehouse, run_ts))
    return recorder.outcome


def run(
    spark: SparkSession,
    raw_dir: str,
    root: str,
    run_ts: datetime,
    sources: list[Source] | None = None,
    incremental: bool = False,
    batch_id: str | None = None,
) -> Outcome:
    """Bronze, silver and gold in turn, under one batch id, and then the SQL names of all tables.
    A table that fails is recorded and the others go on."""
    whole = Outcome(batch_id or new_batch_id("full_run", run_ts))
    for part in (
        run_bronze(spark, raw_dir, root, run_ts, sources, incremental, whole.batch_id),
        run_silver(spark, root, run_ts, whole.batch_id),
        run_gold(spark, root, run_ts, whole.batch_id),
    ):
        whole.rows.update(part.rows)
        whole.errors.update(part.errors)
    Warehouse(spark, root).publish()
    return whole


# The tables a summary counts.
SUMMARY_TABLES = [
    "bronze.customers", "bronze.orders", "bronze.products", "bronze.order_items", "bronze.sellers", "bronze.payments",
    "silver.customers", "silver.orders", "silver.products", "silver.order_items",
    "gold.dim_customer", "gold.dim_product", "gold.dim_seller", "gold.fact_sales", "gold.revenue_mart", "gold.kpi_summary",
]


def summary(warehouse: Warehouse) -> dict[str, DataFrame]:
    """Rows per table, the latest runs, and checks passed and failed per table."""
    return {
        "tables": reports.row_counts({t: warehouse.read(t) for t in SUMMARY_TABLES}),
        "runs": reports.recent_runs(run_states(warehouse.read("metadata.pipeline_runs"))),
        "checks": reports.dq_report(warehouse.read("metadata.dq_results")),
    }


__all__ = [
    "EXPORTED", "MANUAL_SOURCES", "SOURCES", "Outcome", "Source", "run", "run_bronze", "run_gold", "run_silver",
    "summary",
]
