"""The queries, each a function of the session and the folder of the test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark import pipeline, schemas
from tidemark.catalog import tables as t
from tidemark.functions.moments import moment
from tidemark.operators import audit, history, quality, rejects
from tidemark.plans import dimensions, fact, kpis, mart, reports, silver
from tidemark.runs import PipelineRun, last_schema, last_watermarks, log_schema_changes, run_states, superseded
from tidemark.session import ensure_checkpoint_dir, settled, shuffles_dropped, written
from tidemark.sources import leaf_fields, newer_than, read_csv, read_json, read_query, read_table, read_xml
from tidemark.warehouse import CSV_OPTIONS, Warehouse

RUN_TS = datetime(2024, 6, 1, 12, 0, 0)
AS_OF = date(2024, 6, 1)
BATCH = "DAILY_20240601_120000_0A1B2C3D"
GROWTH_STATE = "NATION_3"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


# Quality checks ---------------------------------------------------------------------------------

LINE_KEYS = ["l_orderkey", "l_linenumber"]
LINE_ORDER = [
    "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus",
]


def _lines(spark: SparkSession, d: str) -> DataFrame:
    """Line items of which some lack a flag and some have a blank status."""
    blank = (F.col("l_linestatus") == "F") & (F.col("l_returnflag") == "A")
    return t.placed(spark, d, "lineitem").withColumns(
        {
            "l_returnflag": F.nullif(F.col("l_returnflag"), F.lit("N")),
            "l_linestatus": F.when(blank, " \t").otherwise(F.col("l_linestatus")),
        }
    )


def _on_lines(spark: SparkSession, d: str) -> quality.Validator:
    return quality.Validator(_lines(spark, d), "bronze.lineitem", BATCH, order_by=LINE_ORDER)


def _events(spark: SparkSession, d: str) -> quality.Validator:
    """Events whose errors carry a word instead of a number."""
    events = t.table(spark, d, "events").select(
        F.col("user_id").cast("string").alias("user_id"),
        "event_type",
        F.when(F.col("event_type") == "error", F.lit("1.0d")).otherwise(F.col("value").cast("string")).alias("value"),
        "props",
    )
    return quality.Validator(events, "bronze.events", BATCH)


@query
def dq_null_check(spark, d):
    return _on_lines(spark, d).check_nulls(["l_returnflag", "l_linestatus", "no_such_column"]).results(RUN_TS)


@query
def dq_unique_check(spark, d):
    return _on_lines(spark, d).check_unique(LINE_KEYS).results(RUN_TS)


@query
def dq_numeric_check(spark, d):
    return _events(spark, d).check_numeric(["value", "user_id", "event_type"]).results(RUN_TS)


@query
def dq_domain_check(spark, d):
    return _events(spark, d).check_value_in_set("event_type", ["click", "view", "c", "d", "e", "f", "g"]).results(RUN_TS)


@query
def dq_min_rows(spark, d):
    return _events(spark, d).check_min_rows(1).check_min_rows(1_000_000_000, "WARNING").results(RUN_TS)


@query
def dq_limits(spark, d):
    checks = _events(spark, d).check_lengths({"event_type": 5, "props": 100, "user_id": 2})
    return checks.check_precision({"value": (3, 2), "user_id": (6, 0)}).results(RUN_TS)


def _all_rules(spark: SparkSession, d: str) -> quality.Validator:
    checks = _on_lines(spark, d).check_nulls(["l_returnflag", "l_linestatus"]).check_unique(LINE_KEYS)
    checks.check_nulls(["l_shipdate"], "WARNING").check_value_in_set("l_linestatus", ["F", "O"])
    return checks.check_min_rows(1)


@query
def dq_results(spark, d):
    return _all_rules(spark, d).results(RUN_TS)


@query
def dq_valid(spark, d):
    return _all_rules(spark, d).valid()


@query
def dq_rejected(spark, d):
    return _all_rules(spark, d).rejected()


@query
def reject_records(spark, d):
    customers = t.raw_customers(spark, d)
    checks = quality.Validator(customers, "customers", BATCH, order_by=["customer_id"]).check_unique(["state"])
    return rejects.reject_records(checks.rejected(), "customers", BATCH, RUN_TS)


@query
def dq_key_unique(spark, d):
    return quality.repeated_keys(t.table(spark, d, "lineitem"), LINE_KEYS)


@query
def dq_one_current(spark, d):
    """Parts as versions of their name, the dear ones current."""
    versions = t.table(spark, d, "part").select("p_name", (F.col("p_retailprice") > 950).alias("is_current"))
    return quality.repeated_current_keys(versions, "p_name")


@query
def dq_fk_orphans(spark, d):
    """Fact keys that smaller dimensions lack."""
    keys = ["product_key", "customer_key", "seller_key", "delivery_date_key"]
    sales = fact_sales(spark, d).select(*keys)
    products = t.products(spark, d).where("product_category_name <> 'promo'")
    customers = t.customers(spark, d).where("region <> 'ASIA'")
    sellers = t.sellers(spark, d).where("region <> 'EUROPE'")
    return quality.orphan_keys(
        sales,
        {
            "product_key": (products, "product_key"),
            "customer_key": (customers, "customer_key"),
            "seller_key": (sellers, "seller_key"),
            "delivery_date_key": (_dim_date(spark, d).where("year < 1999"), "date_key"),
        },
    )


@query
def dq_precision_rejects(spark, d):
    """Line items of which some cost more than their column holds; what is no number stays."""
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    items = t.table(spark, d, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_linenumber").cast("string").alias("order_item_id"),
        F.when(F.col("l_returnflag") == "A", (price * 1000000).cast("string"))
        .when(F.col("l_returnflag") == "R", F.lit("dear"))
        .otherwise(price.cast("string"))
        .alias("price"),
    )
    checks = quality.Validator(items, "order_items", BATCH, order_by=["order_id", "order_item_id"])
    return checks.check_precision({"price": (12, 2)}, "ERROR").rejected()


# Bronze and sources -----------------------------------------------------------------------------


def _scratch(spark: SparkSession) -> Warehouse:
    """A warehouse of one query's own, below the checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return Warehouse(spark, f"{spark.sparkContext.getCheckpointDir()}/warehouse-{uuid.uuid4().hex}")


@query
def batch_replaced(spark, d):
    """Payments written in four batches, of which one comes again with fewer rows and one with none."""
    warehouse = _scratch(spark)
    paid = t.payments(spark, d).withColumn("batch_id", F.lpad(F.pmod("payment_value", F.lit(4)).cast("int").cast("string"), 4, "0"))
    paid = settled(paid)
    for batch in ("0000", "0001", "0002", "0003"):
        warehouse.write_batch(paid.where(F.col("batch_id") == batch), "silver.payments", batch)
    warehouse.write_batch(paid.where("batch_id = '0001' and payment_value < 100000"), "silver.payments", "0001")
    warehouse.write_batch(paid.limit(0), "silver.payments", "0002")
    return warehouse.read("silver.payments").select("order_id", "payment_value", "batch_id")


@query
def fact_batches(spark, d):
    """Years as loads, the even ones full: in force are the last full one and what came after it."""
    loads = t.table(spark, d, "orders").groupBy(F.year("o_orderdate").alias("y")).agg(F.max("o_orderdate").alias("start_time"))
    loads = loads.select(
        F.col("y").cast("string").alias("batch"),
        F.when(F.col("y") % 2 == 0, "FULL").otherwise("INCREMENTAL").alias("run_mode"),
        "start_time",
    )
    return loads.select("batch").join(superseded(loads), "batch", "left_anti")


@query
def upsert_last_in_file(spark, d):
    """Orders as states of their customer, in the order of a file: the last one stands, not the greatest."""
    place = [F.lit("f").alias("source_file"), F.lit(0).alias("source_block"), F.col("o_orderkey").alias("source_row")]
    states = t.table(spark, d, "orders").select(
        F.col("o_custkey").cast("string").alias("order_id"), F.col("o_orderstatus").alias("order_status"), *place
    )
    existing = states.select("order_id", "order_status").limit(0)
    return history.upsert(existing, states, ["order_id"], order_by=schemas.FILE_ORDER)




@query
def bronze_order_items(spark, d):
    """Audit columns, then the target's columns: `colour` is dropped, `seller_id` is missing."""
    items = t.raw_order_items(spark, d).drop("seller_id").withColumn("colour", F.lit("red"))
    audited = audit.add_audit_columns(items, "CSV", BATCH, RUN_TS, "/raw/2024/order_items.csv")
    return audit.align_columns(audited, schemas.schema_of("bronze.order_items"))


def _batches(spark: SparkSession, d: str) -> DataFrame:
    """Orders loaded in monthly batches, the unfinished ones rejected."""
    return t.table(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.date_format("o_orderdate", "'B'yyyyMM").alias("batch_id"),
        F.col("o_orderdate").alias("load_timestamp"),
        (F.col("o_orderstatus") == "P").alias("is_rejected"),
    )


@query
def batch_latest(spark, d):
    return silver.latest_slice(_batches(spark, d))


@query
def batch_slice(spark, d):
    return silver.batch_slice(_batches(spark, d), "B199707")


def _files(spark: SparkSession, lines: DataFrame, kind: str = "text") -> str:
    """Write a given table as raw files for the readers; returns the folder."""
    return written(lines, kind)


#: Bytes of a file that lines are written to: more than a byte range, so that several tasks have to cut it.
FILE_BYTES = 256 << 20


def _enclosed(spark: SparkSession, lines: DataFrame, first: str, last: str | None = None) -> str:
    """Write the lines in `value` between a first and a last one, as files of about `FILE_BYTES`: the task that
    writes a file holds its lines and no others."""
    size = lines.agg(F.coalesce(F.sum(F.octet_length("value").cast("bigint")), F.lit(0))).first()[0]
    files = 1 + size // FILE_BYTES
    file = (F.monotonically_increasing_id() % files).cast("int").alias("file")
    ends = [F.struct(F.lit(text).alias("value"), F.lit(n).alias("n")) for text, n in ((first, 0), (last, 2)) if text is not None]
    edges = spark.range(files).select(F.col("id").cast("int").alias("file"), F.explode(F.array(*ends)).alias("e")).select("e.*", "file")
    every = lines.select("value", F.lit(1).alias("n"), file).unionByName(edges)
    return _files(spark, every.repartitionById(files, "file").sortWithinPartitions("n").select("value"))


@query
def csv_roundtrip(spark, d):
    """Documents as CSV, whose texts have line breaks, quotes and commas in one field, and back."""
    documents = t.table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), "lang", "text")
    cells = [F.concat(F.lit('"'), F.replace(F.coalesce(c, F.lit("")), F.lit('"'), F.lit('""')), F.lit('"')) for c in documents.columns]
    # Large files with a header each, so that several tasks have to cut them.
    path = _enclosed(spark, documents.select(F.concat_ws(",", *cells).alias("value")), "doc_id,lang,text")
    back = read_csv(spark, path)
    return back.select("doc_id", "lang", F.length("text").alias("n_chars"), F.sha2("text", 256).alias("text_sha256"))


@query
def json_props(spark, d):
    """Events as large JSON lists with their properties nested in them, and back, flattened."""
    events = t.table(spark, d, "events").select(
        F.to_json(F.struct("event_id", "event_type", F.from_json("props", "map<string,string>").alias("props"))).alias("value")
    )
    # Objects over several lines, and a list's commas and brackets.
    laid_out = events.select(F.concat(F.replace("value", F.lit(","), F.lit(",\n  ")), F.lit(",")).alias("value"))
    path = _enclosed(spark, laid_out, "[", '{"event_id": null}\n]')
    back = read_json(spark, path).where("event_id IS NOT NULL")
    names = sorted(c for c in back.columns if c.startswith("props."))
    props = F.array_join(F.filter(F.array(*[F.concat(F.lit(c[6:] + "="), F.col(f"`{c}`")) for c in names]), lambda x: x.isNotNull()), ";")
    return back.select(F.col("event_id").cast("bigint").alias("event_id"), "event_type", props.alias("props"))


@query
def xml_parts(spark, d):
    """Parts as XML records; elements of the same tag inside a record, or in a group beside them, are none."""
    part = t.table(spark, d, "part")
    text = [F.concat(F.lit(f"<{c}>"), F.replace(F.col(c).cast("string"), F.lit("&"), F.lit("&amp;")), F.lit(f"</{c}>")) for c in ("p_partkey", "p_name", "p_type")]
    nested = F.concat(F.lit("<part>\n "), *text, F.lit("\n <part>of a part</part></part>"))
    grouped = F.concat(F.lit("<group>"), nested, F.lit("</group>"))
    record = F.when(F.col("p_type") == "PROMO", grouped).otherwise(nested)
    path = _enclosed(spark, part.select(record.alias("value")), "<?xml version='1.0'?>\n<!-- <part> -->\n<parts>", "</parts>")
    return read_xml(spark, path, record_tag="part", columns=["p_partkey", "p_name", "p_type"])


@query
def json_bad_records(spark, d):
    """Payments as JSON of which some miss a colon: those are rejected with their text, the others are loaded."""
    warehouse = _scratch(spark)
    paid = t.raw_payments(spark, d)
    text = F.to_json(F.struct(*paid.columns))
    broken = F.when(F.col("payment_installments") == "3", F.replace(text, F.lit('"payment_value":'), F.lit('"payment_value" '))).otherwise(text)
    folder = _files(spark, paid.select(F.concat(broken, F.lit("\n")).alias("value")))
    source = next(s for s in pipeline.SOURCES if s.table == "payments")
    pipeline.load_bronze(warehouse, source.read_files(spark, folder), source, BATCH, RUN_TS)
    loaded = warehouse.read("bronze.payments").select("order_id", F.lit(None).cast("string").alias("reject_reason"), F.lit(None).cast("string").alias("raw"))
    raw = F.get_json_object("raw_data", "$._bad_record")
    return loaded.unionByName(
        warehouse.read("bronze.rejected_records").select(F.lit(None).cast("string").alias("order_id"), "reject_reason", raw.alias("raw"))
    )


@query
def schema_changes(spark, d):
    """Events as JSON in three loads: views only, then with the errors, whose properties have a level, then clicks
    without a type. The log has each nested field's coming and going once."""
    warehouse, declared = _scratch(spark), schemas.text_schema(["event_id", "event_type"])
    events = t.table(spark, d, "events").select("event_id", "event_type", F.from_json("props", "map<string,string>")["k"].alias("k"))
    props = F.struct("k", F.when(F.col("event_type") == "error", F.struct(F.lit(1).alias("level"))).alias("cause"))
    whole = F.to_json(F.struct("event_id", "event_type", props.alias("props")))
    loads = [events.where("event_type = 'view'"), events, events.where("event_type = 'click'").withColumn("event_type", F.lit(None).cast("string"))]
    for day, rows in enumerate(loads):
        seen, at = Observation(), RUN_TS + timedelta(days=day)
        path = _files(spark, rows.select(whole.alias("value")))
        read_json(spark, path, columns=declared.names, lines=True, seen=seen).write.format("noop").mode("overwrite").save()
        before = last_schema(warehouse.read("metadata.schema_changes"), "bronze.events", declared)
        log_schema_changes(warehouse, "bronze.events", before, leaf_fields(seen.get["schema"]), f"B{day}", at)
    return warehouse.read("metadata.schema_changes")


@query
def json_records(spark, d):
    """Orders as one document per customer, with the list of them inside: the list's elements are the rows."""
    orders = t.table(spark, d, "orders").select("o_custkey", F.struct(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status")).alias("o"))
    whole = orders.groupBy("o_custkey").agg(F.collect_list("o").alias("orders"))
    path = _files(spark, whole.select(F.to_json(F.struct("o_custkey", "orders")).alias("value")))
    return read_json(spark, path, record_path="orders", lines=True).select(F.col("id").cast("bigint").alias("id"), "status")


@query
def json_null_texts(spark, d):
    """Parts whose types say in words that there is none."""
    words = F.when(F.col("p_type") == "PROMO", "None").when(F.col("p_type") == "SMALL", "nan").otherwise(F.col("p_type"))
    path = _files(spark, t.table(spark, d, "part").select(F.to_json(F.struct("p_partkey", words.alias("p_type"))).alias("value")))
    return read_json(spark, path, lines=True).select(F.col("p_partkey").cast("bigint").alias("p_partkey"), "p_type")


def _loaded_items(spark: SparkSession, d: str) -> Warehouse:
    """Line items loaded from CSV, of which those that were returned lack their seller."""
    warehouse = _scratch(spark)
    items = t.raw_order_items(spark, d)
    seller = F.when(F.col("price").endswith("d"), F.lit("")).otherwise(F.col("seller_id"))
    path = f"{warehouse.root}/raw"
    items.withColumn("seller_id", seller).write.options(**CSV_OPTIONS).csv(path)
    source = next(s for s in pipeline.SOURCES if s.table == "order_items")
    with PipelineRun(warehouse, "bronze.order_items", batch_id=BATCH, source_table="order_items", clock=lambda: RUN_TS) as run:
        counts = pipeline.load_bronze(warehouse, source.read_files(spark, path), source, BATCH, RUN_TS)
        run.records_read, run.records_inserted, run.records_rejected = counts["read"], counts["inserted"], counts["rejected"]
    return warehouse


@query
def bronze_load(spark, d):
    return _loaded_items(spark, d).read("bronze.order_items").select(*schemas.SOURCE_COLUMNS["order_items"], "source_system", "batch_id", "load_timestamp", "is_rejected")


@query
def bronze_rejects_csv(spark, d):
    """The rejected rows as the CSV that is written beside the table."""
    warehouse = _loaded_items(spark, d)
    folder = f"{warehouse.root}/rejected/order_items_{BATCH}_{RUN_TS:%Y%m%d_%H%M%S}_rejected.csv"
    return read_csv(spark, folder).select("order_id", "order_item_id", "product_id", "price", "reject_reason")


@query
def run_record(spark, d):
    """The record of a load with rejects, its error log being empty, and the watermark it set."""
    warehouse = _loaded_items(spark, d)
    state = run_states(warehouse.read("metadata.pipeline_runs"))
    mark = last_watermarks(warehouse.read("metadata.watermarks")).where("source_table = 'order_items'").select("last_loaded_value")
    errors = warehouse.read("metadata.error_log").agg(F.count(F.lit(1)).alias("errors"))
    columns = ["batch_id", "pipeline_name", "status", "total_records_read", "records_inserted", "records_rejected"]
    return state.select(*columns).join(F.broadcast(mark)).join(F.broadcast(errors))  # one row each


@query
def csv_export(spark, d):
    """A dimension exported as CSV, and read back."""
    warehouse = _scratch(spark)
    warehouse.replace(t.products(spark, d), "gold.dim_product", RUN_TS)
    warehouse.export_csv(f"{warehouse.root}/export", ["gold.dim_product"])
    return read_csv(spark, f"{warehouse.root}/export/dim_product").select("product_key", "product_id", "product_category_name", "product_volume_cm3")


@query
def table_reloaded(spark, d):
    """A table written whole, and again with fewer rows."""
    warehouse = _scratch(spark)
    places = t.places(spark, d).select("state_code", "state_name", "region")
    warehouse.replace(places, "silver.state_lookup", RUN_TS)
    warehouse.replace(places.where("region <> 'ASIA'"), "silver.state_lookup", RUN_TS)
    return warehouse.read("silver.state_lookup")


@query
def incremental_filter(spark, d):
    return newer_than(t.raw_orders(spark, d), "order_delivered_at", "1998-03-15 12:00:00")


@query
def table_topk(spark, d):
    return read_table(
        t.table(spark, d, "lineitem"),
        columns=["l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "l_extendedprice"],
        where="l_returnflag = 'A' AND l_quantity > 10",
        watermark_col="l_shipdate",
        watermark_value="1998-01-01 00:00:00",
        limit=100,
    )


@query
def table_filtered(spark, d):
    return read_table(
        t.table(spark, d, "events"), columns=["event_id", "ts", "value"], where=F.col("event_type") == "click",
        watermark_col="ts", watermark_value="2024-01-05 00:00:00",
    )


@query
def parameter_query(spark, d):
    t.table(spark, d, "orders").createOrReplaceTempView("tidemark_orders")
    return read_query(
        spark,
        "SELECT o_orderpriority, count(*) AS orders FROM tidemark_orders "
        "WHERE o_orderstatus = :status GROUP BY o_orderpriority",
        {"status": "F"},
    )


# Silver -----------------------------------------------------------------------------------------


@query
def silver_customers(spark, d):
    return silver.transform_customers(t.raw_customers(spark, d), BATCH, AS_OF, t.places(spark, d))


@query
def silver_sellers(spark, d):
    return silver.transform_sellers(t.raw_sellers(spark, d), BATCH, AS_OF, t.places(spark, d))


@query
def silver_products(spark, d):
    return silver.transform_products(t.raw_products(spark, d), BATCH, t.kinds(spark, d))


@query
def silver_orders(spark, d):
    return silver.transform_orders(t.raw_orders(spark, d))


@query
def silver_order_items(spark, d):
    return silver.transform_order_items(t.raw_order_items(spark, d), BATCH)


@query
def silver_payments(spark, d):
    return silver.transform_payments(t.raw_payments(spark, d), BATCH)


# History and upserts ----------------------------------------------------------------------------
# The batch lacks the HOUSEHOLD customers, the dimension lacks the MACHINERY ones, and the BUILDING
# ones have moved since.


def _known_customers(spark: SparkSession, d: str) -> DataFrame:
    segment = t.table(spark, d, "customer").select(
        F.col("c_custkey").cast("string").alias("customer_id"), "c_mktsegment", "c_acctbal"
    )
    moved = F.col("c_mktsegment") == "BUILDING"
    return (
        t.customers(spark, d)
        .join(segment, "customer_id")
        .where(F.col("c_mktsegment") != "MACHINERY")
        .select(
            (F.col("customer_id").cast("bigint") + 1).alias("customer_key"),
            "customer_id", "customer_unique_id", "zip_code_prefix", "city",
            F.when(moved, F.when(F.col("state") != "NATION_0", "NATION_0")).otherwise(F.col("state")).alias("state"),
            "state_name", "region",
            F.to_date(F.lit("2020-01-01")).alias("effective_start_date"),
            F.lit(None).cast("date").alias("effective_end_date"),
            F.lit(True).alias("is_current"),
            F.when(F.col("c_acctbal") < 0, 3).otherwise(1).alias("version_number"),
            F.to_timestamp_ntz(F.lit("2020-01-01 00:00:00")).alias("created_at"),
            F.to_timestamp_ntz(F.lit("2020-01-01 00:00:00")).alias("updated_at"),
        )
    )


def _batch_customers(spark: SparkSession, d: str) -> DataFrame:
    segment = t.table(spark, d, "customer").where(F.col("c_mktsegment") != "HOUSEHOLD")
    return t.customers(spark, d).join(
        segment.select(F.col("c_custkey").cast("string").alias("customer_id")), "customer_id", "left_semi"
    )


@query
def scd2_customers(spark, d):
    versions = history.version_dimension(
        _known_customers(spark, d).drop("customer_key"), _batch_customers(spark, d), "customer_id",
        dimensions.COMPARED, AS_OF, RUN_TS,
    )
    return versions.withColumnRenamed(history.CHANGE, "change")


@query
def scd2_counts(spark, d):
    versions = history.version_dimension(
        _known_customers(spark, d).drop("customer_key"), _batch_customers(spark, d), "customer_id",
        dimensions.COMPARED, AS_OF, RUN_TS,
    )
    return history.change_counts(versions)


@query
def scd2_history(spark, d):
    columns = ["customer_id", "city", "state", "effective_start_date", "effective_end_date", "is_current", "version_number"]
    return history.versions_of(scd2_customers(spark, d), "customer_id").select(*columns)


@query
def scd1_products(spark, d):
    """Each part takes the price of its last shipment; its name stays."""
    existing = t.table(spark, d, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_retailprice").cast("decimal(12,2)").alias("price"),
        F.lit(None).cast("timestamp_ntz").alias("sold_at"),
        F.lit(None).cast("timestamp_ntz").alias("updated_at"),
    ).where(F.col("product_name") != "small ring")
    sold = t.table(spark, d, "lineitem").select(
        F.col("l_partkey").alias("product_id"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("price"),
        F.col("l_shipdate").alias("sold_at"),
    )
    return history.overwrite_dimension(existing, sold, "product_id", RUN_TS, order_by=["sold_at"])


@query
def upsert_orders(spark, d):
    """Delivered and shipped orders are there as `created`; the batch brings shipped and processing ones."""
    every = t.orders(spark, d)
    existing = every.where("order_status <> 'processing'").select(
        "order_id", "customer_id", F.lit("created").alias("order_status"), "order_purchase_timestamp",
        "is_late_delivery",
        F.to_timestamp_ntz(F.lit("2020-01-01 00:00:00")).alias("created_at"),
        F.to_timestamp_ntz(F.lit("2020-01-01 00:00:00")).alias("updated_at"),
    )
    incoming = every.where("order_status <> 'delivered'").select(
        "order_id", "customer_id", "order_status", "order_purchase_timestamp", "is_late_delivery"
    )
    return history.upsert(existing, incoming, ["order_id"], run_ts=RUN_TS)


@query
def upsert_generic(spark, d):
    """Customer and priority as the key; `value` is replaced, `orders` and `first_seen` are kept."""
    orders = t.table(spark, d, "orders").withColumn("value", F.col("o_totalprice").cast("decimal(12,2)"))
    existing = orders.where("o_orderstatus = 'F'").groupBy("o_custkey", "o_orderpriority").agg(
        F.max("value").alias("value"), F.count(F.lit(1)).alias("orders"), F.min("o_orderdate").alias("first_seen")
    )
    incoming = orders.where("o_orderstatus <> 'F'").select(
        "o_custkey", "o_orderpriority", "value", F.col("o_orderdate").alias("first_seen")
    )
    return history.upsert(
        existing, incoming, ["o_custkey", "o_orderpriority"], update_cols=["value"], order_by=["first_seen"]
    )


@query
def upsert_buckets(spark, d):
    """The same upsert into a table in buckets, and then one order more, which rewrites one bucket."""
    warehouse = _scratch(spark)
    every = settled(
        t.orders(spark, d).select("order_id", "customer_id", "order_status", "order_purchase_timestamp", "is_late_delivery")
    )
    first = every.where("order_status <> 'processing'").withColumn("order_status", F.lit("created"))
    pipeline.merge_rows(warehouse, "silver.orders", first, datetime(2020, 1, 1))
    pipeline.merge_rows(warehouse, "silver.orders", every.where("order_status <> 'delivered'"), RUN_TS)
    dearest = t.table(spark, d, "orders").agg(F.max_by("o_orderkey", F.struct("o_totalprice", "o_orderkey")).cast("string").alias("order_id"))
    disputed = every.join(dearest, "order_id", "left_semi").withColumn("order_status", F.lit("disputed"))
    pipeline.merge_rows(warehouse, "silver.orders", disputed, RUN_TS)
    columns = [*every.columns, "created_at", "updated_at"]
    return warehouse.read("silver.orders").select(*columns)


# Gold -------------------------------------------------------------------------------------------


def _dim_date(spark: SparkSession, d: str) -> DataFrame:
    return dimensions.build_dim_date(t.day_bounds(spark, d))


@query
def dim_date(spark, d):
    return _dim_date(spark, d)


@query
def dim_customer(spark, d):
    built = dimensions.build_dim_customer(_batch_customers(spark, d), _known_customers(spark, d), AS_OF, RUN_TS)
    return built.withColumnRenamed(history.CHANGE, "change")


@query
def dim_seller(spark, d):
    """First load: every seller is new and numbered by id."""
    existing = audit.align_columns(t.sellers(spark, d).limit(0), schemas.schema_of("gold.dim_seller"))
    built = dimensions.build_dim_seller(t.sellers(spark, d), existing, AS_OF, RUN_TS)
    return built.withColumnRenamed(history.CHANGE, "change")


@query
def dim_product(spark, d):
    """Known small parts keep their keys and are replaced; the others are numbered after them."""
    known = t.products(spark, d).where("product_category_name = 'small'")
    existing = audit.align_columns(
        known.withColumns({"product_category_english": F.lit("Old"), "created_at": moment(datetime(2020, 1, 1))}),
        schemas.schema_of("gold.dim_product"),
    )
    return dimensions.build_dim_product(t.products(spark, d), existing, RUN_TS)


@query
def payments_per_order(spark, d):
    return fact.payments_per_order(t.instalments(spark, d))


@query
def fact_sales(spark, d):
    return fact.build_fact_sales(
        t.order_items(spark, d), t.orders(spark, d), t.payments(spark, d),
        t.customer_keys(spark, d), t.product_keys(spark, d), t.seller_keys(spark, d),
    )


def _months(spark: SparkSession, d: str) -> DataFrame:
    return mart.revenue_by_month(
        fact_sales(spark, d), _dim_date(spark, d), t.customers(spark, d), t.products(spark, d)
    )


@query
def revenue_mart(spark, d):
    return mart.build_revenue_mart(
        fact_sales(spark, d), _dim_date(spark, d), t.customers(spark, d), t.products(spark, d), RUN_TS
    )


@query
def mart_increment(spark, d):
    """The mart after orders that came late, of the last month and one of the first, and after a corrected order:
    brought up to date month by month, it must be the mart of a full build."""
    warehouse, early = _scratch(spark), datetime(2020, 1, 1)
    dims = {
        "gold.dim_date": _dim_date(spark, d), "gold.dim_customer": t.customers(spark, d),
        "gold.dim_product": t.products(spark, d), "gold.dim_seller": t.sellers(spark, d),
    }
    for name, dim in dims.items():
        warehouse.replace(dim, name, early)
    with shuffles_dropped(spark):
        every = settled(t.orders(spark, d))
    day = F.col("order_purchase_timestamp")
    ends = every.agg(F.max(F.date_trunc("month", day)).alias("last_month"), F.min_by("order_id", F.struct(day, "order_id")).alias("oldest"),
                     F.max_by("order_id", F.struct("order_id")).alias("corrected"))
    marked = every.join(F.broadcast(ends))  # one row
    late = (day >= F.col("last_month")) | (F.col("order_id") == F.col("oldest"))
    wrong = F.when(F.col("order_id") == F.col("corrected"), day - F.expr("INTERVAL 100 DAYS")).otherwise(day)
    known = marked.where(~late).withColumn("order_purchase_timestamp", wrong).select(*every.columns)
    pipeline.merge_rows(warehouse, "silver.orders", known, early)
    warehouse.write_batch(t.order_items(spark, d), "silver.order_items", "B1")
    warehouse.write_batch(t.payments(spark, d), "silver.payments", "B1")
    pipeline.load_fact(warehouse, early)
    pipeline.load_mart(warehouse, early)
    changed = marked.where(late | (F.col("order_id") == F.col("corrected"))).select(*every.columns)
    pipeline.merge_rows(warehouse, "silver.orders", changed, RUN_TS)
    pipeline.load_fact(warehouse, RUN_TS)
    pipeline.load_mart(warehouse, RUN_TS)
    return warehouse.read("gold.revenue_mart").drop("computed_at")


@query
def revenue_by_month(spark, d):
    return _months(spark, d)


_MONTH = ["year", "month", "state", "region", "product_category", "total_revenue"]


@query
def rank_in_month(spark, d):
    return mart.rank_in_month(_months(spark, d)).select(*_MONTH, "revenue_rank_in_month")


@query
def running_revenue(spark, d):
    return mart.running_revenue(_months(spark, d)).select(*_MONTH, "cumulative_revenue")


@query
def prev_month(spark, d):
    return mart.previous_month(_months(spark, d)).select(*_MONTH, "prev_month_revenue")


@query
def mom_growth(spark, d):
    return mart.month_growth(mart.previous_month(_months(spark, d))).select(*_MONTH, "mom_growth_pct")


def _figure(name: str) -> Query:
    def run(spark, d):
        return kpis.order_figures(fact_sales(spark, d)).select(F.col(name).cast("decimal(28,4)").alias(name))

    return run


for _name in ("total_revenue", "total_orders", "avg_order_value", "late_delivery_rate_pct"):
    QUERIES[f"kpi_{_name}"] = _figure(_name)


@query
def kpi_total_customers(spark, d):
    return kpis.current_customers(t.customers(spark, d))


@query
def kpi_revenue_by_state(spark, d):
    return kpis.revenue_by_state(fact_sales(spark, d), t.customers(spark, d)).withColumnRenamed("label", "state")


@query
def kpi_revenue_by_category(spark, d):
    top = kpis.revenue_by_category(fact_sales(spark, d), t.products(spark, d))
    return top.withColumnRenamed("label", "category")


@query
def kpi_latest_growth(spark, d):
    return kpis.latest_growth(revenue_mart(spark, d), GROWTH_STATE).withColumnRenamed("label", "state")


@query
def kpi_summary(spark, d):
    """The figures and the mart read the fact, so it is written once, as in a full run."""
    sales = settled(fact_sales(spark, d))
    customers, products = t.customers(spark, d), t.products(spark, d)
    monthly = mart.build_revenue_mart(sales, _dim_date(spark, d), customers, products, RUN_TS)
    return kpis.build_kpi_summary(sales, customers, products, monthly, AS_OF, RUN_TS, GROWTH_STATE)


# Reports ----------------------------------------------------------------------------------------


@query
def report_cards(spark, d):
    return reports.report_cards(fact_sales(spark, d))


@query
def daily_revenue(spark, d):
    return reports.daily_revenue(fact_sales(spark, d), _dim_date(spark, d))


@query
def top_categories(spark, d):
    return reports.top_categories(fact_sales(spark, d), t.products(spark, d))


@query
def orders_by_state(spark, d):
    return reports.orders_by_state(fact_sales(spark, d), t.customers(spark, d))


@query
def status_mix(spark, d):
    return reports.status_mix(fact_sales(spark, d))


@query
def revenue_by_region(spark, d):
    return reports.revenue_by_region(_months(spark, d))


@query
def state_growth(spark, d):
    return reports.state_growth(mart.month_growth(mart.previous_month(_months(spark, d))), GROWTH_STATE)


@query
def row_counts(spark, d):
    names = ["customer", "events", "lineitem", "nation", "orders", "part", "region", "supplier"]
    return reports.row_counts({name: t.table(spark, d, name) for name in names})


@query
def dq_report(spark, d):
    checks = [_all_rules(spark, d), _events(spark, d).check_numeric(["value", "user_id"]).check_min_rows(1)]
    return reports.dq_report(reduce(DataFrame.unionByName, [c.results(RUN_TS) for c in checks]))


@query
def dq_listing(spark, d):
    return reports.dq_listing(_events(spark, d).check_numeric(["value", "user_id"]).check_nulls(["props"]).results(RUN_TS))


def _runs(spark: SparkSession, d: str) -> DataFrame:
    """Line items as states of runs, one run per order."""
    return t.table(spark, d, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("batch_id"),
        F.concat(F.lit("silver_"), F.lower("l_returnflag")).alias("pipeline_name"),
        F.when(F.col("l_linestatus") == "O", "RUNNING").otherwise("SUCCESS").alias("status"),
        F.date_sub(F.col("l_shipdate").cast("date"), 1).cast("timestamp_ntz").alias("start_time"),
        F.when(F.col("l_linestatus") == "F", F.col("l_shipdate")).alias("end_time"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("duration_seconds"),
        F.col("l_partkey").alias("records_inserted"),
        F.col("l_suppkey").alias("records_updated"),
        F.col("l_linenumber").cast("bigint").alias("records_rejected"),
        F.col("l_shipdate").alias("recorded_at"),
    )


@query
def run_last_states(spark, d):
    return run_states(_runs(spark, d))


@query
def runs_recent(spark, d):
    return reports.recent_runs(run_states(_runs(spark, d)), 20)


@query
def watermark_latest(spark, d):
    marks = t.table(spark, d, "orders").select(
        F.col("o_orderpriority").alias("source_table"),
        F.col("o_orderkey").cast("string").alias("last_loaded_value"),
        F.col("o_orderdate").alias("last_updated"),
    )
    return last_watermarks(marks)
