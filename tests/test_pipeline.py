"""The whole run from raw files, twice, and what must hold after it."""

import json
import shutil
from dataclasses import replace
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import RUN_TS
from tidemark import pipeline, runs
from tidemark.__main__ import main
from tidemark.operators.quality import repeated_current_keys, repeated_keys
from tidemark.plans import reports
from tidemark.warehouse import EXPORTED, Warehouse

LATER = RUN_TS + timedelta(days=1)


def raw_files(folder, city="rio de janeiro", extra_customer=False, orders_after=None):
    folder.mkdir(parents=True, exist_ok=True)
    customers = ["c1,u1,1234,{city},rj", "c2,u2,22222,  são paulo ,SP", "c3,u3,33333,x,ZZ", ",u4,1,y,SP", "c1,u1,9,dup,SP"]
    if extra_customer:
        customers.append("c9,u9,99999,natal,rn")
    head = "customer_id,customer_unique_id,zip_code_prefix,city,state\n"
    (folder / "customers.csv").write_text(head + "\n".join(customers).format(city=city) + "\n", encoding="utf-8")
    (folder / "sellers.csv").write_text("seller_id,zip_code_prefix,city,state\ns1,1,belém,PA\ns2,2,natal,RN\n", encoding="utf-8")
    (folder / "products.xml").write_text(
        "<?xml version='1.0' encoding='utf-8'?>\n<products>\n"
        "<product><product_id>p1</product_id><product_category_name>brinquedos</product_category_name>"
        "<product_weight_g>10.5</product_weight_g><product_length_cm>10</product_length_cm>"
        "<product_height_cm>10</product_height_cm><product_width_cm>10</product_width_cm></product>\n"
        "<product><product_id>p2</product_id><product_category_name>unheard</product_category_name>"
        "<product_weight_g>heavy</product_weight_g></product>\n"
        "<product><product_category_name>bebes</product_category_name></product>\n</products>\n",
        encoding="utf-8",
    )
    orders = [
        dict(order_id="o1", customer_id="c1", order_status="delivered", order_purchase_timestamp="2024-01-05 10:00:00",
             order_approved_at="2024-01-05 11:00:00", order_delivered_at="2024-01-20 09:00:00", order_estimated_delivery="2024-01-19"),
        dict(order_id="o2", customer_id="c2", order_status="Shipped ", order_purchase_timestamp="2024-02-05 10:00:00",
             order_approved_at=None, order_delivered_at=None, order_estimated_delivery="2024-02-19"),
        dict(order_id="o2", customer_id="c2", order_status="created", order_purchase_timestamp="2024-02-06 10:00:00",
             order_approved_at=None, order_delivered_at=None, order_estimated_delivery="2024-02-19"),
        dict(order_id="o3", customer_id=None, order_status="odd", order_purchase_timestamp="2024-02-06 10:00:00",
             order_approved_at=None, order_delivered_at=None, order_estimated_delivery="2024-02-19"),
    ]
    orders += orders_after or []
    (folder / "orders.json").write_text(json.dumps(orders, indent=2), encoding="utf-8")
    (folder / "order_items.csv").write_text(
        "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\n"
        "o1,1,p1,s1,2024-01-10 00:00:00,100.00,10.00\no1,2,p2,s2,2024-01-10 00:00:00,50.005,5\n"
        "o2,1,p1,s1,2024-02-10 00:00:00,abc,1.00\no2,2,,s1,2024-02-10 00:00:00,1.00,1.00\n", encoding="utf-8")
    (folder / "payments.json").write_text(json.dumps([
        dict(order_id="o1", payment_sequential=2, payment_type="voucher", payment_installments=1, payment_value=15.01),
        dict(order_id="o1", payment_sequential=1, payment_type="Credit_Card", payment_installments=3, payment_value=150),
        dict(order_id="", payment_sequential=1, payment_type="boleto", payment_installments=1, payment_value=1),
    ], indent=2), encoding="utf-8")
    return str(folder)


@pytest.fixture(scope="module")
def first(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("run")
    outcome = pipeline.run(spark, raw_files(base / "raw"), str(base / "wh"), RUN_TS)
    return Warehouse(spark, str(base / "wh")), outcome, base


def counts(warehouse, *tables):
    return {t: warehouse.read(t).count() for t in tables}


def test_bronze_and_rejects(first):
    warehouse, outcome, base = first
    assert outcome.errors == {}
    assert counts(warehouse, *[f"bronze.{s.table}" for s in pipeline.SOURCES]) == {
        "bronze.customers": 3, "bronze.sellers": 2, "bronze.products": 2, "bronze.orders": 2, "bronze.order_items": 3,
        "bronze.payments": 2,
    }
    reasons = {(r.source_table, r.reject_reason) for r in warehouse.read("bronze.rejected_records").collect()}
    assert reasons == {
        ("customers", "NULL in customer_id; "), ("customers", "Duplicate on customer_id; "), ("products", "NULL in product_id; "),
        ("orders", "Duplicate on order_id; "), ("orders", "NULL in customer_id; "), ("order_items", "NULL in product_id; "),
        ("payments", "NULL in order_id; "),
    }
    row = warehouse.read("bronze.customers").where("customer_id = 'c1'").first()
    assert (row.city, row.source_file, row.source_system, row.is_rejected) == ("rio de janeiro", "customers.csv", "CSV", False)
    assert warehouse.read("bronze.orders").where("order_id = 'o2'").first().order_status == "Shipped "  # the first in the file
    assert len(list((base / "wh" / "rejected").iterdir())) == 5


def test_quality_results(first):
    warehouse, *_ = first
    got = {(r.table_name, r.check_name): r.failed_records for r in warehouse.read("metadata.dq_results").collect()}
    assert got["bronze.customers", "unique_check_customer_id"] == 1
    assert got["bronze.orders", "domain_check_order_status"] == 2
    assert got["bronze.products", "type_check_product_weight_g"] == 1
    assert got["bronze.order_items", "type_check_price"] == 1
    report = {r.table_name: (r.passed, r.failed) for r in reports.dq_report(warehouse.read("metadata.dq_results")).collect()}
    assert report["bronze.sellers"] == (6, 0)


def test_silver(first):
    warehouse, *_ = first
    c1, c2, c3 = warehouse.read("silver.customers").orderBy("customer_id").collect()
    assert (c1.city, c1.state, c1.region, c1.zip_code_prefix) == ("Rio De Janeiro", "RJ", "Southeast", "01234")
    assert (c2.city, c3.state) == ("São Paulo", None)
    o1, o2 = warehouse.read("silver.orders").orderBy("order_id").collect()
    assert (o1.delivery_days, o1.is_late_delivery, o1.order_status_category) == (14, True, "completed")
    assert (o2.order_status, o2.delivery_days, o2.is_late_delivery) == ("shipped", None, False)
    p1, p2 = warehouse.read("silver.products").orderBy("product_id").collect()
    assert (p1.product_category_english, p1.product_volume_cm3, p2.product_category_english) == ("Toys", Decimal("1000.00"), "Others")
    items = {(r.order_id, r.order_item_id): r.total_item_value for r in warehouse.read("silver.order_items").collect()}
    assert items == {("o1", 1): Decimal("110.00"), ("o1", 2): Decimal("55.01"), ("o2", 1): None}


def test_gold_and_sql(spark, first):
    warehouse, *_ = first
    fact = warehouse.read("gold.fact_sales")
    assert fact.count() == warehouse.read("silver.order_items").count() == 3
    o1 = fact.where("order_id = 'o1' AND order_item_id = 1").first()
    assert (o1.payment_value, o1.payment_type, o1.payment_installments) == (Decimal("165.01"), "credit_card", 3)
    sql = spark.sql("SELECT region, SUM(total_revenue) AS revenue FROM gold.revenue_mart GROUP BY region ORDER BY revenue DESC")
    assert [(r.region, r.revenue) for r in sql.collect()] == [("Southeast", Decimal("165.01"))]
    kpi = {(r.kpi_name, r.dimension_value): r.kpi_value for r in warehouse.read("gold.kpi_summary").collect()}
    assert kpi["total_customers", "all"] == 3 and kpi["latest_mom_revenue_growth_pct", "SP"] == 0
    assert spark.catalog.tableExists("gold.fact_sales")
    assert {t.name for t in spark.catalog.listTables("gold")} >= {"fact_sales", "dim_date", "revenue_mart"}
    assert spark.sql("SELECT count(*) FROM gold.dim_customer WHERE is_current").first()[0] == 3
    assert "silver.state_lookup" in warehouse.tables("silver")


def test_export_isolates_failures(first, tmp_path):
    warehouse, *_ = first
    outcome = warehouse.export_csv(str(tmp_path), [*EXPORTED, "gold.no_such_table"])
    assert [outcome[t] for t in EXPORTED] == ["exported"] * 5
    assert outcome["gold.no_such_table"].startswith("failed")
    assert warehouse.spark.read.option("header", True).csv(str(tmp_path / "dim_date")).count() == 3287


def test_run_records(first):
    warehouse, outcome, _ = first
    states = {r.pipeline_name: r for r in runs.run_states(warehouse.read("metadata.pipeline_runs")).collect()}
    assert len(states) == 18
    assert states["bronze.customers"].status == "PARTIAL" and states["bronze.customers"].records_rejected == 2
    assert states["bronze.sellers"].status == "SUCCESS" and states["bronze.sellers"].duration_seconds > 0
    assert reports.recent_runs(runs.run_states(warehouse.read("metadata.pipeline_runs"))).count() == 12
    assert runs.get_watermark(warehouse, "orders") == "2024-02-05 10:00:00"
    assert runs.get_watermark(warehouse, "nowhere") == runs.FIRST_WATERMARK


def test_summary_and_command_line(first, tmp_path, capsys):
    warehouse, *_ = first
    parts = pipeline.summary(warehouse)
    counted = {r.table_name: r.rows for r in parts["tables"].collect()}
    assert len(counted) == 16 and counted["gold.fact_sales"] == 3 and counted["silver.customers"] == 3
    assert parts["runs"].count() == 12 and parts["checks"].count() == 6
    assert main(["export", warehouse.root, "--target", str(tmp_path)]) == 0
    assert "gold.fact_sales exported" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        main(["run", warehouse.root])


def copied(first, tmp_path):
    """A warehouse of one's own after the first run."""
    return shutil.copytree(first[2] / "wh", tmp_path / "wh")


def test_second_run_history_and_idempotence(spark, first, tmp_path):
    raw = raw_files(tmp_path / "raw", city="niterói", extra_customer=True)
    root = str(copied(first, tmp_path))
    warehouse = Warehouse(spark, root)
    outcome = pipeline.run(spark, raw, root, LATER, batch_id="DAY2")
    assert outcome.errors == {}
    for name, surrogate in [("silver.customers", None), ("gold.dim_customer", "customer_key")]:
        dim = warehouse.read(name)
        got = sorted((r.customer_id, r.version_number, r.is_current, r.city) for r in dim.collect())
        assert got == [
            ("c1", 1, False, "Rio De Janeiro"), ("c1", 2, True, "Niterói"), ("c2", 1, True, "São Paulo"), ("c3", 1, True, "X"),
            ("c9", 1, True, "Natal"),
        ]
        assert repeated_current_keys(dim, "customer_id").count() == 0
        if surrogate:
            assert repeated_keys(dim, [surrogate]).count() == 0
            assert dim.agg(F.max(surrogate)).first()[0] == 5
    closed = warehouse.read("gold.dim_customer").where("not is_current").first()
    assert closed.effective_end_date == LATER.date() and closed.updated_at == LATER
    # Silver and gold again, now from the batch loaded last, which is the same one.
    before = {t: warehouse.read(t).count() for t in warehouse.tables("gold")}
    items = warehouse.read("silver.order_items").count()
    silver = pipeline.run_silver(spark, root, LATER)
    assert silver.errors == {}
    assert pipeline.load_dim(warehouse, "dim_customer", LATER) == {"inserted": 0, "updated": 0}
    assert pipeline.load_fact(warehouse, LATER) == {"inserted": 0}  # nothing has changed since
    # The later full load takes the earlier one's place.
    assert pipeline.load_fact(warehouse, LATER, rebuild=True) == {"inserted": 3}
    assert {t: warehouse.read(t).count() for t in warehouse.tables("gold")} == before
    assert warehouse.read("silver.order_items").count() == items == 6
    assert silver.rows["silver.customers"] == 0


def test_incremental_run_reads_after_the_watermark(spark, first, tmp_path):
    new = dict(order_id="o7", customer_id="c2", order_status="created", order_purchase_timestamp="2024-03-01 00:00:00",
               order_approved_at=None, order_delivered_at=None, order_estimated_delivery=None)
    raw = raw_files(tmp_path / "b", orders_after=[new])
    root = str(copied(first, tmp_path))
    outcome = pipeline.run_bronze(spark, raw, root, LATER, incremental=True, batch_id="DAY2",
                                  sources=[s for s in pipeline.SOURCES if s.table == "orders"])
    assert outcome.errors == {}
    warehouse = Warehouse(spark, root)
    loaded = warehouse.read("bronze.orders").where("batch_id = 'DAY2'")
    assert {r.order_id for r in loaded.collect()} == {"o2", "o7"}  # the later copy of o2 was never loaded
    assert runs.get_watermark(warehouse, "orders") == "2024-03-01 00:00:00"


def test_failures_are_isolated_and_logged(spark, tmp_path):
    raw = tmp_path / "raw"
    raw_files(raw)
    (raw / "payments.json").write_text("{not json", encoding="utf-8")
    (raw / "sellers.csv").unlink()
    root = str(tmp_path / "wh")
    sources = [replace(s, limits=True) for s in pipeline.SOURCES if s.table in ("sellers", "payments", "order_items")]
    outcome = pipeline.run_bronze(spark, str(raw), root, RUN_TS, sources)
    assert set(outcome.errors) == {"bronze.sellers", "bronze.payments"}
    assert outcome.errors["bronze.sellers"].startswith("FileNotFoundError")
    warehouse = Warehouse(spark, root)
    assert warehouse.read("metadata.error_log").count() == 2
    states = {r.pipeline_name: r.status for r in runs.run_states(warehouse.read("metadata.pipeline_runs")).collect()}
    assert states["bronze.sellers"] == "FAILED"
    assert outcome.rows == {"bronze.order_items": 3}
    checks = {r.check_name: r.passed for r in warehouse.read("metadata.dq_results").collect()}
    assert checks["length_check_price"] and len(checks) == 5 + 7 + 3 + 1
    warehouse.publish()
    assert [spark.sql(f"SELECT count(*) FROM bronze.{t}").first()[0] for t in ("sellers", "order_items")] == [0, 3]


def test_manual_rules_keep_one_row_per_order(spark, tmp_path):
    raw, root = raw_files(tmp_path / "raw"), str(tmp_path / "wh")
    outcome = pipeline.run_bronze(spark, raw, root, RUN_TS, sources=pipeline.MANUAL_SOURCES)
    assert (outcome.rows["bronze.order_items"], outcome.rows["bronze.payments"], outcome.rows["bronze.orders"]) == (2, 1, 3)


def test_uncommitted_version_is_invisible(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    warehouse.replace(spark.sql("SELECT 'a' AS state_code"), "silver.state_lookup", RUN_TS)
    spark.sql("SELECT 'b' AS state_code").write.parquet(f"{warehouse.path('silver.state_lookup')}/data/version=2")
    assert [r.state_code for r in warehouse.read("silver.state_lookup").collect()] == ["a"]
    warehouse.replace(spark.sql("SELECT 'c' AS state_code"), "silver.state_lookup", RUN_TS)
    assert [r.state_code for r in warehouse.read("silver.state_lookup").collect()] == ["c"]
    assert warehouse.version("silver.state_lookup") == 2


def test_schema_changes(spark, tmp_path):
    old = spark.createDataFrame([], "a string, b int").schema
    new = spark.createDataFrame([], "b bigint, c string").schema
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    assert runs.log_schema_changes(warehouse, "bronze.x", old, new, "B", RUN_TS) == 3
    got = sorted((r.column_name, r.change_type) for r in warehouse.read("metadata.schema_changes").collect())
    assert got == [("a", "DROP_COLUMN"), ("b", "TYPE_CHANGE"), ("c", "ADD_COLUMN")]


def test_batch_id():
    import re

    assert re.fullmatch(r"FULL_RUN_20240601_120000_[0-9A-F]{8}", runs.new_batch_id("full_run", datetime(2024, 6, 1, 12)))


def test_arrivals_load_each_file_once(spark, tmp_path):
    from tidemark.streaming.arrivals import ingest_arrivals

    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    source = next(s for s in pipeline.SOURCES if s.table == "customers")
    folder = tmp_path / "in"
    folder.mkdir()
    head = "customer_id,customer_unique_id,zip_code_prefix,city,state\n"

    def arrive():
        ingest_arrivals(warehouse, source, str(folder), str(tmp_path / "cp"), RUN_TS, "ARRIVALS").awaitTermination()
        return sorted((r.customer_id, r.source_file) for r in warehouse.read("bronze.customers").collect())

    (folder / "a.csv").write_text(head + "c1,u,1,x,SP\nc1,u,1,x,SP\n,u,1,x,SP\n")
    assert arrive() == [("c1", "a.csv")]
    assert arrive() == [("c1", "a.csv")]
    (folder / "b.csv").write_text(head + "c2,u,1,x,SP\n")
    assert arrive() == [("c1", "a.csv"), ("c2", "b.csv")]
    assert warehouse.read("bronze.rejected_records").count() == 2


def test_empty_rewrites_and_ids_as_text(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    items = spark.sql("SELECT 'o1' AS order_id, '0042' AS batch_id")
    warehouse.write_batch(items, "silver.order_items", "0042")
    warehouse.publish()
    assert [r.batch_id for r in spark.sql("SELECT batch_id FROM silver.order_items").collect()] == ["0042"]
    warehouse.write_batch(items.limit(0), "silver.order_items", "0042")
    assert warehouse.read("silver.order_items").count() == 0


def test_overflow_and_new_columns_leave_a_trace(spark, tmp_path):
    raw = tmp_path / "raw"
    raw_files(raw)
    (raw / "order_items.csv").write_text(
        "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value,colour\n"
        "o1,1,p1,s1,2024-01-10 00:00:00,12345678901.50,10.00,red\no1,2,p2,s2,2024-01-10 00:00:00,9999999999.00,5,red\n"
        "o2,1,p1,s1,2024-02-10 00:00:00,abc,1.00,red\no2,2,p1,s1,2024-02-10 00:00:00,1e999,1.00,red\n", encoding="utf-8")
    sources = [s for s in pipeline.SOURCES if s.table == "order_items"]
    outcome = pipeline.run_bronze(spark, str(raw), str(tmp_path / "wh"), RUN_TS, sources)
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    assert (outcome.errors, outcome.rows) == ({}, {"bronze.order_items": 1})
    reasons = sorted(r.reject_reason for r in warehouse.read("bronze.rejected_records").collect())
    assert reasons == ["Out of range: price; ", "Out of range: price; ", "Out of range: total_item_value; "]
    assert pipeline.latest_load(warehouse, "order_items") == outcome.batch_id
    # The same columns again are no change.
    assert pipeline.run_bronze(spark, str(raw), str(tmp_path / "wh"), LATER, sources).errors == {}
    (change,) = warehouse.read("metadata.schema_changes").collect()
    assert (change.table_name, change.column_name, change.change_type) == ("bronze.order_items", "colour", "ADD_COLUMN")


def test_new_fields_of_json_are_noticed_once(spark, tmp_path):
    raw = tmp_path / "raw"
    raw_files(raw, orders_after=[dict(order_id="o9", customer_id="c1", address=dict(zip="1", floor=None))])
    sources = [s for s in pipeline.SOURCES if s.table == "orders"]
    for day in (RUN_TS, LATER):
        assert pipeline.run_bronze(spark, str(raw), str(tmp_path / "wh"), day, sources).errors == {}
    got = Warehouse(spark, str(tmp_path / "wh")).read("metadata.schema_changes").collect()
    assert sorted((r.column_name, r.change_type) for r in got) == [("address.floor", "ADD_COLUMN"), ("address.zip", "ADD_COLUMN")]


def test_last_row_of_a_file_wins_under_manual_rules(spark, tmp_path):
    raw, root = raw_files(tmp_path / "raw"), str(tmp_path / "wh")
    sources = [s for s in pipeline.MANUAL_SOURCES if s.table == "orders"]
    assert pipeline.run_bronze(spark, raw, root, RUN_TS, sources, batch_id="B").errors == {}
    warehouse = Warehouse(spark, root)
    pipeline.load_silver(warehouse, "orders", "B", RUN_TS)
    assert warehouse.read("silver.orders").where("order_id = 'o2'").first().order_status == "created"
