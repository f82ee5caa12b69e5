"""Tables in parts, and the fact and the mart brought up to date, against full rebuilds."""

import os
import random
from datetime import datetime, timedelta
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from tests.conftest import RUN_TS
from tidemark import pipeline
from tidemark.operators.audit import align_columns
from tidemark.plans import increment
from tidemark.schemas import schema_of
from tidemark.session import CLEANUP
from tidemark.warehouse import Warehouse

DAY = timedelta(days=1)


def files(warehouse, table):
    """Every data file of a table with its part and time."""
    found = {}
    for path in Path(warehouse.path(table)).rglob("*.parquet"):
        part = next((p[len("part=") :] for p in path.parts if p.startswith("part=")), None)
        if part is not None:
            found[str(path)] = (int(part), os.stat(path).st_mtime_ns)
    return found


def orders_frame(spark, rows, run_ts):
    df = spark.createDataFrame(rows, "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz")
    return df.withColumns({"delivery_days": F.lit(1), "is_late_delivery": F.col("order_status") == "late"})


def test_upsert_writes_touched_buckets_only(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    rows = [(f"o{i}", "c1", "created", datetime(2024, 1, 1)) for i in range(60)]
    pipeline.merge_rows(warehouse, "silver.orders", orders_frame(spark, rows, RUN_TS), RUN_TS)
    before, first = files(warehouse, "silver.orders"), warehouse.commit("silver.orders")
    assert len(first.parts) == 8

    change = [("o7", "c2", "shipped", datetime(2024, 1, 2))]
    assert pipeline.merge_rows(warehouse, "silver.orders", orders_frame(spark, change, RUN_TS), RUN_TS + DAY) == {"inserted": 1, "updated": 0}
    after, second = files(warehouse, "silver.orders"), warehouse.commit("silver.orders")
    touched = second.since(first)
    assert len(touched) == 1
    assert {f: t for f, t in after.items() if f in before} == before  # nothing was rewritten in place
    assert {p for f, (p, _) in after.items() if f not in before} == set(touched)
    assert warehouse.read("silver.orders").count() == 60
    assert warehouse.read("silver.orders").where("order_id = 'o7'").first().order_status == "shipped"
    # The earlier version is still there, and the two can be compared in the part that differs.
    old = warehouse.read("silver.orders", touched, first.version)
    moved = increment.differing(old, warehouse.read("silver.orders", touched), ["order_id"], ["order_status"])
    assert [r.order_id for r in moved.collect()] == ["o7"]


def test_versions_write_buckets_with_a_change_only(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))

    def customers(city):
        rows = [(f"c{i}", city if i == 3 else "x", "SP", "1", True, 1) for i in range(50)]
        return spark.createDataFrame(rows, "customer_id string, city string, state string, zip_code_prefix string, is_current boolean, version_number int")

    assert pipeline.merge_versions(warehouse, "silver.customers", customers("x"), "customer_id", RUN_TS) == {"inserted": 50, "updated": 0}
    first = warehouse.commit("silver.customers")
    assert pipeline.merge_versions(warehouse, "silver.customers", customers("x"), "customer_id", RUN_TS + DAY) == {"inserted": 0, "updated": 0}
    assert warehouse.commit("silver.customers") == first  # the same again writes nothing
    for day, city in enumerate(["y", "z"], 1):
        assert pipeline.merge_versions(warehouse, "silver.customers", customers(city), "customer_id", RUN_TS + day * DAY) == {"inserted": 0, "updated": 1}
    assert len(warehouse.commit("silver.customers").since(first)) == 1
    got = sorted((r.version_number, r.is_current, r.city) for r in warehouse.read("silver.customers").where("customer_id = 'c3'").collect())
    assert got == [(1, False, "x"), (2, False, "y"), (3, True, "z")]
    warehouse.publish()
    assert spark.sql("SELECT count(*), count_if(is_current) FROM silver.customers").first()[:] == (52, 50)


def test_a_lost_write_leaves_the_table(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    rows = [(f"o{i}", "c1", "created", datetime(2024, 1, 1)) for i in range(20)]
    frame = orders_frame(spark, rows, RUN_TS)
    pipeline.merge_rows(warehouse, "silver.orders", frame, RUN_TS)
    broken = align_columns(frame, schema_of("silver.orders")).withColumn("order_status", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        warehouse.write_parts(broken, "silver.orders", list(range(8)), RUN_TS)
    assert warehouse.version("silver.orders") == 1 and warehouse.read("silver.orders").count() == 20
    assert pipeline.merge_rows(warehouse, "silver.orders", frame.limit(1), RUN_TS + DAY)["inserted"] == 1
    assert warehouse.read("silver.orders").count() == 20


def test_buckets_can_be_dealt_anew(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    rows = [(f"o{i}", "c1", "created", datetime(2024, 1, 1)) for i in range(40)]
    pipeline.merge_rows(warehouse, "silver.orders", orders_frame(spark, rows, RUN_TS), RUN_TS)
    first = warehouse.commit("silver.orders")
    spark.conf.set("spark.tidemark.buckets", "3")
    try:
        warehouse.replace(warehouse.read("silver.orders"), "silver.orders", RUN_TS)
    finally:
        spark.conf.unset("spark.tidemark.buckets")
    now = warehouse.commit("silver.orders")
    assert (now.buckets, set(now.parts), now.since(first)) == (3, {0, 1, 2}, [0, 1, 2])
    pipeline.merge_rows(warehouse, "silver.orders", orders_frame(spark, rows[:5], RUN_TS), RUN_TS + DAY)
    assert warehouse.commit("silver.orders").buckets == 3 and warehouse.read("silver.orders").count() == 40


class Shop:
    """Silver tables that change from day to day."""

    def __init__(self, spark, root, seed):
        self.spark, self.warehouse, self.draw = spark, Warehouse(spark, root), random.Random(seed)
        self.orders, self.cities, self.kinds, self.day = {}, {f"c{i}": "SP" for i in range(6)}, {f"p{i}": "Toys" for i in range(4)}, 0

    def now(self):
        return RUN_TS + self.day * DAY

    def settle(self, orders, items, payments):
        draw, w, now, spark = self.draw, self.warehouse, self.now(), self.spark
        self.orders |= orders
        frame = orders_frame(spark, [(o, *v) for o, v in orders.items()], now) if orders else None
        if frame is not None:
            pipeline.merge_rows(w, "silver.orders", frame, now)
        people = spark.createDataFrame([(c, s, s, s + " region", "1") for c, s in self.cities.items()], "customer_id string, city string, state string, region string, zip_code_prefix string")
        pipeline.merge_versions(w, "silver.customers", people.withColumn("is_current", F.lit(True)), "customer_id", now)
        shops = spark.createDataFrame([(f"s{i}", "moved" if i == 1 and self.day else "town", "RJ", "1") for i in range(3)], "seller_id string, city string, state string, zip_code_prefix string")
        pipeline.merge_versions(w, "silver.sellers", shops.withColumn("is_current", F.lit(True)), "seller_id", now)
        goods = spark.createDataFrame(list(self.kinds.items()), "product_id string, product_category_english string")
        pipeline.merge_rows(w, "silver.products", goods, now)
        batch = f"B{self.day:03d}"
        money = [(o, i, draw.choice([*self.kinds, "p9"]), f"s{draw.randrange(4)}", *[Decimal(draw.randrange(1000)) / 100 if draw.random() < 0.95 else None] * 2) for o, n in items for i in range(n)]
        rows = spark.createDataFrame(money, "order_id string, order_item_id int, product_id string, seller_id string, price decimal(12,2), total_item_value decimal(12,2)")
        w.write_batch(rows.withColumn("freight_value", F.lit(1).cast("decimal(12,2)")), "silver.order_items", batch)
        paid = spark.createDataFrame([(o, 1, "card", Decimal(v)) for o, v in payments], "order_id string, payment_sequential int, payment_type string, payment_value decimal(12,2)")
        w.write_batch(paid, "silver.payments", batch)
        self.day += 1
        return now

    def load(self, now, **how):
        for name in ("dim_customer", "dim_product", "dim_seller"):
            if not how:
                pipeline.load_dim(self.warehouse, name, now)
        return pipeline.load_fact(self.warehouse, now, **how), pipeline.load_mart(self.warehouse, now, **how)

    def result(self):
        fact = self.warehouse.read("gold.fact_sales").drop("sales_key", "created_at")
        mart = self.warehouse.read("gold.revenue_mart").drop("computed_at")
        state = self.warehouse.read("gold.mart_state")
        return [sorted((tuple(r) for r in df.collect()), key=repr) for df in (fact, mart, state)]


def test_increments_equal_a_rebuild(spark, tmp_path):
    shop = Shop(spark, str(tmp_path / "wh"), 1)
    w, draw = shop.warehouse, shop.draw
    pipeline.load_dim(w, "dim_date", RUN_TS)

    def order(month):
        return (draw.choice([*shop.cities, "c7"]), draw.choice(["late", "shipped"]), datetime(2024, month, draw.randrange(1, 28)) if month else None)

    first = {f"o{i}": order(draw.choice([1, 2, 3, 5, 6, 0])) for i in range(40)}
    shop.load(shop.settle(first, [(o, draw.randrange(4)) for o in first], [(o, draw.randrange(99)) for o in first]))
    days = [
        # One order comes late, others are corrected into other months; one customer moves, another is found.
        ({"late1": order(2), "o3": order(6), "o4": order(0)}, [("late1", 2)], [("late1", 5)]),
        # Items and payments of known orders, and of an unknown one; a category is renamed, a product is found.
        ({}, [("o5", 1), ("unknown", 1)], [("o6", 77)]),
        ({"n1": order(7)}, [("n1", 3)], []),  # only a new month
    ]
    for number, (orders, items, payments) in enumerate(days):
        if number == 0:
            shop.cities["c2"], shop.cities["c7"] = "RJ", "MG"  # one moves, one that orders had already is new
        if number == 1:
            shop.kinds["p1"] = "Books"
            shop.kinds["p9"] = "Music"
        old = files(w, "gold.fact_sales"), w.commit("gold.fact_sales"), w.commit("gold.revenue_mart")
        now = shop.settle(orders, items, payments)
        shop.load(now)
        got, new = shop.result(), (w.commit("gold.fact_sales"), w.commit("gold.revenue_mart"))
        assert {f: t for f, t in files(w, "gold.fact_sales").items() if f in old[0]} == old[0]
        if number == 2:
            assert new[0].since(old[1]) == [202407] == new[1].since(old[2])
        shop.load(now, rebuild=True)
        for mine, whole in zip(got, shop.result(), strict=True):
            assert set(mine) ^ set(whole) == set() and mine == whole, number
        keys = w.read("gold.fact_sales").select("sales_key")
        assert keys.distinct().count() == keys.count()


def test_a_full_load_takes_the_place_of_earlier_ones(spark, tmp_path):
    """Then what the fact was built from is no longer in force, and it is built anew."""
    shop = Shop(spark, str(tmp_path / "wh"), 3)
    w = shop.warehouse
    pipeline.load_dim(w, "dim_date", RUN_TS)
    orders = {f"o{i}": ("c1", "shipped", datetime(2024, 1 + i % 3, 1)) for i in range(6)}
    shop.load(shop.settle(orders, [(o, 2) for o in orders], []))
    now = shop.settle({}, [("o1", 1)], [])
    from tidemark.runs import PipelineRun

    with PipelineRun(w, "bronze.order_items", batch_id="B000.bronze.order_items", run_mode="FULL", clock=lambda: RUN_TS):
        pass
    with PipelineRun(w, "bronze.order_items", batch_id="B001.bronze.order_items", run_mode="FULL", clock=lambda: RUN_TS + DAY):
        pass
    shop.load(now)
    assert [r.order_id for r in w.read("gold.fact_sales").collect()] == ["o1"]
    assert list(w.commit("gold.fact_sales").parts) == [202402]
    assert w.read("gold.revenue_mart").count() == 1


def test_orders_are_not_looked_through_for_dimensions_without_a_new_key(spark, tmp_path, monkeypatch):
    """Only a dimension that has new keys makes a load of the fact read the keys of all orders or items."""
    warehouse, asked = Warehouse(spark, str(tmp_path / "wh")), []
    affected = increment.affected_orders
    monkeypatch.setattr(increment, "affected_orders", lambda *a: asked.append([f is not None for f in a[5:]]) or affected(*a))

    def dim(name, rows, ddl):
        warehouse.replace(spark.createDataFrame(rows, ddl), name, RUN_TS)

    dim("gold.dim_customer", [("c1", 1, True)], "customer_id string, customer_key long, is_current boolean")
    dim("gold.dim_seller", [("s1", 1, True)], "seller_id string, seller_key long, is_current boolean")
    dim("gold.dim_product", [("p1", 1)], "product_id string, product_key long")
    items = spark.createDataFrame([("o1", 1, "p1", "s1"), ("o2", 1, "p2", "s1")], "order_id string, order_item_id int, product_id string, seller_id string")
    warehouse.write_batch(items, "silver.order_items", "B1")
    for day, product in enumerate([[], [], [("p2", 2)]]):
        if product:
            dim("gold.dim_product", [("p1", 1), *product], "product_id string, product_key long")
        rows = [(f"o{n}", "c1", f"s{day}", datetime(2024, 1, n)) for n in (1, 2) if n == 1 or not day]
        pipeline.merge_rows(warehouse, "silver.orders", orders_frame(spark, rows, RUN_TS + day * DAY), RUN_TS + day * DAY)
        pipeline.load_fact(warehouse, RUN_TS + day * DAY)
    assert asked == [[False, False, False], [False, True, False]]  # the first load built everything
    got = sorted((r.order_id, r.order_status, r.product_key) for r in warehouse.read("gold.fact_sales").collect())
    assert got == [("o1", "s2", 1), ("o2", "s0", 2)]


def test_full_builds_join_a_slice_at_a_time(spark, tmp_path, monkeypatch):
    """Fact and mart are the same built in slices, and no build gets more than its slice."""
    shop = Shop(spark, str(tmp_path / "wh"), 4)
    w, draw, joined, summed = shop.warehouse, shop.draw, [], []
    pipeline.load_dim(w, "dim_date", RUN_TS)
    build, sums = pipeline.build_fact_sales, pipeline.revenue_by_month
    monkeypatch.setattr(pipeline, "build_fact_sales", lambda items, *a: joined.append(items.count()) or build(items, *a))
    monkeypatch.setattr(pipeline, "revenue_by_month", lambda sales, *a: summed.append(sales.count()) or sums(sales, *a))
    orders = {f"o{i}": ("c1", "shipped", datetime(2024, draw.randrange(1, 7), 1) if i % 9 else None) for i in range(8)}
    now = shop.settle(orders, [(o, 3) for o in [*orders, "unknown"]], [(o, draw.randrange(99)) for o in orders])
    shop.load(now)
    whole, dated = shop.result(), sum(summed)
    assert (joined, dated) == ([27], 24 - 3)
    spark.conf.set("spark.tidemark.slice", "6")
    try:
        shop.load(now, rebuild=True)
    finally:
        spark.conf.unset("spark.tidemark.slice")
    assert shop.result() == whole
    parts = [
        [r[1] for r in w.read(t).groupBy(part).count().collect()]
        for t, part in (("silver.order_items", w.part_of("silver.orders")), ("gold.fact_sales", F.expr("order_date_key div 100")))
    ]
    for n, whole_table, sizes in ((joined[1:], 27, parts[0]), (summed[1:], dated, parts[1])):
        assert len(n) > 2 and sum(n) == whole_table and all(x <= 6 or x in sizes for x in n)
    keys = w.read("gold.fact_sales").select("sales_key")
    assert keys.distinct().count() == keys.count() == 27


def test_writes_drop_their_shuffle_files(spark, tmp_path, monkeypatch):
    """Steps that follow each other do not pile up what they shuffled: it goes with the write, and the session is as before."""
    shop, seen, before = Shop(spark, str(tmp_path / "wh"), 5), {}, spark.conf.get(CLEANUP)
    pipeline.load_dim(shop.warehouse, "dim_date", RUN_TS)
    now = shop.settle({"o1": ("c1", "shipped", datetime(2024, 1, 1))}, [("o1", 2)], [])
    write = DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path, *a, **b: seen.update({path: spark.conf.get(CLEANUP)}) or write(self, path, *a, **b))
    shop.load(now, rebuild=True)
    assert {path.split("/wh/")[1].split("/data")[0] for path, on in seen.items() if on == "true"} >= {"gold/fact_sales", "gold/revenue_mart", "gold/mart_state"}
    assert all(path.endswith("/commits") for path, on in seen.items() if on != "true")
    assert spark.conf.get(CLEANUP) == before == "false"
