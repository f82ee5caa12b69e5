from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from tests.conftest import AS_OF, RUN_TS
from tidemark.plans import dimensions, fact, kpis, mart, reports

D = Decimal


def test_first_payment_skips_nulls(spark):
    df = spark.createDataFrame(
        [("a", 2, "boleto", 3, D("5.00")), ("a", 1, None, 2, D("1.50")), ("b", None, "voucher", 1, None), ("c", 1, None, None, None),
         (None, 1, "x", 1, D("9.00"))],
        "order_id string, payment_sequential int, payment_type string, payment_installments int, payment_value decimal(12,2)",
    )
    got = sorted(tuple(r) for r in fact.payments_per_order(df).collect())
    assert got == [("a", D("6.50"), "boleto", 2), ("b", D("0.00"), "voucher", 1), ("c", D("0.00"), None, None)]


def star(spark, items, orders, payments):
    items = spark.createDataFrame(
        items, "order_id string, order_item_id int, product_id string, seller_id string, price decimal(12,2), "
        "freight_value decimal(12,2), total_item_value decimal(12,2)")
    orders = spark.createDataFrame(
        orders, "order_id string, customer_id string, order_status string, delivery_days int, is_late_delivery boolean, "
        "order_purchase_timestamp string, order_delivered_at string"
    ).withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("order_purchase_timestamp", "order_delivered_at")})
    payments = spark.createDataFrame(
        payments, "order_id string, payment_sequential int, payment_type string, payment_installments int, payment_value decimal(12,2)")
    customers = spark.createDataFrame(
        [(1, "c1", False, "AA", "R"), (2, "c1", True, "SP", "R"), (3, "c2", True, None, None)],
        "customer_key bigint, customer_id string, is_current boolean, state string, region string")
    products = spark.createDataFrame(
        [(1, "p1", "brinquedos", "Toys"), (2, "p2", None, None)],
        "product_key bigint, product_id string, product_category_name string, product_category_english string")
    sellers = spark.createDataFrame([(1, "s1", True)], "seller_key bigint, seller_id string, is_current boolean")
    return fact.build_fact_sales(items, orders, payments, customers, products, sellers), customers, products


ITEMS = [
    ("o1", 1, "p1", "s1", D("10.00"), D("1.00"), D("11.00")),
    ("o1", 2, "p2", "s1", D("20.00"), D("2.00"), D("22.00")),
    ("o2", 1, "p1", "none", D("5.00"), D("0.50"), D("5.50")),
    ("o3", 1, "p1", "s1", D("1.00"), D("0.10"), D("1.10")),
    ("lost", 1, "p9", "s1", D("7.00"), D("0.00"), D("7.00")),
    ("o4", 1, "p1", "s1", D("2.00"), D("0.00"), D("2.00")),
]
ORDERS = [
    ("o1", "c1", "delivered", 2, True, "2024-01-05 10:00:00", "2024-01-07 11:00:00"),
    ("o2", "c1", "shipped", None, False, "2024-03-05 10:00:00", None),
    ("o3", "c2", "shipped", None, False, "2024-03-06 10:00:00", None),
    ("o4", "c1", "shipped", None, False, "1990-03-06 10:00:00", None),
]
PAYMENTS = [("o1", 1, "boleto", 1, D("33.00")), ("lost", 1, "voucher", 1, D("7.00"))]


def test_fact_keeps_every_item(spark):
    sales, *_ = star(spark, ITEMS, ORDERS, PAYMENTS)
    got = {(r.order_id, r.order_item_id): r for r in sales.collect()}
    assert len(got) == len(ITEMS)
    assert (got["o1", 1].customer_key, got["o1", 1].order_date_key, got["o1", 1].delivery_date_key) == (2, 20240105, 20240107)
    assert got["o1", 1].payment_value == got["o1", 2].payment_value == D("33.00")
    lost = got["lost", 1]
    assert (lost.customer_key, lost.product_key, lost.order_date_key, lost.payment_type) == (None, None, None, "voucher")
    assert got["o2", 1].seller_key is None and got["o2", 1].payment_value is None


def the_mart(spark, items=ITEMS):
    sales, customers, products = star(spark, items, ORDERS, PAYMENTS)
    days = dimensions.build_dim_date(dimensions.date_bounds(spark))
    return mart.build_revenue_mart(sales, days, customers, products, RUN_TS), sales, customers, products


def test_mart_windows(spark):
    items = ITEMS + [("o5", 1, "p1", "s1", D("0.00"), D("0.00"), D("0.00")), ("o6", 1, "p1", "s1", D("4.00"), D("0.00"), D("4.00"))]
    orders = ORDERS + [
        ("o5", "c1", "shipped", None, False, "2024-05-01 00:00:00", None),
        ("o6", "c1", "shipped", None, False, "2024-06-01 00:00:00", None),
    ]
    sales, customers, products = star(spark, items, orders, PAYMENTS)
    days = dimensions.build_dim_date(dimensions.date_bounds(spark))
    m = mart.build_revenue_mart(sales, days, customers, products, RUN_TS)
    got = {(r.year, r.month, r.state, r.product_category): r for r in m.collect()}
    assert set(got) == {
        (2024, 1, "SP", "Toys"), (2024, 1, "SP", "Unknown"), (2024, 3, "SP", "Toys"), (2024, 3, "Unknown", "Toys"),
        (2024, 5, "SP", "Toys"), (2024, 6, "SP", "Toys"),
    }  # 1990 is outside the date dimension
    assert got[2024, 1, "SP", "Unknown"].revenue_rank_in_month == 1
    assert got[2024, 1, "SP", "Unknown"].cumulative_revenue == D("33.00")
    march = got[2024, 3, "SP", "Toys"]  # the month before that has revenue is January
    assert (march.prev_month_revenue, march.mom_growth_pct, march.cumulative_revenue) == (D("11.00"), D("-50.00"), D("38.50"))
    assert got[2024, 5, "SP", "Toys"].mom_growth_pct == D("-100.00")
    assert got[2024, 6, "SP", "Toys"].mom_growth_pct is None
    assert got[2024, 1, "SP", "Toys"].month_name == "January"
    last = max((r for r in got.values() if r.state == "SP"), key=lambda r: (r.year, r.month, r.product_category))
    assert last.cumulative_revenue == sum(r.total_revenue for r in got.values() if r.state == "SP")


def test_rank_ties(spark):
    df = spark.createDataFrame([(2024, 1, "a", 5), (2024, 1, "b", 5), (2024, 1, "c", 3)], "year int, month int, state string, total_revenue int")
    assert sorted(r.revenue_rank_in_month for r in mart.rank_in_month(df).collect()) == [1, 1, 2]


def values(df):
    return {(r.kpi_name, r.dimension_value): r.kpi_value for r in df.collect()}


def test_kpis(spark):
    m, sales, customers, products = the_mart(spark)
    got = values(kpis.build_kpi_summary(sales, customers, products, m, AS_OF, RUN_TS))
    assert got["total_revenue", "all"] == D("48.6000")
    assert got["total_orders", "all"] == D("5.0000")
    assert got["avg_order_value", "all"] == D("9.7200")
    assert got["total_customers", "all"] == D("2.0000")
    assert got["revenue_by_state", "SP"] == D("40.5000")
    assert ("revenue_by_state", "None") not in got
    assert got["revenue_by_category", "Toys"] == D("19.6000")
    assert got["late_delivery_rate_pct", "all"] == D("40.0000")  # two of five flagged rows
    assert got["latest_mom_revenue_growth_pct", "SP"] == D("-50.0000")


def test_kpis_of_an_empty_fact(spark):
    m, sales, customers, products = the_mart(spark, items=ITEMS[:1])
    nothing = sales.limit(0)
    got = values(kpis.build_kpi_summary(nothing, customers.limit(0), products, m.limit(0), AS_OF, RUN_TS))
    assert got == {
        (name, "all"): D("0.0000")
        for name in ("total_revenue", "total_orders", "avg_order_value", "total_customers", "late_delivery_rate_pct")
    }
    assert tuple(reports.report_cards(nothing).first()) == (D("0.00"), 0, D("0.00"), D("0.00"))


def test_top_ten_tie_breaks_by_name(spark):
    sales = spark.createDataFrame([(i, D("1.00")) for i in range(1, 13)], "customer_key bigint, total_item_value decimal(12,2)")
    dim = spark.createDataFrame([(i, f"S{i:02d}") for i in range(1, 13)], "customer_key bigint, state string")
    assert sorted(r.label for r in kpis.revenue_by_state(sales, dim).collect()) == [f"S{i:02d}" for i in range(1, 11)]


def test_dim_date(spark):
    days = dimensions.build_dim_date(dimensions.date_bounds(spark))
    assert days.count() == 3287
    d = days.where("full_date = DATE'2021-01-01'").first()
    assert (d.date_key, d.week_of_year, d.day_of_week, d.day_name, d.month_name) == (20210101, 53, 5, "Friday", "January")
    sunday = days.where("full_date = DATE'2024-03-31'").first()
    assert (sunday.day_of_week, sunday.is_weekend, sunday.is_month_end, sunday.quarter) == (0, True, True, 1)
    assert days.agg(F.min("full_date"), F.max("full_date")).first()[:] == (date(2017, 1, 1), date(2025, 12, 31))


def test_sales_keys_are_unique(spark):
    keyed = fact.with_sales_keys(spark.range(1000).repartition(5), 50, RUN_TS)
    assert keyed.select("sales_key").distinct().count() == 1000
    assert keyed.agg(F.min("sales_key")).first()[0] > 50
