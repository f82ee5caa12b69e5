"""Reports over gold and the run metadata."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import ratio


def report_cards(fact: DataFrame) -> DataFrame:
    """Payments, orders, payments per order and freight. An order's payment stands on each of its items
    and is counted there each time."""
    per_order = fact.groupBy("order_id").agg(F.sum("payment_value").alias("paid"), F.sum("freight_value").alias("freight"))
    totals = per_order.agg(
        F.coalesce(F.sum("paid"), F.lit(0)).cast("decimal(26,2)").alias("total_revenue"),
        F.count("order_id").alias("total_orders"),
        F.coalesce(F.sum("freight"), F.lit(0)).cast("decimal(26,2)").alias("total_freight"),
    )
    average = ratio(F.col("total_revenue"), F.col("total_orders").cast("decimal(12,0)"), 2, 26)
    return totals.select(
        "total_revenue", "total_orders",
        F.coalesce(average, F.lit(0).cast("decimal(26,2)")).alias("avg_order_value"),
        "total_freight",
    )


def daily_revenue(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Payments by day; summed by day key before the join."""
    per_day = fact.groupBy("order_date_key").agg(
        F.coalesce(F.sum("payment_value"), F.lit(0)).cast("decimal(26,2)").alias("revenue")
    )
    days = dim_date.select(F.col("date_key").alias("order_date_key"), "full_date")
    return per_day.join(days, "order_date_key").select("full_date", "revenue").orderBy("full_date")


def top_categories(fact: DataFrame, dim_product: DataFrame, top: int = 10) -> DataFrame:
    """The categories with the highest payments, lowest first."""
    per_product = (
        fact.where(F.col("product_key").isNotNull()).groupBy("product_key").agg(F.sum("payment_value").alias("paid"))
    )
    named = dim_product.where(F.col("product_category_name").isNotNull()).select("product_key", "product_category_name")
    return (
        per_product.join(named, "product_key")
        .groupBy("product_category_name")
        .agg(F.coalesce(F.sum("paid"), F.lit(0)).cast("decimal(26,2)").alias("revenue"))
        .orderBy(F.col("revenue").desc(), "product_category_name")
        .limit(top)
        .orderBy("revenue", F.col("product_category_name").desc())
    )


def orders_by_state(fact: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Distinct orders by the customer's state."""
    placed = fact.where(F.col("customer_key").isNotNull()).select("customer_key", "order_id").distinct()
    states = dim_customer.where(F.col("state").isNotNull()).select("customer_key", "state")
    return placed.join(states, "customer_key").groupBy("state").agg(F.count_distinct("order_id").alias("orders"))


def status_mix(fact: DataFrame) -> DataFrame:
    """Distinct orders by status."""
    return (
        fact.where(F.col("order_status").isNotNull())
        .groupBy("order_status")
        .agg(F.count_distinct("order_id").alias("orders"))
    )


def revenue_by_region(mart: DataFrame) -> DataFrame:
    return (
        mart.groupBy("region")
        .agg(F.sum("total_revenue").cast("decimal(32,2)").alias("revenue"))
        .orderBy(F.col("revenue").desc(), "region")
    )


def state_growth(mart: DataFrame, state: str) -> DataFrame:
    """The months of one state with their growth."""
    return (
        mart.where(F.col("state") == state)
        .select("year", "month", "state", "product_category", "total_revenue", "mom_growth_pct")
        .orderBy("year", "month", "product_category")
    )


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def dq_report(dq_results: DataFrame) -> DataFrame:
    """Checks passed and failed per table."""
    return (
        dq_results.groupBy("table_name")
        .agg(
            F.count_if("passed").alias("passed"),
            F.count_if(~F.col("passed")).alias("failed"),
        )
        .orderBy("table_name")
    )


def dq_listing(dq_results: DataFrame) -> DataFrame:
    """All check outcomes, the latest first."""
    return dq_results.select(
        "table_name", "check_name", "passed", "total_records", "failed_records", "success_pct", "severity", "checked_at"
    ).orderBy(F.col("checked_at").desc(), "table_name", "check_name")


def recent_runs(runs: DataFrame, n: int = 12) -> DataFrame:
    """The latest runs with their counts and seconds."""
    return runs.orderBy(F.col("start_time").desc(), "batch_id").limit(n).select(
        "pipeline_name", "status", "records_inserted", "records_updated", "records_rejected",
        F.round("duration_seconds", 1).cast("decimal(11,1)").alias("duration_seconds"),
    )
