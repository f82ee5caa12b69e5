"""Key figures, one row each."""

from __future__ import annotations

from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.moments import day, moment
from tidemark.functions.numbers import ratio
from tidemark.session import settled

TOP = 10
GROWTH_STATE = "SP"


def order_figures(fact: DataFrame) -> DataFrame:
    """Revenue, orders, average order value and late share from one shuffle by order.

    Each order is summed first; the four figures are then sums over orders.
    """
    return _order_ratios(fact.groupBy("order_id").agg(*_sums()).agg(*_sums_of_orders()))


def _sums() -> list[Column]:
    return [
        F.sum("total_item_value").alias("value"),
        F.count("is_late_delivery").alias("flagged"),
        F.count_if("is_late_delivery").alias("late"),
    ]


def _sums_of_orders() -> list[Column]:
    return [
        F.sum("value").cast("decimal(26,2)").alias("revenue"),
        F.count("order_id").alias("orders"),
        F.count("value").alias("valued_orders"),
        F.sum("flagged").alias("flagged"),
        F.sum("late").alias("late"),
    ]


def _order_ratios(sums: DataFrame) -> DataFrame:
    return sums.select(
        F.col("revenue").alias("total_revenue"),
        F.col("orders").cast("decimal(16,0)").alias("total_orders"),
        ratio(F.col("revenue"), F.col("valued_orders").cast("decimal(12,0)"), 4).alias("avg_order_value"),
        ratio(F.col("late").cast("decimal(16,0)") * 100, F.col("flagged").cast("decimal(16,0)"), 2).alias(
            "late_delivery_rate_pct"
        ),
    )


def current_customers(dim_customer: DataFrame) -> DataFrame:
    return dim_customer.where("is_current").agg(F.count(F.lit(1)).cast("decimal(16,0)").alias("total_customers"))


def _top_revenue(fact: DataFrame, dimension: DataFrame, key: str, label: str) -> DataFrame:
    # Summed per key before the join: a hot key arrives there as one row.
    per_key = fact.where(F.col(key).isNotNull()).groupBy(key).agg(F.sum("total_item_value").alias("revenue"))
    return _top_labels(per_key, dimension, key, label)


def _top_labels(per_key: DataFrame, dimension: DataFrame, key: str, label: str) -> DataFrame:
    named = dimension.where(F.col(label).isNotNull()).select(key, F.col(label).alias("label"))
    return (
        per_key.join(named, key)
        .groupBy("label")
        .agg(F.sum("revenue").cast("decimal(26,2)").alias("revenue"))
        .orderBy(F.col("revenue").desc_nulls_first(), "label")
        .limit(TOP)
    )


# What GROUPING_ID() is for each set of (order_id, customer_key, product_key).
_ORDERS, _CUSTOMERS, _PRODUCTS = 0b011, 0b101, 0b110


def sums_of_sets(fact: DataFrame) -> DataFrame:
    """Sums by order, by customer and by product from one read of the fact, settled.

    The orders, by far the most, are then summed to one row; what is written is a row per customer and product.
    """
    keys = ["order_id", "customer_key", "product_key"]
    sets = fact.groupingSets([[F.col(k)] for k in keys], *keys).agg(F.grouping_id().alias("set"), *_sums())
    one = sets.groupBy("set", "customer_key", "product_key").agg(*_sums_of_orders())
    return settled(one)


def revenue_by_state(fact: DataFrame, dim_customer: DataFrame) -> DataFrame:
    return _top_revenue(fact, dim_customer, "customer_key", "state")


def revenue_by_category(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    return _top_revenue(fact, dim_product, "product_key", "product_category_english")


def latest_growth(mart: DataFrame, state: str = GROWTH_STATE) -> DataFrame:
    """Growth of the state's last month; of several categories the first by name."""
    return (
        mart.where(F.col("state") == state)
        .orderBy(F.col("year").desc(), F.col("month").desc(), "product_category")
        .limit(1)
        .select(F.col("mom_growth_pct").alias("growth"), F.col("state").alias("label"))
    )


def kpi_row(name: str, value: Column, unit: str, dimension: str, dimension_value: Column, as_of: date) -> Column:
    """The common shape of a key figure: four decimals, and 0 for no value."""
    return F.struct(
        F.lit(name).alias("kpi_name"),
        F.coalesce(F.round(value.cast("decimal(32,6)"), 4).cast("decimal(28,4)"), F.lit(0).cast("decimal(28,4)")).alias(
            "kpi_value"
        ),
        F.lit(unit).alias("kpi_unit"),
        F.lit(dimension).alias("dimension"),
        dimension_value.cast("string").alias("dimension_value"),
        day(as_of).alias("as_of_date"),
    )


def build_kpi_summary(
    fact: DataFrame,
    dim_customer: DataFrame,
    dim_product: DataFrame,
    mart: DataFrame,
    as_of: date,
    run_ts: datetime,
    growth_state: str = GROWTH_STATE,
) -> DataFrame:
    """All key figures, from one read of the fact."""
    everything = F.lit("all")
    sums = sums_of_sets(fact)

    def of(which: int, key: str) -> DataFrame:
        return sums.where((F.col("set") == which) & F.col(key).isNotNull()).select(key, "revenue")

    # Without a sale there is no set of orders either, but still a row of figures.
    totals = sums.where(F.col("set") == _ORDERS).agg(
        *[F.sum(c).alias(c) for c in ("revenue", "orders", "valued_orders", "flagged", "late")]
    )
    totals = totals.withColumn("orders", F.coalesce("orders", F.lit(0)))
    orders = _order_ratios(totals).select(
        F.explode(
            F.array(
                kpi_row("total_revenue", F.col("total_revenue"), "BRL", "overall", everything, as_of),
                kpi_row("total_orders", F.col("total_orders"), "count", "overall", everything, as_of),
                kpi_row("avg_order_value", F.col("avg_order_value"), "BRL", "overall", everything, as_of),
                kpi_row("late_delivery_rate_pct", F.col("late_delivery_rate_pct"), "%", "quality", everything, as_of),
            )
        ).alias("kpi")
    )
    customers = current_customers(dim_customer).select(
        kpi_row("total_customers", F.col("total_customers"), "count", "overall", everything, as_of).alias("kpi")
    )
    states = _top_labels(of(_CUSTOMERS, "customer_key"), dim_customer, "customer_key", "state").select(
        kpi_row("revenue_by_state", F.col("revenue"), "BRL", "state", F.col("label"), as_of).alias("kpi")
    )
    by_product = of(_PRODUCTS, "product_key")
    categories = _top_labels(by_product, dim_product, "product_key", "product_category_english").select(
        kpi_row("revenue_by_category", F.col("revenue"), "BRL", "category", F.col("label"), as_of).alias("kpi")
    )
    growth = latest_growth(mart, growth_state).select(
        kpi_row("latest_mom_revenue_growth_pct", F.col("growth"), "%", "trend", F.col("label"), as_of).alias("kpi")
    )
    rows = reduce(DataFrame.unionByName, [orders, customers, states, categories, growth])
    return rows.select("kpi.*", moment(run_ts).alias("computed_at"))
