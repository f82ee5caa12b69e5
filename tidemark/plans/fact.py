"""The sales fact: one row per order item."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.moments import date_key, moment

# One id for every way of running, so that a run replaces the fact of the one before.
FACT_BATCH = "FULL_RUN"


def payments_per_order(payments: DataFrame) -> DataFrame:
    """Sum of the payments, and type and instalments of the first payment that has them."""
    seq = F.col("payment_sequential")
    place = F.struct(
        seq.isNull(), seq, F.col("payment_type"), F.col("payment_installments"), F.col("payment_value")
    )

    def first(name: str) -> Column:
        return F.min_by(name, F.when(F.col(name).isNotNull(), place)).alias(name)

    return (
        payments.where(F.col("order_id").isNotNull())
        .groupBy("order_id")
        .agg(
            F.coalesce(F.sum("payment_value"), F.lit(0)).cast("decimal(22,2)").alias("payment_value"),
            first("payment_type"),
            first("payment_installments"),
        )
    )


def build_fact_sales(
    items: DataFrame,
    orders: DataFrame,
    payments: DataFrame,
    dim_customer: DataFrame,
    dim_product: DataFrame,
    dim_seller: DataFrame,
    batch_id: str = FACT_BATCH,
) -> DataFrame:
    """Items with their order, the order's payments and today's dimension keys.

    Everything that hangs on the order - customer key, payments - is joined at order grain first, where
    keys are unique. The items, the only large and possibly skewed side, look up products and sellers while
    their rows are still narrow and meet the order last: its columns move once, and an order's rows come out
    next to each other, which packs well on the way to the table and in it. Each join is a single pair of
    exchanges, so adaptive execution can split a hot order, product or seller, and broadcasts a dimension
    only if its measured size allows.
    """
    customers = dim_customer.where("is_current").select("customer_id", "customer_key")
    sellers = dim_seller.where("is_current").select("seller_id", "seller_key")
    products = dim_product.select("product_id", "product_key")

    placed = orders.where(F.col("order_id").isNotNull()).select(
        "order_id", "customer_id", "order_status", "delivery_days", "is_late_delivery",
        date_key(F.col("order_purchase_timestamp")).alias("order_date_key"),
        date_key(F.col("order_delivered_at")).alias("delivery_date_key"),
    ).join(customers, "customer_id", "left")
    # An item's payments count even if its order is unknown.
    per_order = placed.join(payments_per_order(payments), "order_id", "full_outer")

    return (
        items.where(F.col("order_id").isNotNull())
        .select("order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value", "total_item_value")
        .join(products, "product_id", "left")
        .join(sellers, "seller_id", "left")
        .join(per_order, "order_id", "left")
        .select(
            "order_id", "order_item_id", "customer_key", "product_key", "seller_key", "order_date_key",
            "delivery_date_key", "price", "freight_value", "total_item_value", "payment_value", "payment_type",
            "payment_installments", "delivery_days", "is_late_delivery", "order_status",
            F.lit(batch_id).alias("batch_id"),
        )
    )


def with_sales_keys(fact: DataFrame, start: int, run_ts: datetime) -> DataFrame:
    """Unique, rising sales keys after `start`, given as the rows are written; like a database
    sequence they may have gaps, which saves a second pass over the fact."""
    return fact.select(
        (F.lit(start + 1) + F.monotonically_increasing_id()).alias("sales_key"),
        "*",
        moment(run_ts).alias("created_at"),
    )
