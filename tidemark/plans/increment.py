"""The fact and the mart after an increment: only what it touches is built anew."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.digests import row_digest
from tidemark.plans.fact import build_fact_sales

#: yyyymm of a fact row, as the tables in months have it.
FACT_MONTH = "coalesce(order_date_key div 100, 0)"


def differing(before: DataFrame, after: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """The keys whose rows are not the same before and after, or are on one side only. Keys and digests meet, no
    rows; a key may have several rows."""
    name = ["_d0", "_d1"]

    def digested(df: DataFrame) -> DataFrame:
        return df.select(*key, *[c.alias(n) for c, n in zip(row_digest([F.col(c) for c in columns]), name, strict=True)])

    sides = digested(before).withColumn("_side", F.lit(1)).unionByName(digested(after).withColumn("_side", F.lit(-1)))
    odd = sides.groupBy(*key, *name).agg(F.sum("_side").alias("_side")).where(F.col("_side") != 0)
    return odd.select(*key).distinct()


def affected_orders(
    changed_orders: DataFrame,
    new_items: DataFrame,
    new_payments: DataFrame,
    orders: DataFrame,
    items: DataFrame,
    customers: DataFrame | None,
    products: DataFrame | None,
    sellers: DataFrame | None,
) -> DataFrame:
    """order_id of every order whose fact rows may differ: changed itself, with new items or payments, or pointing
    to one of the given customers, products or sellers, whose current key is new; None says that there are none.

    Of orders and items only two columns are read, and they meet nothing but the few new keys.
    """
    found = [changed_orders, new_items, new_payments]
    for rows, dimension, key in ((orders, customers, "customer_id"), (items, products, "product_id"), (items, sellers, "seller_id")):
        if dimension is not None:
            found.append(rows.select("order_id", key).join(dimension.select(key), key, "left_semi"))
    every = reduce(DataFrame.unionByName, [f.select("order_id") for f in found])
    return every.where(F.col("order_id").isNotNull()).distinct()


def rebuilt_orders(
    affected: DataFrame,
    items: DataFrame,
    orders: DataFrame,
    payments: DataFrame,
    dim_customer: DataFrame,
    dim_product: DataFrame,
    dim_seller: DataFrame,
) -> DataFrame:
    """The fact rows of the affected orders, as a full build would give them."""

    def of_these(df: DataFrame) -> DataFrame:
        return df.join(affected, "order_id", "left_semi").select(*df.columns)

    return build_fact_sales(of_these(items), of_these(orders), of_these(payments), dim_customer, dim_product, dim_seller)


def months_of(fact: DataFrame) -> list[int]:
    """The months of fact rows, as yyyymm: a list as long as the calendar."""
    return sorted(r[0] for r in fact.select(F.expr(FACT_MONTH).cast("bigint").alias("m")).distinct().collect())
