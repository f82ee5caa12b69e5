"""The test tables seen as customers, sellers, products, orders, items and payments.

`raw_*` are bronze-like frames of text; the others are typed silver frames.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.text import mapped
from tidemark.plans.silver import delivery_columns
from tidemark.sources.position import parquet_position

# How the tables' codes read as statuses and payment types.
STATUS = {"F": "delivered", "O": "shipped", "P": "processing"}
PAYMENT = {"1": "credit_card", "2": "debit_card", "3": "boleto", "4": "voucher", "5": "other"}


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A test table; its schema is looked up in the file once."""
    path = f"{folder}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def placed(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table with each row's place in its files."""
    df = table(spark, folder, name)
    return df.select("*", parquet_position())


def places(spark: SparkSession, folder: str) -> DataFrame:
    """Nations with their regions, as the state lookup."""
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("nationkey"),
        F.col("n_name").alias("state_code"),
        F.col("n_name").alias("state_name"),
        F.col("r_name").alias("region"),
    )


def kinds(spark: SparkSession, folder: str) -> DataFrame:
    """Part types as the category lookup; ECONOMY has no entry."""
    part = table(spark, folder, "part").select("p_type").distinct()
    return part.where(F.col("p_type") != "ECONOMY").select(
        F.lower("p_type").alias("category_pt"), F.initcap("p_type").alias("category_en")
    )


def _text(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def raw_customers(spark: SparkSession, folder: str) -> DataFrame:
    customer, nation = table(spark, folder, "customer"), table(spark, folder, "nation")
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        F.concat(F.lit(" "), _text("c_custkey")).alias("customer_id"),
        _text("c_custkey").alias("customer_unique_id"),
        _text("c_custkey").alias("zip_code_prefix"),
        F.concat(F.lit("\t"), F.lower("c_name"), F.lit(" d'"), F.upper("c_mktsegment"), F.lit("  ")).alias("city"),
        F.when(F.col("c_mktsegment") == "MACHINERY", "nowhere").otherwise(F.lower("n_name")).alias("state"),
    )


def raw_sellers(spark: SparkSession, folder: str) -> DataFrame:
    supplier, nation = table(spark, folder, "supplier"), table(spark, folder, "nation")
    return supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left").select(
        _text("s_suppkey").alias("seller_id"),
        _text("s_suppkey").alias("zip_code_prefix"),
        F.concat(F.upper("s_name"), F.lit("\n")).alias("city"),
        F.concat(F.lit(" "), F.lower("n_name")).alias("state"),
    )


def raw_products(spark: SparkSession, folder: str) -> DataFrame:
    size = _text("p_size")
    return table(spark, folder, "part").select(
        _text("p_partkey").alias("product_id"),
        F.concat(F.lit(" "), F.col("p_type"), F.lit(" ")).alias("product_category_name"),
        F.concat(_text(F.length("p_name")), F.lit(".0")).alias("product_name_length"),
        _text(F.length("p_brand")).alias("product_description_length"),
        F.when(F.col("p_type") == "PROMO", "many").otherwise("1").alias("product_photos_qty"),
        _text(F.col("p_retailprice").cast("decimal(12,2)")).alias("product_weight_g"),
        size.alias("product_length_cm"),
        F.concat(size, F.lit(".5")).alias("product_height_cm"),
        F.when(F.col("p_type") == "SMALL", "wide").otherwise(size).alias("product_width_cm"),
    )


def _delivered(spark: SparkSession, folder: str) -> DataFrame:
    """The last shipping day of each order."""
    return table(spark, folder, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("last_shipped"))


def _order_rows(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    return orders.join(_delivered(spark, folder), F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        _text("o_orderkey").alias("order_id"),
        _text("o_custkey").alias("customer_id"),
        mapped(F.col("o_orderstatus"), STATUS, "unknown").alias("order_status"),
        F.col("o_orderdate").alias("order_purchase_timestamp"),
        F.when(F.col("o_orderstatus") == "F", F.col("last_shipped")).alias("order_delivered_at"),
        F.date_add(F.col("o_orderdate").cast("date"), 45).alias("order_estimated_delivery"),
    )


def raw_orders(spark: SparkSession, folder: str) -> DataFrame:
    return _order_rows(spark, folder).select(
        "order_id",
        "customer_id",
        F.concat(F.lit(" "), F.upper("order_status")).alias("order_status"),
        _text("order_purchase_timestamp").alias("order_purchase_timestamp"),
        F.lit("2024-02-30 00:00:00").alias("order_approved_at"),
        _text("order_delivered_at").alias("order_delivered_at"),
        _text("order_estimated_delivery").alias("order_estimated_delivery"),
    )


def orders(spark: SparkSession, folder: str) -> DataFrame:
    return _order_rows(spark, folder).select("*", *delivery_columns())


def _price() -> Column:
    return F.col("l_extendedprice").cast("decimal(12,2)")


def _freight() -> Column:
    return (_price() * F.col("l_tax").cast("decimal(4,2)")).cast("decimal(12,2)")


def raw_order_items(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        _text("l_orderkey").alias("order_id"),
        F.concat(_text("l_linenumber"), F.lit(".0")).alias("order_item_id"),
        F.concat(F.lit(" "), _text("l_partkey")).alias("product_id"),
        _text("l_suppkey").alias("seller_id"),
        _text("l_shipdate").alias("shipping_limit_date"),
        F.when(F.col("l_returnflag") == "R", F.concat(_text(_price()), F.lit("d"))).otherwise(_text(_price())).alias("price"),
        _text(_freight()).alias("freight_value"),
    )


def order_items(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        _text("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        _text("l_partkey").alias("product_id"),
        _text("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        _price().alias("price"),
        _freight().alias("freight_value"),
        (_price() + _freight()).cast("decimal(12,2)").alias("total_item_value"),
    )


def raw_payments(spark: SparkSession, folder: str) -> DataFrame:
    digit = F.substring("o_orderpriority", 1, 1)
    return table(spark, folder, "orders").select(
        _text("o_orderkey").alias("order_id"),
        F.lit("1").alias("payment_sequential"),
        F.concat(F.upper(mapped(digit, PAYMENT, "other")), F.lit(" ")).alias("payment_type"),
        digit.alias("payment_installments"),
        _text(F.col("o_totalprice").cast("decimal(12,2)")).alias("payment_value"),
    )


def payments(spark: SparkSession, folder: str) -> DataFrame:
    digit = F.substring("o_orderpriority", 1, 1)
    return table(spark, folder, "orders").select(
        _text("o_orderkey").alias("order_id"),
        F.lit(1).alias("payment_sequential"),
        mapped(digit, PAYMENT, "other").alias("payment_type"),
        digit.cast("int").alias("payment_installments"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("payment_value"),
    )


def instalments(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as part payments: many per order, some without a type."""
    return table(spark, folder, "lineitem").select(
        _text("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("payment_sequential"),
        F.when(F.col("l_returnflag") != "R", F.col("l_returnflag")).alias("payment_type"),
        F.col("l_quantity").cast("int").alias("payment_installments"),
        _price().alias("payment_value"),
    )


def customers(spark: SparkSession, folder: str) -> DataFrame:
    """Current customers, with the key they have in gold."""
    customer = table(spark, folder, "customer")
    return customer.join(places(spark, folder), F.col("c_nationkey") == F.col("nationkey"), "left").select(
        _text("c_custkey").alias("customer_id"),
        _text("c_custkey").alias("customer_unique_id"),
        _text("c_custkey").alias("zip_code_prefix"),
        F.col("c_name").alias("city"),
        F.col("state_code").alias("state"),
        "state_name",
        "region",
        F.lit(True).alias("is_current"),
        (F.col("c_custkey") + 1).alias("customer_key"),
    )


def sellers(spark: SparkSession, folder: str) -> DataFrame:
    supplier = table(spark, folder, "supplier")
    return supplier.join(places(spark, folder), F.col("s_nationkey") == F.col("nationkey"), "left").select(
        _text("s_suppkey").alias("seller_id"),
        _text("s_suppkey").alias("zip_code_prefix"),
        F.col("s_name").alias("city"),
        F.col("state_code").alias("state"),
        "state_name",
        "region",
        F.lit(True).alias("is_current"),
        (F.col("s_suppkey") + 1).alias("seller_key"),
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    size = F.col("p_size").cast("decimal(10,2)")
    return table(spark, folder, "part").select(
        _text("p_partkey").alias("product_id"),
        F.lower("p_type").alias("product_category_name"),
        F.initcap("p_type").alias("product_category_english"),
        F.length("p_name").alias("product_name_length"),
        F.length("p_brand").alias("product_description_length"),
        F.lit(1).alias("product_photos_qty"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("product_weight_g"),
        F.when(F.col("p_type") != "LARGE", (size * size * size).cast("decimal(12,2)")).alias("product_volume_cm3"),
        (F.col("p_partkey") + 1).alias("product_key"),
    )


def day_bounds(spark: SparkSession, folder: str) -> DataFrame:
    """First and last day on which anything was ordered or shipped."""
    ordered = table(spark, folder, "orders").select(F.col("o_orderdate").cast("date").alias("d"))
    shipped = table(spark, folder, "lineitem").select(F.col("l_shipdate").cast("date").alias("d"))
    return ordered.unionByName(shipped).agg(F.min("d").alias("first_day"), F.max("d").alias("last_day"))


def customer_keys(spark: SparkSession, folder: str) -> DataFrame:
    """The columns of the customer dimension that the fact looks up."""
    key = F.col("c_custkey")
    return table(spark, folder, "customer").select(
        _text(key).alias("customer_id"), (key + 1).alias("customer_key"), F.lit(True).alias("is_current")
    )


def seller_keys(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("s_suppkey")
    return table(spark, folder, "supplier").select(
        _text(key).alias("seller_id"), (key + 1).alias("seller_key"), F.lit(True).alias("is_current")
    )


def product_keys(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("p_partkey")
    return table(spark, folder, "part").select(_text(key).alias("product_id"), (key + 1).alias("product_key"))
