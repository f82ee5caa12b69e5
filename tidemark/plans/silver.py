"""Bronze text to typed, cleaned and enriched silver rows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import lookups
from tidemark.functions.moments import day, elapsed_days, to_day, to_moment
from tidemark.functions.numbers import to_decimal, to_money, to_whole
from tidemark.functions.text import mapped, strip, title_case, zero_fill
from tidemark.schemas import FILE_ORDER


def batch_slice(bronze: DataFrame, batch_id: str) -> DataFrame:
    """The rows of one batch that were not rejected; prunes to the batch's partition."""
    return bronze.where((F.col("batch_id") == batch_id) & ~F.col("is_rejected"))


def latest_batch(bronze: DataFrame) -> DataFrame:
    """The id of the batch loaded last, or UNKNOWN for an empty table."""
    newest = F.max_by("batch_id", F.struct("load_timestamp", "batch_id"))
    return bronze.agg(F.coalesce(newest, F.lit("UNKNOWN")).alias("batch_id"))


def latest_slice(bronze: DataFrame) -> DataFrame:
    """The rows of the batch loaded last; the one-row id is broadcast."""
    return bronze.join(F.broadcast(latest_batch(bronze)), "batch_id", "left_semi")


def _with_states(df: DataFrame, states: DataFrame | None) -> DataFrame:
    """Upper-case state code with its name and region; a code the lookup lacks becomes NULL.

    The lookup's own size decides whether the join is broadcast.
    """
    known = lookups.state_lookup(df.sparkSession) if states is None else states
    known = known.select(
        F.col("state_code").alias("_code"), F.col("state_name").alias("_name"), F.col("region").alias("_region")
    )
    return (
        df.withColumn("state", F.upper(strip(F.col("state"))))
        .join(known, F.col("state") == F.col("_code"), "left")
        .withColumns({"state": F.col("_code"), "state_name": F.col("_name"), "region": F.col("_region")})
        .drop("_code", "_name", "_region")
    )


def _versioned(as_of: date) -> list[Column]:
    return [
        day(as_of).alias("effective_start_date"),
        F.lit(None).cast("date").alias("effective_end_date"),
        F.lit(True).alias("is_current"),
        F.lit(1).alias("version_number"),
    ]


def _place(bronze: DataFrame) -> list[str]:
    """Where the row stood in its file, if bronze knows; the table to be written takes it no further."""
    return [c for c in FILE_ORDER if c in bronze.columns]


def _origin(batch_id: str, source_system: str) -> list[Column]:
    return [F.lit(batch_id).alias("batch_id"), F.lit(source_system).alias("source_system")]


def transform_customers(bronze: DataFrame, batch_id: str, as_of: date, states: DataFrame | None = None) -> DataFrame:
    return _with_states(bronze, states).select(
        strip(F.col("customer_id")).alias("customer_id"),
        strip(F.col("customer_unique_id")).alias("customer_unique_id"),
        zero_fill(strip(F.col("zip_code_prefix")), 5).alias("zip_code_prefix"),
        title_case(strip(F.col("city"))).alias("city"),
        "state", "state_name", "region",
        *_versioned(as_of),
        *_origin(batch_id, "CSV"),
        *_place(bronze),
    ).where(F.col("customer_id").isNotNull())


def transform_sellers(bronze: DataFrame, batch_id: str, as_of: date, states: DataFrame | None = None) -> DataFrame:
    return _with_states(bronze, states).select(
        strip(F.col("seller_id")).alias("seller_id"),
        zero_fill(strip(F.col("zip_code_prefix")), 5).alias("zip_code_prefix"),
        title_case(strip(F.col("city"))).alias("city"),
        "state", "state_name", "region",
        *_versioned(as_of),
        *_origin(batch_id, "CSV"),
        *_place(bronze),
    ).where(F.col("seller_id").isNotNull())


def transform_orders(bronze: DataFrame) -> DataFrame:
    """Status group, whole days to delivery, and whether the delivery came after the estimate."""
    typed = bronze.select(
        strip(F.col("order_id")).alias("order_id"),
        strip(F.col("customer_id")).alias("customer_id"),
        F.lower(strip(F.col("order_status"))).alias("order_status"),
        to_moment(F.col("order_purchase_timestamp")).alias("order_purchase_timestamp"),
        to_moment(F.col("order_approved_at")).alias("order_approved_at"),
        to_moment(F.col("order_delivered_at")).alias("order_delivered_at"),
        to_day(F.col("order_estimated_delivery")).alias("order_estimated_delivery"),
        *_place(bronze),
    ).where(F.col("order_id").isNotNull() & F.col("customer_id").isNotNull())
    return typed.select("*", *delivery_columns()).withColumn(
        "order_status_category", mapped(F.col("order_status"), lookups.STATUS_GROUPS, "unknown")
    )


def delivery_columns() -> list[Column]:
    late = F.col("order_delivered_at").cast("date") > F.col("order_estimated_delivery")
    return [
        elapsed_days(F.col("order_purchase_timestamp"), F.col("order_delivered_at")).alias("delivery_days"),
        F.coalesce(late, F.lit(False)).alias("is_late_delivery"),
    ]


def transform_products(bronze: DataFrame, batch_id: str, categories: DataFrame | None = None) -> DataFrame:
    known = lookups.category_lookup(bronze.sparkSession) if categories is None else categories
    known = known.select(F.col("category_pt").alias("_pt"), F.col("category_en").alias("_en"))
    sizes = ["product_length_cm", "product_height_cm", "product_width_cm"]
    # The volume takes the sizes before they are rounded to two places.
    length, height, width = [to_decimal(F.col(c), 12, 4) for c in sizes]
    return (
        bronze.select(
            strip(F.col("product_id")).alias("product_id"),
            F.lower(strip(F.col("product_category_name"))).alias("product_category_name"),
            *[
                to_whole(F.col(c)).alias(c)
                for c in ("product_name_length", "product_description_length", "product_photos_qty")
            ],
            *[to_decimal(F.col(c), 10, 2).alias(c) for c in ("product_weight_g", *sizes)],
            F.round(length * height * width, 2).try_cast("decimal(12,2)").alias("product_volume_cm3"),
            *_place(bronze),
        )
        .where(F.col("product_id").isNotNull())
        .join(known, F.col("product_category_name") == F.col("_pt"), "left")
        .withColumn("product_category_english", F.coalesce("_en", F.lit("Others")))
        .drop("_pt", "_en")
        .select("*", *_origin(batch_id, "XML"))
    )


def transform_order_items(bronze: DataFrame, batch_id: str) -> DataFrame:
    return bronze.select(
        strip(F.col("order_id")).alias("order_id"),
        to_whole(F.col("order_item_id")).alias("order_item_id"),
        strip(F.col("product_id")).alias("product_id"),
        strip(F.col("seller_id")).alias("seller_id"),
        to_moment(F.col("shipping_limit_date")).alias("shipping_limit_date"),
        to_money(F.col("price")).alias("price"),
        to_money(F.col("freight_value")).alias("freight_value"),
    ).where(F.col("order_id").isNotNull()).select(
        "*", to_money(F.col("price") + F.col("freight_value")).alias("total_item_value"), *_origin(batch_id, "CSV")
    )


def transform_payments(bronze: DataFrame, batch_id: str) -> DataFrame:
    return bronze.select(
        strip(F.col("order_id")).alias("order_id"),
        to_whole(F.col("payment_sequential")).alias("payment_sequential"),
        F.lower(strip(F.col("payment_type"))).alias("payment_type"),
        to_whole(F.col("payment_installments")).alias("payment_installments"),
        to_money(F.col("payment_value")).alias("payment_value"),
    ).where(F.col("order_id").isNotNull()).select(
        "*",
        mapped(F.col("payment_type"), lookups.PAYMENT_GROUPS, "other").alias("payment_type_category"),
        *_origin(batch_id, "JSON"),
    )
