"""Gold dimensions."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.moments import date_key
from tidemark.operators.history import overwrite_dimension, version_dimension
from tidemark.operators.keys import number_new_rows

# The columns whose change opens a new version.
COMPARED = ["city", "state", "zip_code_prefix"]

# The first and last day of the date dimension.
FIRST_DAY, LAST_DAY = date(2017, 1, 1), date(2025, 12, 31)


# What a customer and a seller take from silver.
CUSTOMER = ["customer_id", "customer_unique_id", "zip_code_prefix", "city", "state", "state_name", "region"]
SELLER = ["seller_id", "zip_code_prefix", "city", "state", "state_name", "region"]


def _versioned_dimension(
    silver: DataFrame, existing: DataFrame, key: str, surrogate: str, columns: list[str], as_of: date, run_ts: datetime
) -> DataFrame:
    incoming = silver.where("is_current").select(*columns)
    current = existing.where("is_current")
    versions = version_dimension(current, incoming, key, COMPARED, as_of, run_ts)
    return number_new_rows(versions, surrogate, [key], existing)


def build_dim_customer(silver: DataFrame, existing: DataFrame, as_of: date, run_ts: datetime) -> DataFrame:
    """Current and newly closed customer versions, with `_change` (see `version_dimension`)."""
    return _versioned_dimension(silver, existing, "customer_id", "customer_key", CUSTOMER, as_of, run_ts)


def build_dim_seller(silver: DataFrame, existing: DataFrame, as_of: date, run_ts: datetime) -> DataFrame:
    """Current and newly closed seller versions, with `_change`."""
    return _versioned_dimension(silver, existing, "seller_id", "seller_key", SELLER, as_of, run_ts)


def size_category(volume: Column) -> Column:
    return (
        F.when(volume.isNull(), "Unknown")
        .when(volume < 500, "Small")
        .when(volume < 5000, "Medium")
        .otherwise("Large")
    )


def build_dim_product(
    silver: DataFrame, existing: DataFrame, run_ts: datetime, highest: int | None = None
) -> DataFrame:
    """Products without history; a product keeps its key when its row is replaced."""
    incoming = silver.select(
        "product_id", "product_category_name", "product_category_english", "product_name_length",
        "product_description_length", "product_photos_qty", "product_weight_g", "product_volume_cm3",
        size_category(F.col("product_volume_cm3")).alias("size_category"),
    )
    merged = overwrite_dimension(existing, incoming, "product_id", run_ts)
    return number_new_rows(merged, "product_key", ["product_id"], existing, highest)


def build_dim_date(bounds: DataFrame) -> DataFrame:
    """One row per day from `first_day` to `last_day` of a one-row frame."""
    d = F.col("full_date")
    weekday = F.dayofweek(d) - 1  # Sunday is 0
    return bounds.select(F.explode(F.sequence("first_day", "last_day")).alias("full_date")).select(
        date_key(d).alias("date_key"),
        d,
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.weekofyear(d).alias("week_of_year"),
        F.dayofmonth(d).alias("day_of_month"),
        weekday.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        weekday.isin(0, 6).alias("is_weekend"),
        (F.last_day(d) == d).alias("is_month_end"),
    )


def date_bounds(spark: SparkSession, first: date = FIRST_DAY, last: date = LAST_DAY) -> DataFrame:
    return spark.sql("SELECT CAST(:first AS DATE) AS first_day, CAST(:last AS DATE) AS last_day",
                     args={"first": first.isoformat(), "last": last.isoformat()})
