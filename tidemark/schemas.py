"""Table schemas by layer, as Spark DDL.

Sums and counts in gold are wider than a relational NUMERIC(14,2) or INT would be: at a few hundred
billion rows those overflow.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The business columns of the six sources; all of them are text in bronze.
SOURCE_COLUMNS = {
    "customers": ["customer_id", "customer_unique_id", "zip_code_prefix", "city", "state"],
    "orders": [
        "order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
        "order_delivered_at", "order_estimated_delivery",
    ],
    "products": [
        "product_id", "product_category_name", "product_name_length", "product_description_length",
        "product_photos_qty", "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm",
    ],
    "order_items": [
        "order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price", "freight_value",
    ],
    "sellers": ["seller_id", "zip_code_prefix", "city", "state"],
    "payments": ["order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"],
}

# The longest text each bronze column may hold.
TEXT_LIMITS = {
    "customers": {
        "customer_id": 100, "customer_unique_id": 100, "zip_code_prefix": 10, "city": 100, "state": 10,
    },
    "orders": {
        "order_id": 100, "customer_id": 100, "order_status": 50, "order_purchase_timestamp": 50,
        "order_approved_at": 50, "order_delivered_at": 50, "order_estimated_delivery": 50,
    },
    "products": {
        "product_id": 100, "product_category_name": 100, "product_name_length": 20,
        "product_description_length": 20, "product_photos_qty": 20, "product_weight_g": 20,
        "product_length_cm": 20, "product_height_cm": 20, "product_width_cm": 20,
    },
    "order_items": {
        "order_id": 100, "order_item_id": 20, "product_id": 100, "seller_id": 100,
        "shipping_limit_date": 50, "price": 30, "freight_value": 30,
    },
    "sellers": {"seller_id": 100, "zip_code_prefix": 10, "city": 100, "state": 10},
    "payments": {
        "order_id": 100, "payment_sequential": 10, "payment_type": 50, "payment_installments": 10,
        "payment_value": 30,
    },
}

# The decimals that numbers in the raw text must fit.
NUMBER_LIMITS = {
    "products": {
        "product_name_length": (10, 0), "product_description_length": (10, 0), "product_photos_qty": (10, 0),
        "product_weight_g": (10, 2), "product_length_cm": (10, 2), "product_height_cm": (10, 2),
        "product_width_cm": (10, 2),
    },
    "order_items": {"order_item_id": (10, 0), "price": (12, 2), "freight_value": (12, 2)},
    "payments": {"payment_sequential": (10, 0), "payment_installments": (10, 0), "payment_value": (12, 2)},
}

# source_block and source_row: where in its file a row stood, so that the last of several can be told.
AUDIT = (
    "source_file string, source_system string, batch_id string, load_timestamp timestamp_ntz, "
    "load_date date, is_rejected boolean, reject_reason string, source_block bigint, source_row bigint"
)
FILE_ORDER = ["source_file", "source_block", "source_row"]
VERSIONED = "effective_start_date date, effective_end_date date, is_current boolean, version_number int"
STAMPED = "created_at timestamp_ntz, updated_at timestamp_ntz"
ORIGIN = "batch_id string, source_system string"

TABLES = {
    "bronze.rejected_records": (
        "source_table string, batch_id string, raw_data string, reject_reason string, rejected_at timestamp_ntz"
    ),
    "silver.customers": (
        "customer_id string, customer_unique_id string, zip_code_prefix string, city string, state string, "
        f"state_name string, region string, {VERSIONED}, {ORIGIN}, {STAMPED}"
    ),
    "silver.orders": (
        "order_id string, customer_id string, order_status string, order_status_category string, "
        "order_purchase_timestamp timestamp_ntz, order_approved_at timestamp_ntz, "
        "order_delivered_at timestamp_ntz, order_estimated_delivery date, delivery_days int, "
        f"is_late_delivery boolean, {ORIGIN}, {STAMPED}"
    ),
    "silver.products": (
        "product_id string, product_category_name string, product_category_english string, "
        "product_name_length int, product_description_length int, product_photos_qty int, "
        "product_weight_g decimal(10,2), product_length_cm decimal(10,2), product_height_cm decimal(10,2), "
        f"product_width_cm decimal(10,2), product_volume_cm3 decimal(12,2), {ORIGIN}, {STAMPED}"
    ),
    "silver.order_items": (
        "order_id string, order_item_id int, product_id string, seller_id string, "
        "shipping_limit_date timestamp_ntz, price decimal(12,2), freight_value decimal(12,2), "
        f"total_item_value decimal(12,2), {ORIGIN}, {STAMPED}"
    ),
    "silver.sellers": (
        "seller_id string, zip_code_prefix string, city string, state string, state_name string, "
        f"region string, {VERSIONED}, {ORIGIN}, {STAMPED}"
    ),
    "silver.payments": (
        "order_id string, payment_sequential int, payment_type string, payment_type_category string, "
        f"payment_installments int, payment_value decimal(12,2), {ORIGIN}, {STAMPED}"
    ),
    "silver.state_lookup": "state_code string, state_name string, region string",
    "silver.category_lookup": "category_pt string, category_en string",
    "gold.dim_customer": (
        "customer_key bigint, customer_id string, customer_unique_id string, zip_code_prefix string, "
        f"city string, state string, state_name string, region string, {VERSIONED}, {STAMPED}"
    ),
    "gold.dim_product": (
        "product_key bigint, product_id string, product_category_name string, product_category_english string, "
        "product_name_length int, product_description_length int, product_photos_qty int, "
        f"product_weight_g decimal(10,2), product_volume_cm3 decimal(12,2), size_category string, {STAMPED}"
    ),
    "gold.dim_seller": (
        "seller_key bigint, seller_id string, zip_code_prefix string, city string, state string, "
        f"state_name string, region string, {VERSIONED}, {STAMPED}"
    ),
    "gold.dim_date": (
        "date_key int, full_date date, year int, quarter int, month int, month_name string, week_of_year int, "
        "day_of_month int, day_of_week int, day_name string, is_weekend boolean, is_month_end boolean"
    ),
    "gold.fact_sales": (
        "sales_key bigint, order_id string, order_item_id int, customer_key bigint, product_key bigint, "
        "seller_key bigint, order_date_key int, delivery_date_key int, price decimal(12,2), "
        "freight_value decimal(12,2), total_item_value decimal(12,2), payment_value decimal(22,2), "
        "payment_type string, payment_installments int, delivery_days int, is_late_delivery boolean, "
        "order_status string, batch_id string, created_at timestamp_ntz"
    ),
    "gold.revenue_mart": (
        "year int, month int, month_name string, state string, region string, product_category string, "
        "total_orders bigint, total_revenue decimal(22,2), total_freight decimal(22,2), "
        "avg_order_value decimal(12,2), total_items_sold bigint, revenue_rank_in_month int, "
        "cumulative_revenue decimal(32,2), prev_month_revenue decimal(22,2), mom_growth_pct decimal(22,2), "
        "computed_at timestamp_ntz"
    ),
    # What the mart carries from month to month: revenue so far, and the last revenue of a category.
    "gold.mart_state": (
        "year int, month int, state string, region string, product_category string, last_revenue decimal(22,2), "
        "running_revenue decimal(32,2)"
    ),
    "gold.kpi_summary": (
        "kpi_name string, kpi_value decimal(28,4), kpi_unit string, dimension string, dimension_value string, "
        "as_of_date date, computed_at timestamp_ntz"
    ),
    "metadata.pipeline_runs": (
        "batch_id string, pipeline_name string, layer string, source_system string, source_table string, "
        "target_table string, status string, start_time timestamp_ntz, end_time timestamp_ntz, "
        "duration_seconds decimal(10,2), total_records_read bigint, records_inserted bigint, "
        "records_updated bigint, records_rejected bigint, records_skipped bigint, error_message string, "
        "triggered_by string, run_mode string, recorded_at timestamp_ntz"
    ),
    "metadata.dq_results": (
        "batch_id string, table_name string, check_name string, check_type string, column_name string, "
        "passed boolean, total_records bigint, failed_records bigint, success_pct decimal(6,3), "
        "observed_value string, expected_value string, severity string, checked_at timestamp_ntz"
    ),
    "metadata.watermarks": "source_table string, last_loaded_value string, last_updated timestamp_ntz",
    "metadata.error_log": (
        "batch_id string, pipeline_name string, error_type string, error_message string, logged_at timestamp_ntz"
    ),
    "metadata.schema_changes": (
        "table_name string, change_type string, column_name string, old_definition string, "
        "new_definition string, detected_at timestamp_ntz, batch_id string"
    ),
}
TABLES.update(
    {
        f"bronze.{name}": ", ".join(f"{c} string" for c in columns) + ", " + AUDIT
        for name, columns in SOURCE_COLUMNS.items()
    }
)


def schema_of(table: str) -> T.StructType:
    """Schema of a `layer.table`."""
    return T.StructType.fromDDL(TABLES[table])


def text_schema(columns: list[str]) -> T.StructType:
    """All-text schema of a raw source."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])
