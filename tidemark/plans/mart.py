"""The revenue mart: monthly revenue by state, region and category, with rank, running sum and growth."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.functions.moments import moment
from tidemark.functions.numbers import ratio

GRAIN = ["year", "month", "month_name", "state", "region", "product_category"]
CATEGORY = ["state", "region", "product_category"]


def revenue_by_month(
    fact: DataFrame, dim_date: DataFrame, dim_customer: DataFrame, dim_product: DataFrame
) -> DataFrame:
    """Orders, revenue, freight, average item value and items by month, state, region and category.

    The distinct count makes Spark group by the grain and the order first, so rows spread by order
    before the few final groups are formed, and each of those steps combines before its shuffle. Names are
    looked up as late as can be: sales on their way to customers and products carry the day's key only.
    """
    days = dim_date.select(F.col("date_key").alias("order_date_key"), "year", "month", "month_name")
    customers = dim_customer.select("customer_key", "state", "region")
    products = dim_product.select("product_key", F.col("product_category_english").alias("product_category"))
    sales = (
        fact.where(F.col("order_date_key").isNotNull())
        .select("order_id", "order_date_key", "customer_key", "product_key", "total_item_value", "freight_value")
        .join(products, "product_key", "left")
        .join(customers, "customer_key", "left")
        .join(days, "order_date_key")
        .select(
            "year", "month", "month_name",
            *[F.coalesce(c, F.lit("Unknown")).alias(c) for c in ("state", "region", "product_category")],
            "order_id", "total_item_value", "freight_value",
        )
    )
    return (
        sales.groupBy(*GRAIN)
        .agg(
            F.count_distinct("order_id").alias("total_orders"),
            F.sum("total_item_value").cast("decimal(22,2)").alias("total_revenue"),
            F.sum("freight_value").cast("decimal(22,2)").alias("total_freight"),
            F.count("total_item_value").cast("decimal(16,0)").alias("_valued"),
            F.count(F.lit(1)).alias("total_items_sold"),
        )
        .withColumn("avg_order_value", ratio(F.col("total_revenue"), F.col("_valued"), 2, 12))
        .select(
            *GRAIN, "total_orders", "total_revenue", "total_freight", "avg_order_value", "total_items_sold"
        )
    )


# The windows run over the grouped mart: a month holds at most states x categories rows and a state at
# most months x categories, both bounded by the lookups and not by the number of sales.


def rank_in_month(mart: DataFrame) -> DataFrame:
    """Dense rank of revenue in its month."""
    window = W.partitionBy("year", "month").orderBy(F.col("total_revenue").desc())
    return mart.withColumn("revenue_rank_in_month", F.dense_rank().over(window))


def running_revenue(mart: DataFrame, opening: DataFrame | None = None) -> DataFrame:
    """Running revenue of a state and region; categories of one month add up in the order of their names.

    It goes on from what the `opening` state has, if given (see `month_states`).
    """
    window = (
        W.partitionBy("state", "region")
        .orderBy("year", "month", "product_category")
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    running = F.sum("total_revenue").over(window)
    if opening is None:
        return mart.withColumn("cumulative_revenue", running.cast("decimal(32,2)"))
    before = opening.groupBy("state", "region").agg(F.max("running_revenue").alias("_before"))  # one value each
    total = F.coalesce(F.col("_before") + F.col("_running"), F.col("_running"), F.col("_before"))
    return (
        mart.withColumn("_running", running)
        .join(before, ["state", "region"], "left")
        .withColumn("cumulative_revenue", total.cast("decimal(32,2)"))
        .drop("_running", "_before")
    )


def previous_month(mart: DataFrame, opening: DataFrame | None = None) -> DataFrame:
    """Revenue of the month before that has any, for the same state, region and category; of the first month here,
    what the `opening` state has."""
    window = W.partitionBy(*CATEGORY).orderBy("year", "month")
    place, before = F.row_number().over(window), F.lag("total_revenue").over(window)
    if opening is None:
        return mart.withColumn("prev_month_revenue", before)
    last = opening.select(*CATEGORY, F.col("last_revenue").alias("_last"))
    return (
        mart.withColumns({"_place": place, "_before": before})
        .join(last, CATEGORY, "left")
        .withColumn("prev_month_revenue", F.when(F.col("_place") == 1, F.col("_last")).otherwise(F.col("_before")))
        .drop("_place", "_before", "_last")
    )


def month_growth(mart: DataFrame) -> DataFrame:
    """Growth over the previous month in percent; NULL after a month of no revenue."""
    now, before = F.col("total_revenue"), F.col("prev_month_revenue")
    return mart.withColumn("mom_growth_pct", ratio((now - before) * 100, before, 2, 22))


def with_metrics(months: DataFrame, run_ts: datetime, opening: DataFrame | None = None) -> DataFrame:
    """Rank, running revenue and growth of grouped months, all that follow the opening state."""
    mart = rank_in_month(months)
    mart = month_growth(previous_month(running_revenue(mart, opening), opening))
    return mart.withColumn("computed_at", moment(run_ts))


def build_revenue_mart(
    fact: DataFrame, dim_date: DataFrame, dim_customer: DataFrame, dim_product: DataFrame, run_ts: datetime
) -> DataFrame:
    return with_metrics(revenue_by_month(fact, dim_date, dim_customer, dim_product), run_ts)


def month_states(mart: DataFrame, months: list[int], opening: DataFrame | None = None) -> DataFrame:
    """At the end of each of these months (yyyymm), for every state, region and category seen so far: the last
    revenue, and the running revenue of the state and region.

    `mart` has exactly these months. The result has at most months x categories rows, as the mart.
    """
    key = F.col("year") * 100 + F.col("month")
    seen = mart.select(*CATEGORY)
    seen = (seen if opening is None else seen.unionByName(opening.select(*CATEGORY))).distinct()
    grid = seen.withColumn("_month", F.explode(F.array(*[F.lit(m) for m in months])))
    sold = mart.select(*CATEGORY, key.alias("_month"), F.lit(True).alias("_here"), "total_revenue")
    grid = grid.join(sold, [*CATEGORY, "_month"], "left")
    # The last month that is there counts, also one whose revenue is NULL.
    own = W.partitionBy(*CATEGORY).orderBy("_month")
    last = F.last(F.when(F.col("_here"), F.struct("total_revenue")), ignorenulls=True).over(own)
    # All categories of a month are peers here, so a range ends with the month.
    of_state = W.partitionBy("state", "region").orderBy("_month").rangeBetween(W.unboundedPreceding, W.currentRow)
    grid = grid.withColumns({"_last": last, "_running": F.sum("total_revenue").over(of_state)})
    if opening is None:
        grid = grid.withColumns({"_old": F.lit(None).cast("struct<last_revenue: decimal(22,2)>"), "_before": F.lit(None).cast("decimal(32,2)")})
    else:
        before = opening.groupBy("state", "region").agg(F.max("running_revenue").alias("_before"))
        old = opening.select(*CATEGORY, F.struct("last_revenue").alias("_old"))
        grid = grid.join(old, CATEGORY, "left").join(before, ["state", "region"], "left")
    total = F.coalesce(F.col("_before") + F.col("_running"), F.col("_running"), F.col("_before"))
    return grid.where(F.col("_last").isNotNull() | F.col("_old").isNotNull()).select(
        F.floor(F.col("_month") / 100).cast("int").alias("year"),
        (F.col("_month") % 100).cast("int").alias("month"),
        *CATEGORY,
        F.when(F.col("_last").isNotNull(), F.col("_last")["total_revenue"])
        .otherwise(F.col("_old")["last_revenue"])
        .cast("decimal(22,2)")
        .alias("last_revenue"),
        total.cast("decimal(32,2)").alias("running_revenue"),
    )
