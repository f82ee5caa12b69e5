"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query's whole result is computed and thrown away by the no-op sink. A first, untimed query warms
the session up.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tidemark.catalog.spark_queries import QUERIES
from tidemark.session import local_session

HEADLINE = [
    "dq_results", "dq_valid", "dq_rejected", "dq_fk_orphans", "reject_records",
    "silver_customers", "silver_orders", "silver_products", "silver_order_items", "silver_payments",
    "scd1_products", "scd2_customers", "upsert_orders", "upsert_generic",
    "dim_customer", "dim_product", "payments_per_order", "fact_sales", "revenue_mart", "kpi_summary",
    "report_cards", "daily_revenue", "top_categories", "orders_by_state", "revenue_by_region",
    "batch_latest", "table_topk", "run_last_states",
]


def seconds(spark, folder: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session("bench", cpus=cpus, memory=os.environ.get("BENCH_MEMORY", "8g"))
    seconds(spark, folder, "status_mix")
    names = sys.argv[1:] or HEADLINE
    timings = {name: seconds(spark, folder, name) for name in names}
    print(
        json.dumps(
            {
                "metric": "total wall time of the headline queries",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
