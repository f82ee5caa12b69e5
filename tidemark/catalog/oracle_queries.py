"""The same results in SQL, written independently of the Spark plans.

Rounding is done in whole numbers (cents), half away from zero, because the checking database divides
decimals as doubles.
"""

from __future__ import annotations

TS = "TIMESTAMP '2024-06-01 12:00:00'"
DAY = "DATE '2024-06-01'"
OLD = "TIMESTAMP '2020-01-01 00:00:00'"
BATCH = "DAILY_20240601_120000_0A1B2C3D"
GROWTH_STATE = "NATION_3"

STATUS = "CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' WHEN 'P' THEN 'processing' ELSE 'unknown' END"
PAYMENT = (
    "CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'credit_card' WHEN '2' THEN 'debit_card' "
    "WHEN '3' THEN 'boleto' WHEN '4' THEN 'voucher' ELSE 'other' END"
)


def capital(c: str) -> str:
    return f"upper({c}[1]) || lower({c}[2:])"


def half_up(top: str, bottom: str, scale: int, width: int = 38) -> str:
    """top / bottom rounded half away from zero, both whole numbers."""
    power = 10**scale
    t, b = f"CAST({top} AS HUGEINT)", f"CAST(nullif({bottom}, 0) AS HUGEINT)"
    digits = f"(sign({t}) * sign({b}) * ((2 * abs({t}) * {power} + abs({b})) // (2 * abs({b}))))"
    unit = f"CAST(0.{'1'.zfill(scale)} AS DECIMAL({scale + 1},{scale}))"
    return f"CAST(CAST({digits} AS DECIMAL(30,0)) * {unit} AS DECIMAL({width},{scale}))"


def cents(c: str) -> str:
    return f"CAST({c} * 100 AS HUGEINT)"


PLACES = "places AS (SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey)"
SHIPPED = "shipped AS (SELECT l_orderkey, max(l_shipdate) AS last_shipped FROM lineitem GROUP BY l_orderkey)"
ORDERS = f"""{SHIPPED},
order_rows AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id, {STATUS} AS order_status,
         o_orderdate AS order_purchase_timestamp,
         CASE WHEN o_orderstatus = 'F' THEN last_shipped END AS order_delivered_at,
         CAST(o_orderdate AS DATE) + 45 AS order_estimated_delivery
  FROM orders LEFT JOIN shipped ON o_orderkey = l_orderkey),
s_orders AS (
  SELECT *,
         CAST(floor(date_diff('microsecond', order_purchase_timestamp, order_delivered_at) / 86400000000.0) AS INTEGER) AS delivery_days,
         coalesce(CAST(order_delivered_at AS DATE) > order_estimated_delivery, false) AS is_late_delivery
  FROM order_rows)"""
ITEMS = """s_items AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS order_item_id, CAST(l_partkey AS VARCHAR) AS product_id,
         CAST(l_suppkey AS VARCHAR) AS seller_id, price, freight_value, CAST(price + freight_value AS DECIMAL(12,2)) AS total_item_value
  FROM (SELECT *, CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
               CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(12,2)) AS freight_value
        FROM lineitem))"""
PAID = f"""paid AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DECIMAL(22,2)) AS payment_value,
         min({PAYMENT}) AS payment_type, min(CAST(substr(o_orderpriority, 1, 1) AS INTEGER)) AS payment_installments
  FROM orders GROUP BY 1)"""
CUSTOMERS = f"""{PLACES},
customers AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_custkey + 1 AS customer_key, c_name AS city, c_mktsegment, c_acctbal,
         n_name AS state, r_name AS region
  FROM customer LEFT JOIN places ON c_nationkey = n_nationkey)"""
PRODUCTS = f"""products AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_partkey + 1 AS product_key, lower(p_type) AS product_category_name,
         {capital('p_type')} AS product_category_english, CAST(length(p_name) AS INTEGER) AS product_name_length,
         CAST(length(p_brand) AS INTEGER) AS product_description_length, 1 AS product_photos_qty,
         CAST(p_retailprice AS DECIMAL(10,2)) AS product_weight_g,
         CASE WHEN p_type <> 'LARGE' THEN CAST(p_size * p_size * p_size AS DECIMAL(12,2)) END AS product_volume_cm3
  FROM part)"""
FACT = f"""{ORDERS}, {ITEMS}, {PAID}, {CUSTOMERS}, {PRODUCTS},
fact AS (
  SELECT i.order_id, i.order_item_id, c.customer_key, p.product_key, s_suppkey + 1 AS seller_key,
         CAST(strftime(o.order_purchase_timestamp, '%Y%m%d') AS INTEGER) AS order_date_key,
         CAST(strftime(o.order_delivered_at, '%Y%m%d') AS INTEGER) AS delivery_date_key,
         i.price, i.freight_value, i.total_item_value, q.payment_value, q.payment_type, q.payment_installments,
         o.delivery_days, o.is_late_delivery, o.order_status, 'FULL_RUN' AS batch_id
  FROM s_items i
  LEFT JOIN s_orders o ON i.order_id = o.order_id
  LEFT JOIN paid q ON i.order_id = q.order_id
  LEFT JOIN customers c ON o.customer_id = c.customer_id
  LEFT JOIN products p ON i.product_id = p.product_id
  LEFT JOIN supplier ON i.seller_id = CAST(s_suppkey AS VARCHAR))"""
DAYS = """days AS (
  SELECT CAST(d AS DATE) AS full_date FROM (
    SELECT unnest(generate_series(CAST(min(x) AS TIMESTAMP), CAST(max(x) AS TIMESTAMP), INTERVAL 1 DAY)) AS d
    FROM (SELECT o_orderdate AS x FROM orders UNION ALL SELECT l_shipdate FROM lineitem))),
dates AS (
  SELECT CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_key, full_date, CAST(year(full_date) AS INTEGER) AS year,
         CAST(quarter(full_date) AS INTEGER) AS quarter, CAST(month(full_date) AS INTEGER) AS month, monthname(full_date) AS month_name,
         CAST(weekofyear(full_date) AS INTEGER) AS week_of_year, CAST(day(full_date) AS INTEGER) AS day_of_month,
         CAST(dayofweek(full_date) AS INTEGER) AS day_of_week, dayname(full_date) AS day_name,
         dayofweek(full_date) IN (0, 6) AS is_weekend, last_day(full_date) = full_date AS is_month_end
  FROM days)"""
MONTHS = f"""{FACT}, {DAYS},
months AS (
  SELECT d.year, d.month, d.month_name, coalesce(c.state, 'Unknown') AS state, coalesce(c.region, 'Unknown') AS region,
         coalesce(p.product_category_english, 'Unknown') AS product_category,
         count(DISTINCT f.order_id) AS total_orders,
         CAST(sum(f.total_item_value) AS DECIMAL(22,2)) AS total_revenue,
         CAST(sum(f.freight_value) AS DECIMAL(22,2)) AS total_freight,
         {half_up(cents('sum(f.total_item_value)'), '100 * count(f.total_item_value)', 2, 12)} AS avg_order_value,
         count(*) AS total_items_sold
  FROM fact f JOIN dates d ON f.order_date_key = d.date_key
  LEFT JOIN customers c ON f.customer_key = c.customer_key
  LEFT JOIN products p ON f.product_key = p.product_key
  GROUP BY 1, 2, 3, 4, 5, 6)"""
RANK = "CAST(dense_rank() OVER (PARTITION BY year, month ORDER BY total_revenue DESC) AS INTEGER)"
RUNNING = (
    "CAST(sum(total_revenue) OVER (PARTITION BY state, region ORDER BY year, month, product_category "
    "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DECIMAL(32,2))"
)
PREVIOUS = "lag(total_revenue) OVER (PARTITION BY state, region, product_category ORDER BY year, month)"
GROWTH = half_up(f"({cents('total_revenue')} - {cents('prev_month_revenue')}) * 100", cents("prev_month_revenue"), 2, 22)
MART = f"""{MONTHS},
ranked AS (SELECT *, {RANK} AS revenue_rank_in_month, {RUNNING} AS cumulative_revenue, {PREVIOUS} AS prev_month_revenue FROM months),
mart AS (SELECT *, {GROWTH} AS mom_growth_pct, {TS} AS computed_at FROM ranked)"""

LINES = """lines AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
         nullif(l_returnflag, 'N') AS l_returnflag,
         CASE WHEN l_linestatus = 'F' AND l_returnflag = 'A' THEN ' ' || chr(9) ELSE l_linestatus END AS l_linestatus, l_shipdate
  FROM lineitem),
marked AS (
  SELECT *, l_returnflag IS NULL AS no_flag, l_linestatus = ' ' || chr(9) AS no_status,
         row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate NULLS FIRST, l_partkey, l_suppkey,
           l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag NULLS FIRST, l_linestatus) > 1 AS again
  FROM lines)"""
EVENTS = """ev AS (
  SELECT CAST(user_id AS VARCHAR) AS user_id, event_type, CASE WHEN event_type = 'error' THEN '1.0d' ELSE CAST(value AS VARCHAR) END AS value, value AS number,
         props
  FROM events)"""


def check(
    source: str, failed: str, name: str, kind: str, column: str, observed: str, expected: str,
    severity: str = "ERROR", table: str = "bronze.lineitem",
) -> str:
    """One result row; `failed` is an aggregate, `{}` in `observed` the number shown."""
    before, after = observed.split("{}")
    shown = "count(*)" if kind == "count_check" else failed
    share = half_up(f"(count(*) - ({failed})) * 100", "greatest(count(*), 1)", 3, 6)
    return f"""SELECT '{BATCH}' AS batch_id, '{table}' AS table_name, '{name}' AS check_name, '{kind}' AS check_type,
      '{column}' AS column_name, ({failed}) = 0 AS passed, count(*) AS total_records, CAST(({failed}) AS BIGINT) AS failed_records,
      {share} AS success_pct, '{before}' || CAST({shown} AS VARCHAR) || '{after}' AS observed_value,
      '{expected}' AS expected_value, '{severity}' AS severity, {TS} AS checked_at FROM {source}"""


def null_check(column: str, failing: str, severity: str = "ERROR") -> str:
    return check("marked", f"count(*) FILTER (WHERE {failing})", f"null_check_{column}", "null_check", column, "{} nulls", "0 nulls", severity)


def on_events(failing: str, name: str, kind: str, column: str, observed: str, expected: str, severity: str = "WARNING") -> str:
    return check("ev", f"count(*) FILTER (WHERE {failing})", name, kind, column, observed, expected, severity, "bronze.events")


def numeric(column: str, failing: str) -> str:
    return on_events(failing, f"type_check_{column}", "type_check", column, "{} non-numeric values", "all numeric")


def length(column: str, limit: int) -> str:
    return on_events(
        f"length({column}) > {limit}", f"length_check_{column}", "limit_check", column, "{} too long", f"at most {limit} characters"
    )


def rows_at_least(n: int, severity: str, source: str, table: str) -> str:
    return check(source, f"CASE WHEN count(*) < {n} THEN 1 ELSE 0 END", "min_row_count", "count_check", "*", "{}", f">= {n}", severity, table)


def union(*parts: str) -> str:
    return " UNION ALL ".join(parts)


REPEATS = check(
    "marked", "count(*) FILTER (WHERE again)", "unique_check_l_orderkey, l_linenumber", "pk_check",
    "l_orderkey, l_linenumber", "{} duplicates", "0 duplicates",
)
NO_FLAG, NO_STATUS = null_check("l_returnflag", "no_flag"), null_check("l_linestatus", "no_status")
ALL_RULES = [
    NO_FLAG, NO_STATUS, REPEATS, null_check("l_shipdate", "l_shipdate IS NULL", "WARNING"),
    check(
        "marked", "count(*) FILTER (WHERE l_linestatus NOT IN ('F', 'O'))", "domain_check_l_linestatus", "domain_check",
        "l_linestatus", "{} out-of-domain values", "values in [''F'', ''O'']", "WARNING",
    ),
    rows_at_least(1, "ERROR", "marked", "bronze.lineitem"),
]
VALUE_NUMBER = numeric("value", "event_type = 'error'")
USER_NUMBER = numeric("user_id", "false")
LINE_COLUMNS = (
    "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"
)

KNOWN = f"""{CUSTOMERS},
known AS (
  SELECT customer_key, customer_id, customer_id AS customer_unique_id, customer_id AS zip_code_prefix, city,
         CASE WHEN c_mktsegment = 'BUILDING' THEN CASE WHEN state <> 'NATION_0' THEN 'NATION_0' END ELSE state END AS state,
         state AS state_name, region, CASE WHEN c_acctbal < 0 THEN 3 ELSE 1 END AS version_number
  FROM customers WHERE c_mktsegment <> 'MACHINERY'),
batch AS (
  SELECT customer_id, customer_id AS customer_unique_id, customer_id AS zip_code_prefix, city, state, state AS state_name, region
  FROM customers WHERE c_mktsegment <> 'HOUSEHOLD'),
matched AS (
  SELECT k.*, b.state AS new_state, b.customer_id IS NOT NULL
           AND (k.state IS DISTINCT FROM b.state OR k.city IS DISTINCT FROM b.city) AS moved
  FROM known k LEFT JOIN batch b ON k.customer_id = b.customer_id),
versions AS (
  SELECT customer_key, customer_id, customer_unique_id, zip_code_prefix, city, state, state_name, region,
         DATE '2020-01-01' AS effective_start_date, CASE WHEN moved THEN {DAY} END AS effective_end_date, NOT moved AS is_current,
         version_number, {OLD} AS created_at, CASE WHEN moved THEN {TS} ELSE {OLD} END AS updated_at,
         CASE WHEN moved THEN 'closed' ELSE 'kept' END AS change
  FROM matched
  UNION ALL
  SELECT NULL, b.customer_id, b.customer_unique_id, b.zip_code_prefix, b.city, b.state, b.state_name, b.region,
         {DAY}, NULL, true, coalesce(k.version_number, 0) + 1, {TS}, {TS},
         CASE WHEN k.customer_id IS NULL THEN 'new' ELSE 'changed' END
  FROM batch b LEFT JOIN matched k ON b.customer_id = k.customer_id
  WHERE k.customer_id IS NULL OR k.moved)"""

BATCHES = """batches AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, 'B' || strftime(o_orderdate, '%Y%m') AS batch_id,
         o_orderdate AS load_timestamp, o_orderstatus = 'P' AS is_rejected FROM orders)"""

RUNS = """runs AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS batch_id, 'silver_' || lower(l_returnflag) AS pipeline_name,
         CASE WHEN l_linestatus = 'O' THEN 'RUNNING' ELSE 'SUCCESS' END AS status,
         l_shipdate - INTERVAL 1 DAY AS start_time,
         CASE WHEN l_linestatus = 'F' THEN l_shipdate END AS end_time,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS duration_seconds, l_partkey AS records_inserted, l_suppkey AS records_updated,
         CAST(l_linenumber AS BIGINT) AS records_rejected, l_shipdate AS recorded_at
  FROM lineitem),
states AS (
  SELECT * EXCLUDE (n) FROM (
    SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY recorded_at DESC, end_time DESC NULLS LAST, pipeline_name DESC,
      status DESC, start_time DESC, duration_seconds DESC, records_inserted DESC, records_updated DESC, records_rejected DESC) AS n
    FROM runs) WHERE n = 1)"""


def title(c: str) -> str:
    return (
        f"array_to_string(list_transform(regexp_extract_all(lower({c}), '[a-z]+|[^a-z]+'), "
        "lambda w: upper(w[1]) || w[2:]), '')"
    )


VERSIONED = f"{DAY} AS effective_start_date, CAST(NULL AS DATE) AS effective_end_date, true AS is_current, 1 AS version_number"
MONTH_COLUMNS = "year, month, state, region, product_category, total_revenue"
AVG_ORDER = half_up(f"{cents('sum(v)')}", "100 * count(v)", 4, 28)
LATE_RATE = half_up("100 * count(*) FILTER (WHERE is_late_delivery)", "count(is_late_delivery)", 2, 28)
TOP_STATES = f"""SELECT state, CAST(sum(total_item_value) AS DECIMAL(26,2)) AS revenue FROM fact JOIN customers USING (customer_key)
  WHERE state IS NOT NULL GROUP BY state ORDER BY revenue DESC, state LIMIT 10"""
TOP_KINDS = """SELECT product_category_english AS category, CAST(sum(total_item_value) AS DECIMAL(26,2)) AS revenue
  FROM fact JOIN products USING (product_key) GROUP BY 1 ORDER BY revenue DESC, category LIMIT 10"""
LATEST = f"""SELECT mom_growth_pct AS growth, state FROM mart WHERE state = '{GROWTH_STATE}'
  ORDER BY year DESC, month DESC, product_category LIMIT 1"""


def kpi(name: str, value: str, unit: str, dimension: str, label: str, source: str) -> str:
    return (
        f"SELECT '{name}' AS kpi_name, coalesce(CAST({value} AS DECIMAL(28,4)), 0) AS kpi_value, '{unit}' AS kpi_unit, "
        f"'{dimension}' AS dimension, {label} AS dimension_value, {DAY} AS as_of_date, {TS} AS computed_at FROM {source}"
    )


PER_ORDER = "(SELECT order_id, sum(total_item_value) AS v FROM fact GROUP BY order_id)"

ORACLE: dict[str, str] = {
    "dq_null_check": f"WITH {LINES} {union(NO_FLAG, NO_STATUS)}",
    "dq_unique_check": f"WITH {LINES} {REPEATS}",
    "dq_numeric_check": f"WITH {EVENTS} {union(VALUE_NUMBER, USER_NUMBER, numeric('event_type', 'true'))}",
    "dq_domain_check": f"WITH {EVENTS} "
    + on_events(
        "event_type NOT IN ('click', 'view')", "domain_check_event_type", "domain_check", "event_type",
        "{} out-of-domain values", "values in [''click'', ''view'', ''c'', ''d'', ''e'', ''f'', ''g'']",
    ),
    "dq_min_rows": f"WITH {EVENTS} "
    + union(rows_at_least(1, "ERROR", "ev", "bronze.events"), rows_at_least(1_000_000_000, "WARNING", "ev", "bronze.events")),
    "dq_limits": f"WITH {EVENTS} "
    + union(
        length("event_type", 5), length("props", 100), length("user_id", 2),
        on_events(
            "event_type = 'error' OR abs(CAST(number AS DECIMAL(18,2))) >= 10", "precision_check_value", "limit_check", "value",
            "{} out of range", "decimal(3,2)",
        ),
        on_events("false", "precision_check_user_id", "limit_check", "user_id", "{} out of range", "decimal(6,0)"),
    ),
    "dq_results": f"WITH {LINES} {union(*ALL_RULES)}",
    "dq_valid": f"WITH {LINES} SELECT {LINE_COLUMNS} FROM marked WHERE NOT (no_flag OR no_status OR again)",
    "dq_rejected": f"""WITH {LINES} SELECT {LINE_COLUMNS},
      CASE WHEN no_flag THEN 'NULL in l_returnflag; ' ELSE '' END || CASE WHEN no_status THEN 'NULL in l_linestatus; ' ELSE '' END
      || CASE WHEN again THEN 'Duplicate on l_orderkey, l_linenumber; ' ELSE '' END AS reject_reason
      FROM marked WHERE no_flag OR no_status OR again""",
    "reject_records": f"""WITH raw AS (
      SELECT ' ' || c_custkey AS customer_id, CAST(c_custkey AS VARCHAR) AS customer_unique_id, CAST(c_custkey AS VARCHAR) AS zip_code_prefix,
        chr(9) || lower(c_name) || ' d''' || upper(c_mktsegment) || '  ' AS city,
        CASE WHEN c_mktsegment = 'MACHINERY' THEN 'nowhere' ELSE lower(n_name) END AS state
      FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)
      SELECT 'customers' AS source_table, '{BATCH}' AS batch_id,
        CAST(to_json({{'customer_id': customer_id, 'customer_unique_id': customer_unique_id, 'zip_code_prefix': zip_code_prefix,
          'city': city, 'state': state, 'reject_reason': 'Duplicate on state; '}}) AS VARCHAR) AS raw_data,
        'Duplicate on state; ' AS reject_reason, {TS} AS rejected_at
      FROM (SELECT *, row_number() OVER (PARTITION BY state ORDER BY customer_id) AS n FROM raw) WHERE n > 1""",
    "dq_key_unique": "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY ALL HAVING count(*) > 1",
    "dq_one_current": "SELECT p_name, count(*) AS copies FROM part WHERE p_retailprice > 950 GROUP BY p_name HAVING count(*) > 1",
    "dq_fk_orphans": f"""WITH {FACT}, {DAYS}
      SELECT 'product_key' AS key_name, product_key AS key, count(*) AS rows FROM fact
        WHERE product_key IN (SELECT p_partkey + 1 FROM part WHERE p_type = 'PROMO') GROUP BY 2
      UNION ALL SELECT 'customer_key', customer_key, count(*) FROM fact
        WHERE customer_key IN (SELECT customer_key FROM customers WHERE region = 'ASIA') GROUP BY 2
      UNION ALL SELECT 'seller_key', seller_key, count(*) FROM fact
        WHERE seller_key IN (SELECT s_suppkey + 1 FROM supplier JOIN places ON s_nationkey = n_nationkey WHERE r_name = 'EUROPE') GROUP BY 2
      UNION ALL SELECT 'delivery_date_key', CAST(delivery_date_key AS BIGINT), count(*) FROM fact
        WHERE delivery_date_key >= 19990101 GROUP BY 2""",
    "dq_precision_rejects": """SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_linenumber AS VARCHAR) AS order_item_id,
        CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * 1000000 AS VARCHAR) AS price, 'Out of range: price; ' AS reject_reason
      FROM lineitem WHERE l_returnflag = 'A' AND CAST(l_extendedprice AS DECIMAL(12,2)) * 1000000 >= 10000000000""",
    "batch_replaced": """WITH p AS (SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_totalprice AS DECIMAL(12,2)) AS payment_value FROM orders),
      b AS (SELECT *, lpad(CAST(CAST(floor(payment_value) AS BIGINT) % 4 AS VARCHAR), 4, '0') AS batch_id FROM p)
      SELECT * FROM b WHERE batch_id <> '0002' AND (batch_id <> '0001' OR payment_value < 100000)""",
    "fact_batches": """WITH y AS (SELECT year(o_orderdate) AS y FROM orders GROUP BY 1)
      SELECT CAST(y AS VARCHAR) AS batch FROM y WHERE y >= (SELECT max(y) FROM y WHERE y % 2 = 0)""",
    "csv_roundtrip": """SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, CAST(length(text) AS INTEGER) AS n_chars, sha256(text) AS text_sha256
      FROM documents""",
    "json_props": """SELECT event_id, event_type, array_to_string(list_transform(list_sort(json_keys(props)),
        lambda k: k || '=' || (json_extract_string(props, '$."' || k || '"'))), ';') AS props FROM events""",
    "xml_parts": """SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_type FROM part WHERE p_type <> 'PROMO'""",
    "json_bad_records": f"""SELECT CASE WHEN n <> '3' THEN order_id END AS order_id,
        CASE WHEN n = '3' THEN 'Unparseable record; NULL in order_id; ' END AS reject_reason,
        CASE WHEN n = '3' THEN '{{"order_id":"' || order_id || '","payment_sequential":"1","payment_type":"BOLETO ","payment_installments":"3","payment_value" "' || v || '"}}' END AS raw
      FROM (SELECT CAST(o_orderkey AS VARCHAR) AS order_id, substr(o_orderpriority, 1, 1) AS n, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS v FROM orders)""",
    "schema_changes": f"""WITH n AS (SELECT count(*) FILTER (event_type = 'view') AS views, count(*) FILTER (event_type = 'error') AS errors,
        count(*) FILTER (event_type = 'click') AS clicks FROM events), c AS (
        SELECT 'ADD_COLUMN' AS change_type, 'props.k' AS column_name, 0 AS day FROM n WHERE views > 0
        UNION ALL SELECT 'ADD_COLUMN', 'props.cause.level', 1 FROM n WHERE errors > 0
        UNION ALL SELECT 'DROP_COLUMN', 'props.cause.level', 2 FROM n WHERE errors > 0 AND clicks > 0
        UNION ALL SELECT 'DROP_COLUMN', 'event_type', 2 FROM n WHERE clicks > 0)
      SELECT 'bronze.events' AS table_name, change_type, column_name, CASE change_type WHEN 'DROP_COLUMN' THEN 'string' END AS old_definition,
        CASE change_type WHEN 'ADD_COLUMN' THEN 'string' END AS new_definition, {TS} + to_days(day) AS detected_at, 'B' || day AS batch_id FROM c""",
    "json_records": "SELECT o_orderkey AS id, o_orderstatus AS status FROM orders",
    "json_null_texts": "SELECT p_partkey, CASE WHEN p_type NOT IN ('PROMO', 'SMALL') THEN p_type END AS p_type FROM part",
    "bronze_load": f"""SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber || '.0' AS order_item_id, ' ' || l_partkey AS product_id,
        CAST(l_suppkey AS VARCHAR) AS seller_id, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS shipping_limit_date,
        CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) AS price,
        CAST(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(12,2)) AS VARCHAR) AS freight_value,
        'CSV' AS source_system, '{BATCH}' AS batch_id, {TS} AS load_timestamp, false AS is_rejected FROM lineitem WHERE l_returnflag <> 'R'""",
    "bronze_rejects_csv": """SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber || '.0' AS order_item_id, ' ' || l_partkey AS product_id,
        CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) || 'd' AS price, 'NULL in seller_id; ' AS reject_reason FROM lineitem WHERE l_returnflag = 'R'""",
    "run_record": f"""SELECT '{BATCH}' AS batch_id, 'bronze.order_items' AS pipeline_name, 'PARTIAL' AS status, count(*) AS total_records_read,
        count(*) FILTER (l_returnflag <> 'R') AS records_inserted, count(*) FILTER (l_returnflag = 'R') AS records_rejected,
        strftime(max(l_shipdate) FILTER (l_returnflag <> 'R'), '%Y-%m-%d %H:%M:%S') AS last_loaded_value, 0::BIGINT AS errors FROM lineitem""",
    "csv_export": """SELECT CAST(p_partkey + 1 AS VARCHAR) AS product_key, CAST(p_partkey AS VARCHAR) AS product_id, lower(p_type) AS product_category_name,
        CASE WHEN p_type <> 'LARGE' THEN CAST(CAST(p_size * p_size * p_size AS DECIMAL(12,2)) AS VARCHAR) END AS product_volume_cm3 FROM part""",
    "table_reloaded": """SELECT n_name AS state_code, n_name AS state_name, r_name AS region FROM nation JOIN region ON n_regionkey = r_regionkey
      WHERE r_name <> 'ASIA'""",
    "upsert_last_in_file": """SELECT CAST(o_custkey AS VARCHAR) AS order_id, arg_max(o_orderstatus, o_orderkey) AS order_status
      FROM orders GROUP BY o_custkey""",
    "bronze_order_items": f"""SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber || '.0' AS order_item_id, ' ' || l_partkey AS product_id,
        CAST(NULL AS VARCHAR) AS seller_id, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS shipping_limit_date,
        CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) || CASE WHEN l_returnflag = 'R' THEN 'd' ELSE '' END AS price,
        CAST(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(12,2)) AS VARCHAR) AS freight_value,
        'order_items.csv' AS source_file, 'CSV' AS source_system, '{BATCH}' AS batch_id, {TS} AS load_timestamp, {DAY} AS load_date,
        false AS is_rejected, CAST(NULL AS VARCHAR) AS reject_reason, CAST(NULL AS BIGINT) AS source_block,
        CAST(NULL AS BIGINT) AS source_row FROM lineitem""",
    "batch_latest": f"""WITH {BATCHES} SELECT * FROM batches
      WHERE batch_id = (SELECT batch_id FROM batches ORDER BY load_timestamp DESC, batch_id DESC LIMIT 1)""",
    "batch_slice": f"WITH {BATCHES} SELECT * FROM batches WHERE batch_id = 'B199707' AND NOT is_rejected",
    "incremental_filter": f"""WITH {ORDERS}
      SELECT order_id, customer_id, ' ' || upper(order_status) AS order_status,
        strftime(order_purchase_timestamp, '%Y-%m-%d %H:%M:%S') AS order_purchase_timestamp, '2024-02-30 00:00:00' AS order_approved_at,
        strftime(order_delivered_at, '%Y-%m-%d %H:%M:%S') AS order_delivered_at,
        strftime(order_estimated_delivery, '%Y-%m-%d') AS order_estimated_delivery
      FROM s_orders WHERE order_delivered_at > TIMESTAMP '1998-03-15 12:00:00'""",
    "table_topk": """SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, l_extendedprice FROM lineitem
      WHERE l_shipdate > TIMESTAMP '1998-01-01 00:00:00' AND l_returnflag = 'A' AND l_quantity > 10
      ORDER BY 1, 2, 3, 4, 5 LIMIT 100""",
    "table_filtered": """SELECT event_id, ts, value FROM events
      WHERE event_type = 'click' AND ts > TIMESTAMP '2024-01-05 00:00:00'""",
    "parameter_query": "SELECT o_orderpriority, count(*) AS orders FROM orders WHERE o_orderstatus = 'F' GROUP BY 1",
    "silver_customers": f"""WITH {PLACES} SELECT CAST(c_custkey AS VARCHAR) AS customer_id, CAST(c_custkey AS VARCHAR) AS customer_unique_id,
        lpad(CAST(c_custkey AS VARCHAR), greatest(5, CAST(length(CAST(c_custkey AS VARCHAR)) AS INTEGER)), '0') AS zip_code_prefix,
        {title("c_name || ' d''' || c_mktsegment")} AS city,
        CASE WHEN c_mktsegment <> 'MACHINERY' THEN n_name END AS state, CASE WHEN c_mktsegment <> 'MACHINERY' THEN n_name END AS state_name,
        CASE WHEN c_mktsegment <> 'MACHINERY' THEN r_name END AS region, {VERSIONED}, '{BATCH}' AS batch_id, 'CSV' AS source_system
      FROM customer LEFT JOIN places ON c_nationkey = n_nationkey""",
    "silver_sellers": f"""WITH {PLACES} SELECT CAST(s_suppkey AS VARCHAR) AS seller_id,
        lpad(CAST(s_suppkey AS VARCHAR), greatest(5, CAST(length(CAST(s_suppkey AS VARCHAR)) AS INTEGER)), '0') AS zip_code_prefix,
        {title('s_name')} AS city, n_name AS state, n_name AS state_name, r_name AS region, {VERSIONED},
        '{BATCH}' AS batch_id, 'CSV' AS source_system FROM supplier LEFT JOIN places ON s_nationkey = n_nationkey""",
    "silver_products": f"""SELECT CAST(p_partkey AS VARCHAR) AS product_id, lower(p_type) AS product_category_name,
        CASE WHEN p_type = 'ECONOMY' THEN 'Others' ELSE {capital('p_type')} END AS product_category_english,
        CAST(length(p_name) AS INTEGER) AS product_name_length, CAST(length(p_brand) AS INTEGER) AS product_description_length,
        CASE WHEN p_type <> 'PROMO' THEN 1 END AS product_photos_qty, CAST(p_retailprice AS DECIMAL(10,2)) AS product_weight_g,
        CAST(p_size AS DECIMAL(10,2)) AS product_length_cm, CAST(p_size + 0.5 AS DECIMAL(10,2)) AS product_height_cm,
        CASE WHEN p_type <> 'SMALL' THEN CAST(p_size AS DECIMAL(10,2)) END AS product_width_cm,
        CASE WHEN p_type <> 'SMALL' THEN CAST(p_size * p_size * (p_size + 0.5) AS DECIMAL(12,2)) END AS product_volume_cm3,
        '{BATCH}' AS batch_id, 'XML' AS source_system FROM part""",
    "silver_orders": f"""WITH {ORDERS} SELECT order_id, customer_id, order_status, order_purchase_timestamp,
        CAST(NULL AS TIMESTAMP) AS order_approved_at, order_delivered_at, order_estimated_delivery, delivery_days, is_late_delivery,
        CASE order_status WHEN 'delivered' THEN 'completed' ELSE 'active' END AS order_status_category FROM s_orders""",
    "silver_order_items": f"""WITH {ITEMS}
      SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS order_item_id, CAST(l_partkey AS VARCHAR) AS product_id,
        CAST(l_suppkey AS VARCHAR) AS seller_id, l_shipdate AS shipping_limit_date, price, freight_value,
        CAST(price + freight_value AS DECIMAL(12,2)) AS total_item_value, '{BATCH}' AS batch_id, 'CSV' AS source_system
      FROM (SELECT *, CASE WHEN l_returnflag <> 'R' THEN CAST(l_extendedprice AS DECIMAL(12,2)) END AS price,
              CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(12,2)) AS freight_value FROM lineitem)""",
    "silver_payments": f"""SELECT CAST(o_orderkey AS VARCHAR) AS order_id, 1 AS payment_sequential, {PAYMENT} AS payment_type,
        CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS payment_installments, CAST(o_totalprice AS DECIMAL(12,2)) AS payment_value,
        CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'card' WHEN '2' THEN 'card' WHEN '3' THEN 'boleto' WHEN '4' THEN 'voucher'
          ELSE 'other' END AS payment_type_category, '{BATCH}' AS batch_id, 'JSON' AS source_system FROM orders""",
    "scd2_customers": f"WITH {KNOWN} SELECT * EXCLUDE (customer_key) FROM versions",
    "scd2_counts": f"""WITH {KNOWN} SELECT count(*) FILTER (WHERE change = 'new') AS inserted,
        count(*) FILTER (WHERE change = 'changed') AS updated FROM versions""",
    "scd2_history": f"""WITH {KNOWN} SELECT customer_id, city, state, effective_start_date, effective_end_date, is_current, version_number
        FROM versions ORDER BY customer_id, version_number""",
    "scd1_products": f"""WITH sold AS (
        SELECT l_partkey, CAST(l_extendedprice AS DECIMAL(12,2)) AS price, l_shipdate,
          row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC, CAST(l_extendedprice AS DECIMAL(12,2)) DESC) AS n FROM lineitem),
      known AS (SELECT * FROM part WHERE p_name <> 'small ring')
      SELECT coalesce(p_partkey, l_partkey) AS product_id, p_name AS product_name,
        coalesce(price, CAST(p_retailprice AS DECIMAL(12,2))) AS price, l_shipdate AS sold_at,
        CASE WHEN l_partkey IS NOT NULL THEN {TS} END AS updated_at
      FROM known FULL JOIN (SELECT * FROM sold WHERE n = 1) ON p_partkey = l_partkey""",
    "upsert_orders": f"""WITH {ORDERS} SELECT order_id, customer_id, CASE order_status WHEN 'delivered' THEN 'created' ELSE order_status END AS order_status,
        order_purchase_timestamp, is_late_delivery, CASE order_status WHEN 'processing' THEN {TS} ELSE {OLD} END AS created_at,
        CASE order_status WHEN 'delivered' THEN {OLD} ELSE {TS} END AS updated_at FROM s_orders""",
    "upsert_buckets": f"""WITH {ORDERS}, dearest AS (SELECT CAST(o_orderkey AS VARCHAR) AS dear FROM orders ORDER BY o_totalprice DESC, o_orderkey DESC LIMIT 1)
      SELECT order_id, customer_id, CASE WHEN order_id = dear THEN 'disputed' WHEN order_status = 'delivered' THEN 'created' ELSE order_status END AS order_status,
        order_purchase_timestamp, is_late_delivery, CASE order_status WHEN 'processing' THEN {TS} ELSE {OLD} END AS created_at,
        CASE WHEN order_status = 'delivered' AND order_id <> dear THEN {OLD} ELSE {TS} END AS updated_at FROM s_orders, dearest""",
    "upsert_generic": """WITH known AS (
        SELECT o_custkey, o_orderpriority, max(CAST(o_totalprice AS DECIMAL(12,2))) AS value, count(*) AS orders, min(o_orderdate) AS first_seen
        FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2),
      batch AS (
        SELECT o_custkey, o_orderpriority, CAST(o_totalprice AS DECIMAL(12,2)) AS value, o_orderdate AS seen,
          row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderdate DESC, CAST(o_totalprice AS DECIMAL(12,2)) DESC) AS n
        FROM orders WHERE o_orderstatus <> 'F')
      SELECT coalesce(k.o_custkey, b.o_custkey) AS o_custkey, coalesce(k.o_orderpriority, b.o_orderpriority) AS o_orderpriority,
        coalesce(b.value, k.value) AS value, k.orders, CASE WHEN k.o_custkey IS NULL THEN b.seen ELSE k.first_seen END AS first_seen
      FROM known k FULL JOIN (SELECT * FROM batch WHERE n = 1) b ON k.o_custkey = b.o_custkey AND k.o_orderpriority = b.o_orderpriority""",
    "dim_date": f"WITH {DAYS} SELECT * FROM dates",
    "dim_customer": f"""WITH {KNOWN} SELECT * FROM versions WHERE customer_key IS NOT NULL UNION ALL
      SELECT * REPLACE ((SELECT max(customer_key) FROM known) + row_number() OVER (ORDER BY customer_id) AS customer_key)
      FROM versions WHERE customer_key IS NULL""",
    "dim_seller": f"""WITH {PLACES} SELECT row_number() OVER (ORDER BY CAST(s_suppkey AS VARCHAR)) AS seller_key, CAST(s_suppkey AS VARCHAR) AS seller_id,
        CAST(s_suppkey AS VARCHAR) AS zip_code_prefix, s_name AS city, n_name AS state, n_name AS state_name, r_name AS region, {VERSIONED},
        {TS} AS created_at, {TS} AS updated_at, 'new' AS change FROM supplier LEFT JOIN places ON s_nationkey = n_nationkey""",
    "dim_product": f"""WITH {PRODUCTS}, ranked AS (
        SELECT *, row_number() OVER (PARTITION BY product_category_name = 'small' ORDER BY product_id) AS n FROM products)
      SELECT CASE WHEN product_category_name = 'small' THEN product_key
          ELSE (SELECT max(product_key) FROM products WHERE product_category_name = 'small') + n END AS product_key,
        product_id, product_category_name, product_category_english, product_name_length, product_description_length, product_photos_qty,
        product_weight_g, product_volume_cm3, CASE WHEN product_volume_cm3 IS NULL THEN 'Unknown' WHEN product_volume_cm3 < 500 THEN 'Small'
          WHEN product_volume_cm3 < 5000 THEN 'Medium' ELSE 'Large' END AS size_category,
        CASE WHEN product_category_name = 'small' THEN {OLD} ELSE {TS} END AS created_at, {TS} AS updated_at FROM ranked""",
    "payments_per_order": """WITH pay AS (
        SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS seq, CASE WHEN l_returnflag <> 'R' THEN l_returnflag END AS kind,
          CAST(l_quantity AS INTEGER) AS parts, CAST(l_extendedprice AS DECIMAL(12,2)) AS value FROM lineitem)
      SELECT order_id, CAST(sum(value) AS DECIMAL(22,2)) AS payment_value,
        first(kind ORDER BY seq, kind, parts, value) FILTER (WHERE kind IS NOT NULL) AS payment_type,
        first(parts ORDER BY seq, kind NULLS FIRST, parts, value) AS payment_installments FROM pay GROUP BY order_id""",
    "fact_sales": f"WITH {FACT} SELECT * FROM fact",
    "revenue_by_month": f"WITH {MONTHS} SELECT * FROM months",
    "revenue_mart": f"WITH {MART} SELECT * FROM mart",
    "mart_increment": f"WITH {MART} SELECT * EXCLUDE (computed_at) FROM mart",
    "rank_in_month": f"WITH {MONTHS} SELECT {MONTH_COLUMNS}, {RANK} AS revenue_rank_in_month FROM months",
    "running_revenue": f"WITH {MONTHS} SELECT {MONTH_COLUMNS}, {RUNNING} AS cumulative_revenue FROM months",
    "prev_month": f"WITH {MONTHS} SELECT {MONTH_COLUMNS}, {PREVIOUS} AS prev_month_revenue FROM months",
    "mom_growth": f"WITH {MART} SELECT {MONTH_COLUMNS}, mom_growth_pct FROM mart",
    "kpi_total_revenue": f"WITH {FACT} SELECT CAST(sum(total_item_value) AS DECIMAL(28,4)) AS total_revenue FROM fact",
    "kpi_total_orders": f"WITH {FACT} SELECT CAST(count(DISTINCT order_id) AS DECIMAL(28,4)) AS total_orders FROM fact",
    "kpi_avg_order_value": f"WITH {FACT} SELECT {AVG_ORDER} AS avg_order_value FROM {PER_ORDER}",
    "kpi_late_delivery_rate_pct": f"WITH {FACT} SELECT CAST({LATE_RATE} AS DECIMAL(28,4)) AS late_delivery_rate_pct FROM fact",
    "kpi_total_customers": "SELECT CAST(count(*) AS DECIMAL(16,0)) AS total_customers FROM customer",
    "kpi_revenue_by_state": f"WITH {FACT} {TOP_STATES}",
    "kpi_revenue_by_category": f"WITH {FACT} {TOP_KINDS}",
    "kpi_latest_growth": f"WITH {MART} {LATEST}",
    "kpi_summary": f"WITH {MART} "
    + union(
        kpi("total_revenue", "sum(total_item_value)", "BRL", "overall", "'all'", "fact"),
        kpi("total_orders", "count(DISTINCT order_id)", "count", "overall", "'all'", "fact"),
        kpi("avg_order_value", AVG_ORDER, "BRL", "overall", "'all'", PER_ORDER),
        kpi("late_delivery_rate_pct", LATE_RATE, "%", "quality", "'all'", "fact"),
        kpi("total_customers", "count(*)", "count", "overall", "'all'", "customer"),
        kpi("revenue_by_state", "revenue", "BRL", "state", "state", f"({TOP_STATES})"),
        kpi("revenue_by_category", "revenue", "BRL", "category", "category", f"({TOP_KINDS})"),
        kpi("latest_mom_revenue_growth_pct", "growth", "%", "trend", "state", f"({LATEST})"),
    ),
    "report_cards": f"""WITH {FACT} SELECT CAST(sum(payment_value) AS DECIMAL(26,2)) AS total_revenue, count(DISTINCT order_id) AS total_orders,
        {half_up(cents('sum(payment_value)'), '100 * count(DISTINCT order_id)', 2, 26)} AS avg_order_value,
        CAST(sum(freight_value) AS DECIMAL(26,2)) AS total_freight FROM fact""",
    "daily_revenue": f"""WITH {FACT} SELECT CAST(strptime(CAST(order_date_key AS VARCHAR), '%Y%m%d') AS DATE) AS full_date,
        CAST(sum(payment_value) AS DECIMAL(26,2)) AS revenue FROM fact WHERE order_date_key IS NOT NULL GROUP BY 1 ORDER BY 1""",
    "top_categories": f"""WITH {FACT} SELECT product_category_name, CAST(sum(payment_value) AS DECIMAL(26,2)) AS revenue
        FROM fact JOIN products USING (product_key) GROUP BY 1 ORDER BY revenue DESC, 1 LIMIT 10""",
    "orders_by_state": f"""WITH {FACT} SELECT state, count(DISTINCT order_id) AS orders FROM fact JOIN customers USING (customer_key)
        WHERE state IS NOT NULL GROUP BY state""",
    "status_mix": f"WITH {FACT} SELECT order_status, count(DISTINCT order_id) AS orders FROM fact WHERE order_status IS NOT NULL GROUP BY 1",
    "revenue_by_region": f"WITH {MONTHS} SELECT region, CAST(sum(total_revenue) AS DECIMAL(32,2)) AS revenue FROM months GROUP BY 1",
    "state_growth": f"""WITH {MART} SELECT year, month, state, product_category, total_revenue, mom_growth_pct FROM mart
        WHERE state = '{GROWTH_STATE}'""",
    "row_counts": union(
        *[
            f"SELECT '{name}' AS table_name, count(*) AS rows FROM {name}"
            for name in ("customer", "events", "lineitem", "nation", "orders", "part", "region", "supplier")
        ]
    ),
    "dq_report": f"""WITH {LINES}, {EVENTS}, results AS ({union(*ALL_RULES, VALUE_NUMBER, USER_NUMBER, rows_at_least(1, 'ERROR', 'ev', 'bronze.events'))})
      SELECT table_name, count(*) FILTER (WHERE passed) AS passed, count(*) FILTER (WHERE NOT passed) AS failed FROM results GROUP BY 1""",
    "dq_listing": f"""WITH {EVENTS}, results AS ({union(VALUE_NUMBER, USER_NUMBER,
        on_events("props IS NULL OR trim(props) = ''", "null_check_props", "null_check", "props", "{} nulls", "0 nulls", "ERROR"))})
      SELECT table_name, check_name, passed, total_records, failed_records, success_pct, severity, checked_at FROM results""",
    "run_last_states": f"WITH {RUNS} SELECT * FROM states",
    "runs_recent": f"""WITH {RUNS} SELECT pipeline_name, status, records_inserted, records_updated, records_rejected,
        {half_up(cents('duration_seconds'), '100', 1, 11)} AS duration_seconds
      FROM states ORDER BY start_time DESC, batch_id LIMIT 20""",
    "watermark_latest": """SELECT o_orderpriority AS source_table,
        last(CAST(o_orderkey AS VARCHAR) ORDER BY o_orderdate, CAST(o_orderkey AS VARCHAR)) AS last_loaded_value,
        max(o_orderdate) AS last_updated FROM orders GROUP BY 1""",
}
