"""DuckDB oracle SQL for every query in the catalog.

Only the driver tables are registered in DuckDB, so each statement starts
with the raw-layer adapter (FIXTURES §3) and the models as CTEs, then selects the
query's result with the same column names and types as the Spark side.
"""

from __future__ import annotations

from cartwright import fixed


def rounded_ratio(num: str, den: str, digits: int) -> str:
    """DuckDB's own ``round`` over DECIMAL; NULL when den is 0. The quotient is cut
    to 12 decimals, which no tie at ``digits`` decimals can cross."""
    cut = f"CAST(CAST({num} AS HUGEINT) * 1000000000000 // nullif(CAST({den} AS HUGEINT), 0) AS DECIMAL(26,0))"
    return f"CAST(round(CAST({cut} * CAST('0.000000000001' AS DECIMAL(12,12)) AS DECIMAL(38,12)), {digits}) AS DOUBLE)"


def _sk(*cols: str) -> str:
    parts = [f"coalesce(CAST({c} AS VARCHAR), '{fixed.SURROGATE_NULL_TOKEN}')" for c in cols]
    return f"md5(concat_ws('{fixed.SURROGATE_SEPARATOR}', {', '.join(parts)}))"


_AISLE_CASE = ("CAST(CASE p_type WHEN 'STANDARD' THEN 1 WHEN 'ECONOMY' THEN 2 WHEN 'MEDIUM' THEN 3 "
               "WHEN 'SMALL' THEN 4 WHEN 'LARGE' THEN 5 ELSE 6 END AS INTEGER)")

RAW = f"""
raw_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS user_id,
         CASE o_orderstatus WHEN 'F' THEN 'prior' WHEN 'O' THEN 'train' ELSE 'test' END AS eval_set,
         CAST(row_number() OVER w AS INTEGER) AS order_number,
         CAST(dayofweek(o_orderdate) AS INTEGER) AS order_dow,
         CAST(o_orderkey % 24 AS INTEGER) AS order_hour_of_day,
         CAST(date_diff('day', CAST(lag(o_orderdate) OVER w AS DATE), CAST(o_orderdate AS DATE)) AS DECIMAL(38,0))
           AS days_since_prior_order
  FROM orders
  WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
),
line_pairs AS (
  SELECT l_orderkey, l_partkey, min(l_linenumber) AS ln FROM lineitem GROUP BY l_orderkey, l_partkey
),
all_lines AS (
  SELECT p.l_orderkey AS order_id, CAST(p.l_partkey AS INTEGER) AS product_id,
         CAST(row_number() OVER (PARTITION BY p.l_orderkey ORDER BY p.ln, p.l_partkey) AS INTEGER)
           AS add_to_cart_order,
         o.user_id, o.order_number, o.eval_set
  FROM line_pairs p JOIN raw_orders o ON p.l_orderkey = o.order_id
),
raw_lines AS (
  SELECT order_id, product_id, add_to_cart_order,
         CAST(CASE WHEN min(order_number) OVER (PARTITION BY user_id, product_id) < order_number
                   THEN 1 ELSE 0 END AS INTEGER) AS reordered,
         order_number, eval_set
  FROM all_lines
),
raw_order_products_prior AS (
  SELECT order_id, product_id, add_to_cart_order, reordered, order_number FROM raw_lines WHERE eval_set = 'prior'
),
raw_order_products_train AS (
  SELECT order_id, product_id, add_to_cart_order, reordered, order_number FROM raw_lines WHERE eval_set = 'train'
),
raw_products AS (
  SELECT CAST(p_partkey AS INTEGER) AS product_id, p_name AS product_name, {_AISLE_CASE} AS aisle_id,
         CAST(substr(p_brand, 7) AS INTEGER) AS department_id
  FROM part
),
raw_aisles AS (
  SELECT {_AISLE_CASE} AS aisle_id, min(p_type) AS aisle FROM part GROUP BY 1
),
raw_departments AS (
  SELECT CAST(substr(p_brand, 7) AS INTEGER) AS department_id, min(p_brand) AS department FROM part GROUP BY 1
),
raw_off AS (
  SELECT CASE WHEN user_id % 50 = 0 THEN '' ELSE 'P' || CAST(user_id AS VARCHAR) END AS code,
         event_type AS product_name,
         CASE WHEN event_id % 7 = 0 THEN NULL ELSE 'B' || CAST(event_id % 5 AS VARCHAR) END AS brands,
         [event_type] AS categories_tags,
         value AS energy_kcal_100g,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS fat_100g,
         CAST(floor(epoch(ts)) AS BIGINT) AS last_modified_t,
         event_id
  FROM events
)"""

STAGING = f"""
stg_aisles AS (FROM raw_aisles SELECT aisle_id, aisle AS aisle_name),
stg_departments AS (FROM raw_departments SELECT department_id, department AS department_name),
stg_products AS (FROM raw_products SELECT product_id, product_name, aisle_id, department_id),
stg_orders AS (
  FROM raw_orders
  SELECT * EXCLUDE (order_dow) REPLACE (CAST(days_since_prior_order AS DOUBLE) AS days_since_prior_order),
         order_dow AS order_day_of_week
  WHERE eval_set <> 'test'
),
stg_order_products AS (
  FROM raw_lines SELECT * EXCLUDE (eval_set), eval_set AS source WHERE eval_set <> 'test'
),
off_parsed AS (
  FROM raw_off
  SELECT code AS product_code, product_name, brands, categories_tags, energy_kcal_100g,
         CAST(NULL AS DOUBLE) AS sugars_100g, fat_100g, CAST(NULL AS DOUBLE) AS proteins_100g,
         CAST(NULL AS DOUBLE) AS salt_100g, last_modified_t,
         make_timestamp(last_modified_t * 1000000) AS last_modified_at, event_id
  WHERE length(code) > 0
),
off_newest AS (
  FROM off_parsed SELECT product_code, max((last_modified_t, event_id)) AS newest GROUP BY product_code
),
stg_off_products AS (
  SELECT p.* EXCLUDE (event_id) FROM off_parsed p JOIN off_newest n
  ON n.product_code = p.product_code AND n.newest = (p.last_modified_t, p.event_id)
),
int_order_metrics AS (
  FROM stg_order_products
  SELECT order_id, count(*) AS basket_size, count(*) FILTER (reordered = 1) AS num_reordered,
         {rounded_ratio('count(*) FILTER (reordered = 1)', 'count(*)', 4)} AS reorder_ratio
  GROUP BY order_id
),
user_totals AS (
  FROM raw_orders b LEFT JOIN int_order_metrics m USING (order_id)
  SELECT user_id, count(*) AS orders, count(basket_size) AS baskets, sum(basket_size) AS items,
         sum(num_reordered) AS again, sum(days_since_prior_order) AS days, count(days_since_prior_order) AS gaps
  WHERE eval_set <> 'test' GROUP BY user_id
),
int_user_metrics AS (
  FROM user_totals
  SELECT user_id, orders AS total_orders, {rounded_ratio('days', 'gaps', 2)} AS avg_days_between_orders,
         CAST(items AS BIGINT) AS total_items_purchased, {rounded_ratio('items', 'baskets', 2)} AS avg_basket_size,
         {rounded_ratio('again', 'items', 4)} AS reorder_ratio
)"""

_DAYS = ", ".join(f"'{d}'" for d in fixed.DAY_NAMES)
_PARTS = " ".join(f"WHEN hour >= {lo} AND hour <= {hi} THEN '{name}'" for name, lo, hi in fixed.DAY_PARTS)
_WEEKEND = ", ".join(map(str, fixed.WEEKEND_DAYS))

MARTS = f"""
dim_product AS (
  SELECT {_sk('product_id')} AS product_key, *,
         (SELECT any_value(aisle) FROM raw_aisles x WHERE x.aisle_id = y.aisle_id) AS aisle_name,
         (SELECT any_value(department) FROM raw_departments x WHERE x.department_id = y.department_id)
           AS department_name
  FROM raw_products y
),
dim_user AS (FROM int_user_metrics SELECT {_sk('user_id')} AS user_key, *),
hours AS (
  SELECT CAST(i // {fixed.HOURS_PER_DAY} AS INTEGER) AS day, CAST(i % {fixed.HOURS_PER_DAY} AS INTEGER) AS hour
  FROM range({fixed.DAYS_PER_WEEK * fixed.HOURS_PER_DAY}) t(i)
),
dim_time AS (
  FROM hours
  SELECT {_sk('day', 'hour')} AS time_key, day AS order_day_of_week, [{_DAYS}][day + 1] AS day_name,
         list_contains([{_WEEKEND}], day) AS is_weekend, hour AS order_hour_of_day,
         CASE {_PARTS} ELSE '{fixed.DAY_PART_OTHER}' END AS day_part
),
dim_food_product AS (
  FROM stg_off_products
  SELECT {_sk('product_code')} AS food_product_key, * EXCLUDE (categories_tags, last_modified_t)
),
keyed_orders AS (
  FROM raw_orders
  SELECT *, {_sk('user_id')} AS user_key, {_sk('order_dow', 'order_hour_of_day')} AS time_key WHERE eval_set <> 'test'
),
fact_orders AS (
  SELECT k.order_id, k.user_key, k.time_key, k.order_number, k.eval_set,
         CAST(k.days_since_prior_order AS DOUBLE) AS days_since_prior_order, m.* EXCLUDE (order_id)
  FROM keyed_orders k LEFT JOIN int_order_metrics m USING (order_id)
),
fact_order_items AS (
  SELECT l.* EXCLUDE (eval_set), l.eval_set AS source, {_sk('l.product_id')} AS product_key, k.user_key, k.time_key
  FROM raw_lines l JOIN keyed_orders k USING (order_id)
)"""

PREFIX = "WITH " + RAW.strip() + ",\n" + STAGING.strip() + ",\n" + MARTS.strip() + "\n"


def with_models(select: str) -> str:
    """Prefix a SELECT with every raw / staging / mart CTE."""
    return PREFIX + select.strip()


def dq_select(test) -> str:
    """Failing-row count of one data test, written as the test's own SQL."""
    col = test.columns[0]
    lits = (f"'{test.name}' AS test_name, '{test.kind}' AS kind, '{test.model}' AS model, "
            f"'{test.column_name}' AS column_name")
    if test.kind == "not_null":
        body = f"SELECT count(*) AS n FROM {test.model} WHERE {col} IS NULL"
    elif test.kind == "accepted_values":
        vals = ", ".join(repr(v) for v in test.values)
        body = f"SELECT count(DISTINCT {col}) AS n FROM {test.model} WHERE {col} NOT IN ({vals})"
    elif test.kind == "unique":
        body = (f"SELECT count(*) AS n FROM (SELECT {col} FROM {test.model} WHERE {col} IS NOT NULL "
                f"GROUP BY {col} HAVING count(*) > 1)")
    elif test.kind == "unique_combination":
        cols = ", ".join(test.columns)
        body = f"SELECT count(*) AS n FROM (SELECT {cols} FROM {test.model} GROUP BY {cols} HAVING count(*) > 1)"
    elif test.kind == "relationships":
        body = (f"SELECT count(*) AS n FROM (SELECT {col} AS from_field FROM {test.model} WHERE {col} IS NOT NULL) c "
                f"LEFT JOIN (SELECT {test.to_column} AS to_field FROM {test.to_model}) p "
                f"ON c.from_field = p.to_field WHERE p.to_field IS NULL")
    else:
        raise ValueError(test.kind)
    return f"SELECT {lits}, CAST(n AS BIGINT) AS n_failed FROM ({body})"


def dq_sql(tests) -> str:
    return with_models("\nUNION ALL\n".join(dq_select(t) for t in tests))


WAVE_COUNTS = with_models("""
SELECT 'orders' AS table_name, order_number, count(*) AS n_rows FROM raw_orders GROUP BY order_number
UNION ALL
SELECT 'order_products_prior', order_number, count(*) FROM raw_order_products_prior GROUP BY order_number
UNION ALL
SELECT 'order_products_train', order_number, count(*) FROM raw_order_products_train GROUP BY order_number
""")

FEED_ROWS = with_models("""
SELECT code AS product_code, product_name, brands, energy_kcal_100g, fat_100g, last_modified_t FROM raw_off
""")

CORRECTED = """
SELECT * REPLACE (CAST(CASE WHEN order_number = 5 AND product_id % 4 = 0 THEN 6 ELSE order_number END AS INTEGER)
                  AS order_number)
FROM fact_order_items
WHERE NOT (order_number IN (2, 3) AND product_id % 3 = 0) AND order_number <> 4"""

VIEW_SUMS = " UNION ALL ".join(
    f"SELECT '{v}' AS view_name, count(*) AS n_rows, CAST(CAST(sum({k}) AS HUGEINT) AS VARCHAR) AS checksum FROM {v}"
    for v, k in (("stg_aisles", "aisle_id"), ("stg_departments", "department_id"), ("stg_products", "product_id"),
                 ("stg_orders", "order_id"), ("stg_order_products", "order_id * product_id"),
                 ("stg_off_products", "last_modified_t"),
                 ("int_user_metrics", "CAST(round(reorder_ratio * 10000) AS BIGINT) + total_items_purchased")))

SCENARIOS = {
    "fact_order_items_corrected_wave": with_models(CORRECTED),
    "fact_order_items_rebuilt": with_models("""
SELECT * REPLACE (CAST(CASE WHEN order_number = 2 AND source = 'prior' THEN 1 ELSE reordered END AS INTEGER) AS reordered)
FROM fact_order_items"""),
    "reload_after_failed_load": with_models("SELECT * FROM raw_products"),
    "wave_after_failed_load": WAVE_COUNTS,
    "stg_off_products_ingested": with_models(
        "SELECT * REPLACE (to_json(categories_tags)::VARCHAR AS categories_tags) FROM stg_off_products"),
    "feed_uncapped_pull": with_models(
        "SELECT code AS product_code, last_modified_t, event_id AS feed_pos FROM raw_off WHERE last_modified_t > 0"),
    "load_audit": with_models(" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS n_rows, count(*) AS n_stamped FROM raw_{t}" for t in (
            "aisles", "departments", "products", "orders", "order_products_prior", "order_products_train"))),
    "csv_wave_load": with_models("SELECT * FROM stg_order_products"),
    "csv_text_roundtrip": """
SELECT CAST(p_partkey AS INTEGER) AS aisle_id,
       CASE p_partkey % 5 WHEN 0 THEN '  ' || p_name || chr(9) || ' '
                          WHEN 1 THEN '"' || p_name || '", "' || p_brand || '"'
                          WHEN 2 THEN p_name || chr(10) || p_type || chr(10) || chr(10) || ','
                          WHEN 3 THEN '\\' || p_name || '\\"\\' END AS aisle
FROM part""",
    "orphan_line_count": with_models("""
SELECT count(*) AS n_orphans FROM lineitem WHERE l_orderkey NOT IN (SELECT order_id FROM fact_orders)"""),
    "orders_by_day_part": with_models("""
SELECT day_name, is_weekend, day_part, count(*) AS n_orders FROM fact_orders JOIN dim_time USING (time_key) GROUP BY ALL"""),
    "staging_sql_views": with_models(VIEW_SUMS),
    "wave_split_counts": WAVE_COUNTS,
    "wave_reload_idempotent": WAVE_COUNTS,
    "full_refresh": with_models("SELECT * FROM raw_products"),
    "csv_roundtrip": with_models(
        "SELECT * REPLACE (CAST(days_since_prior_order AS BIGINT) AS days_since_prior_order) FROM raw_orders"),
    "json_array_ingest": FEED_ROWS,
    "append_once": FEED_ROWS,
    "high_water_mark": with_models(
        "SELECT CAST(coalesce(max(last_modified_t), 0) AS BIGINT) AS watermark FROM raw_off"),
    "feed_above_watermark": with_models("""
SELECT r.code AS product_code, r.last_modified_t, r.event_id AS feed_pos
FROM raw_off r, (SELECT (min(last_modified_t) + max(last_modified_t)) // 2 AS wm FROM raw_off) b
WHERE coalesce(r.last_modified_t, 0) > b.wm"""),
    "feed_capped_topn": with_models("""
SELECT code AS product_code, last_modified_t, event_id AS feed_pos
FROM raw_off WHERE coalesce(last_modified_t, 0) > 0
ORDER BY last_modified_t DESC, event_id DESC LIMIT 500"""),
    "fact_order_items_incremental": with_models("SELECT * FROM fact_order_items"),
    "fact_rows_per_wave": with_models(
        "SELECT order_number, count(*) AS n_rows FROM fact_order_items GROUP BY order_number ORDER BY 1"),
    "orphan_product_count": with_models("""
SELECT CAST(count(*) AS BIGINT) AS n_orphans FROM fact_order_items f
LEFT JOIN dim_product d ON f.product_key = d.product_key
WHERE f.product_key IS NOT NULL AND d.product_key IS NULL"""),
}
