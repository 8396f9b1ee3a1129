"""DuckDB twins of the warehouse queries (window forms of the merges)."""

from __future__ import annotations

from vitrina.plans.oracle import (CUSTOMERS, CUSTOMERS_RAW, FEEDBACK, ITEMS, ORDER_COLS, ORDERS, ORDERS_CITY,
                                  PAYMENTS, PRODUCTS, RUN_DATE, SQL, title, ustrip)

R1, R2 = "1994-01-01", "1998-01-01"
SPLIT, OVERLAP = "1998-01-01", "1997-07-01"


def cmp(cols: list[str]) -> str:
    return ustrip("lower(" + " || ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in cols) + ")")


def scd2_steps(b1: str, b2: str, cols: list[str], nk: str, sk: str, extra_null: list[tuple[str, str]],
               derived: str = "", p: str = "") -> str:
    """CTEs {p}d1 (first load into an empty dimension), {p}dim2 and {p}cnt
    (second load) in the plain window form: lag over (key, side, seq)."""
    c = cmp(cols)
    sel = ", ".join(cols)
    nulls = "".join(f", CAST(NULL AS {t}) AS {n}" for n, t in extra_null)
    full = f", {derived}" if derived else ""
    return f"""
{p}x1 AS (SELECT {nk}, seq, {sel}, {c} AS cmp FROM {b1}),
{p}a1 AS (SELECT *, lag(cmp) OVER (PARTITION BY {nk} ORDER BY seq) AS prev FROM {p}x1),
{p}y1 AS (SELECT *, lead({nk}) OVER (PARTITION BY {nk} ORDER BY seq) IS NULL AS cur
  FROM {p}a1 WHERE prev IS NULL OR cmp <> prev),
{p}d1 AS (SELECT row_number() OVER (ORDER BY {nk}, seq) AS {sk}, {nk}, {sel}{full}{nulls},
  DATE '{R1}' AS effective_date, CASE WHEN cur THEN DATE '9999-12-31' ELSE DATE '{R1}' END AS expiration_date,
  cur AS is_current, 'postgres_source' AS source_system, DATE '{R1}' AS load_date,
  CAST('{R1}' AS TIMESTAMP) AS created_at, CAST('{R1}' AS TIMESTAMP) AS updated_at FROM {p}y1),
{p}x2 AS (SELECT {nk}, 0 AS side, CAST(-1 AS BIGINT) AS seq, {sk}, {sel}, {c} AS cmp FROM {p}d1 WHERE is_current
  UNION ALL SELECT {nk}, 1, seq, NULL, {sel}, {c} FROM {b2}),
{p}a2 AS (SELECT *, lag(cmp) OVER (PARTITION BY {nk} ORDER BY side, seq) AS prev FROM {p}x2),
{p}f2 AS (SELECT *, side = 0 OR prev IS NULL OR cmp <> prev AS acc FROM {p}a2),
{p}y2 AS (SELECT *, CASE WHEN side = 1 THEN lead({nk}) OVER (PARTITION BY {nk} ORDER BY side, seq) IS NULL
  ELSE max(side) OVER (PARTITION BY {nk}) = 0 END AS cur FROM {p}f2 WHERE acc),
{p}cnt AS (SELECT count(*) FILTER (WHERE side = 1 AND acc AND prev IS NULL) AS new_records,
  count(*) FILTER (WHERE side = 1 AND acc AND prev IS NOT NULL) AS updated_records,
  count(*) FILTER (WHERE side = 1 AND NOT acc) AS unchanged_records FROM {p}f2),
{p}closed AS (SELECT {sk} FROM {p}y2 WHERE side = 0 AND NOT cur),
{p}dim2 AS (
  SELECT d.* REPLACE (
    CASE WHEN c.{sk} IS NOT NULL THEN DATE '{R2}' ELSE d.expiration_date END AS expiration_date,
    CASE WHEN c.{sk} IS NOT NULL THEN false ELSE d.is_current END AS is_current,
    CASE WHEN c.{sk} IS NOT NULL THEN CAST('{R2}' AS TIMESTAMP) ELSE d.updated_at END AS updated_at)
  FROM {p}d1 d LEFT JOIN {p}closed c ON d.{sk} = c.{sk}
  UNION ALL BY NAME
  SELECT (SELECT max({sk}) FROM {p}d1) + row_number() OVER (ORDER BY {nk}, seq) AS {sk}, {nk}, {sel}{full}{nulls},
    DATE '{R2}' AS effective_date, CASE WHEN cur THEN DATE '9999-12-31' ELSE DATE '{R2}' END AS expiration_date,
    cur AS is_current, 'postgres_source' AS source_system, DATE '{R2}' AS load_date,
    CAST('{R2}' AS TIMESTAMP) AS created_at, CAST('{R2}' AS TIMESTAMP) AS updated_at FROM {p}y2 WHERE side = 1)"""


def _body(cte: str) -> str:
    """A stand-in CTE without the shared geo CTE in front of it."""
    return cte.split(",\n", 1)[1] if cte.startswith("geo AS") else cte


CUST_B = """
b1 AS (SELECT customer_id, first_name, last_name, email, city, customer_id * 2 AS seq FROM customers_s
  WHERE country <> 'ASIA'),
b2 AS (SELECT customer_id,
    CASE WHEN customer_segment = 'FURNITURE' THEN first_name || substr(last_name, 1, 1) ELSE first_name END
      AS first_name,
    CASE WHEN customer_segment = 'FURNITURE' THEN substr(last_name, 2) ELSE last_name END AS last_name,
    CASE WHEN customer_segment = 'MACHINERY' THEN upper(email)
         WHEN customer_segment = 'HOUSEHOLD' THEN 'new.' || email ELSE email END AS email,
    CASE WHEN customer_segment = 'BUILDING' THEN city || ' 2' ELSE city END AS city, customer_id * 2 AS seq
  FROM customers_s
  UNION ALL SELECT customer_id, first_name, last_name, email, city, customer_id * 2 + 1 FROM customers_s
  WHERE customer_segment = 'HOUSEHOLD'),""" + scd2_steps(
    "b1", "b2", ["first_name", "last_name", "email", "city"], "customer_id", "customer_key",
    [("phone", "VARCHAR"), ("country", "VARCHAR"), ("customer_segment", "VARCHAR"), ("registration_date", "DATE")],
    "first_name || ' ' || last_name AS full_name")
CUST_BATCHES = CUSTOMERS + "," + CUST_B

SQL["scd2_customers"] = f"WITH {CUST_BATCHES}\nSELECT * FROM dim2"
SQL["scd2_counts"] = f"WITH {CUST_BATCHES}\nSELECT * FROM cnt"
SQL["current_customers"] = f"""WITH {CUST_BATCHES}
SELECT customer_key, customer_id, first_name, last_name, full_name, email, city, country, customer_segment,
  effective_date, expiration_date FROM dim2 WHERE is_current"""
SQL["customer_history"] = f"""WITH {CUST_BATCHES}
SELECT customer_id, first_name, last_name, city, country, customer_segment, effective_date, expiration_date,
  CASE WHEN is_current THEN 'Текущая' ELSE 'Историческая' END AS version_status,
  CAST(expiration_date - effective_date AS INTEGER) AS days_active FROM dim2"""

PROD_B = """
pb1 AS (SELECT product_id, product_name, category, brand, unit_price, product_id AS seq FROM products_s),
pb2 AS (SELECT product_id, product_name, category, lower(brand) AS brand,
  CAST(CASE WHEN starts_with(category, 'SMALL') THEN unit_price + 1 ELSE unit_price END AS DECIMAL(10,2))
    AS unit_price,
  product_id AS seq FROM products_s),""" + scd2_steps(
    "pb1", "pb2", ["product_name", "category", "brand", "unit_price"], "product_id", "product_key",
    [("subcategory", "VARCHAR"), ("cost_price", "DECIMAL(10,2)"), ("stock_quantity", "INTEGER")], p="p")
SQL["scd2_products"] = f"WITH {PRODUCTS},{PROD_B}\nSELECT * FROM pdim2"

_CLEAN_ORDERS = ORDERS_CITY + """,
oc AS (SELECT * REPLACE (coalesce(status, 'Pending') AS status, coalesce(payment_method, 'Не указан') AS payment_method,
  coalesce(shipping_city, 'Не указан') AS shipping_city, TRY_CAST(order_date AS DATE) AS order_date,
  coalesce(TRY_CAST(total_amount AS DECIMAL(12,2)), CAST(0 AS DECIMAL(12,2))) AS total_amount) FROM orders_c)"""

SQL["upsert_full"] = f"""WITH {_CLEAN_ORDERS},
t AS (SELECT order_date AS analytics_date, count(*) AS total_orders, CAST(sum(total_amount) AS DECIMAL(22,2))
    AS total_revenue, count(*) FILTER (WHERE status = 'Pending') AS new_orders,
    count(*) FILTER (WHERE status = 'Cancelled') AS cancelled_orders,
    CAST('1997-12-31 00:00:00' AS TIMESTAMP) AS created_at, CAST(NULL AS TIMESTAMP) AS updated_at,
    CAST(NULL AS DOUBLE) AS avg_order_value, CAST(NULL AS VARCHAR) AS top_city
  FROM oc WHERE order_date < DATE '{SPLIT}' GROUP BY order_date),
s AS (SELECT order_date AS analytics_date, count(*) AS total_orders, CAST(sum(total_amount) AS DECIMAL(22,2))
    AS total_revenue, CAST(sum(total_amount) AS DOUBLE) / count(total_amount) AS avg_order_value,
    count(DISTINCT customer_id) AS active_customers,
    coalesce(mode() WITHIN GROUP (ORDER BY shipping_city), 'Не указан') AS top_city
  FROM oc WHERE order_date >= DATE '{OVERLAP}' GROUP BY order_date)
SELECT coalesce(t.analytics_date, s.analytics_date) AS analytics_date,
  CASE WHEN s.analytics_date IS NOT NULL THEN s.total_orders ELSE t.total_orders END AS total_orders,
  CASE WHEN s.analytics_date IS NOT NULL THEN s.total_revenue ELSE t.total_revenue END AS total_revenue,
  CASE WHEN t.analytics_date IS NOT NULL THEN t.new_orders ELSE NULL END AS new_orders,
  CASE WHEN t.analytics_date IS NOT NULL THEN t.cancelled_orders ELSE NULL END AS cancelled_orders,
  CASE WHEN t.analytics_date IS NOT NULL THEN t.created_at ELSE CAST('{RUN_DATE} 09:00:00' AS TIMESTAMP) END
    AS created_at,
  CASE WHEN s.analytics_date IS NOT NULL THEN CAST('{RUN_DATE} 09:00:00' AS TIMESTAMP) ELSE t.updated_at END
    AS updated_at,
  CASE WHEN s.analytics_date IS NOT NULL THEN s.avg_order_value ELSE t.avg_order_value END AS avg_order_value,
  CASE WHEN s.analytics_date IS NOT NULL THEN s.top_city ELSE t.top_city END AS top_city
FROM t FULL OUTER JOIN s ON t.analytics_date = s.analytics_date"""

SQL["upsert_partial"] = f"""WITH {CUSTOMERS}, {_body(CUSTOMERS_RAW)},
t AS (SELECT customer_id, CASE WHEN customer_segment = 'AUTOMOBILE' THEN NULL ELSE first_name END AS first_name,
  last_name, email, phone, city, country, customer_segment FROM customers_s WHERE country <> 'AFRICA'),
s AS (SELECT customer_id, {title('first_name')} AS first_name, {title('last_name')} AS last_name,
  {ustrip('lower(email)')} AS email, coalesce(city, 'Не указан') AS city, coalesce(country, 'Россия') AS country,
  coalesce(customer_segment, 'Standard') AS customer_segment FROM customers_raw)
SELECT coalesce(t.customer_id, s.customer_id) AS customer_id,
  CASE WHEN t.customer_id IS NOT NULL THEN t.first_name ELSE s.first_name END AS first_name,
  CASE WHEN t.customer_id IS NOT NULL THEN t.last_name ELSE s.last_name END AS last_name,
  CASE WHEN t.customer_id IS NOT NULL THEN t.email ELSE s.email END AS email,
  CASE WHEN t.customer_id IS NOT NULL THEN t.phone ELSE NULL END AS phone,
  CASE WHEN s.customer_id IS NOT NULL THEN s.city ELSE t.city END AS city,
  CASE WHEN s.customer_id IS NOT NULL THEN s.country ELSE t.country END AS country,
  CASE WHEN s.customer_id IS NOT NULL THEN s.customer_segment ELSE t.customer_segment END AS customer_segment
FROM t FULL OUTER JOIN s ON t.customer_id = s.customer_id"""

SQL["insert_if_absent"] = f"""WITH {_CLEAN_ORDERS},
r AS (SELECT order_id, customer_id, CAST(1 AS BIGINT) AS product_id, coalesce(order_date, DATE '{RUN_DATE}')
    AS order_date, total_amount, status, payment_method, shipping_city,
    CAST(unnest(generate_series(CAST(order_date AS TIMESTAMP), CAST(order_date AS TIMESTAMP) + INTERVAL 7 DAY,
                                INTERVAL 1 DAY)) AS DATE) AS load_date FROM oc),
t AS (SELECT * FROM r WHERE load_date < DATE '{SPLIT}')
SELECT * FROM t
UNION ALL
SELECT r.* FROM r WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.order_id = r.order_id AND t.load_date = r.load_date)"""

SQL["tolerant_load"] = """WITH e AS (SELECT event_id AS payment_id, CAST(user_id AS VARCHAR) AS customer_id,
  CASE WHEN event_type = 'error' THEN 'n/a' WHEN event_type = 'signup' THEN NULL
       ELSE CAST("value" AS VARCHAR) END AS amount FROM events),
r AS (SELECT *, list_filter([CASE WHEN customer_id IS NOT NULL AND TRY_CAST(customer_id AS BIGINT) IS NULL
      THEN 'bad customer_id' WHEN customer_id IS NULL THEN 'missing customer_id' END,
    CASE WHEN amount IS NOT NULL AND TRY_CAST(amount AS DECIMAL(12,2)) IS NULL THEN 'bad amount'
      WHEN amount IS NULL THEN 'missing amount' END], lambda x: x IS NOT NULL) AS reasons FROM e)
SELECT payment_id, CAST(TRY_CAST(amount AS DECIMAL(12,2)) AS VARCHAR) AS amount, CAST(NULL AS VARCHAR) AS reject_reason
FROM r WHERE len(reasons) = 0
UNION ALL SELECT payment_id, amount, array_to_string(reasons, '; ') FROM r WHERE len(reasons) > 0"""

SQL["fact_feedback"] = f"""WITH {FEEDBACK}
SELECT row_number() OVER (ORDER BY doc_id) AS feedback_key,
  substr(printf('FB_%04d', row_number() OVER (ORDER BY doc_id) - 1), 1, 50) AS feedback_id,
  substr(coalesce(comment, ''), 1, 500) AS feedback_text, 0 AS customer_id, 0 AS product_id,
  coalesce(TRY_CAST(rating_raw AS INTEGER), 0) AS rating, 'mongo_source' AS source_system,
  DATE '{RUN_DATE}' AS load_date FROM feedback_s"""

SQL["dim_date"] = """WITH d AS (SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY))
  AS DATE) AS full_date FROM orders)
SELECT CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_key, full_date,
  CAST(day(full_date) AS INTEGER) AS day_of_month, CAST(isodow(full_date) AS INTEGER) AS day_of_week,
  strftime(full_date, '%A') AS day_name, CAST(weekofyear(full_date) AS INTEGER) AS week_number,
  CAST(month(full_date) AS INTEGER) AS month_number, strftime(full_date, '%B') AS month_name,
  CAST(quarter(full_date) AS INTEGER) AS quarter, CAST(year(full_date) AS INTEGER) AS year,
  isodow(full_date) IN (6, 7) AS is_weekend, false AS is_holiday, CAST(NULL AS VARCHAR) AS holiday_name FROM d"""

SQL["orders_by_time_of_day"] = """WITH t AS (SELECT ((o_orderkey * 7919) % 86400) // 3600 AS h FROM orders)
SELECT CASE WHEN h BETWEEN 6 AND 11 THEN 'Утро' WHEN h BETWEEN 12 AND 17 THEN 'День'
            WHEN h BETWEEN 18 AND 23 THEN 'Вечер' ELSE 'Ночь' END AS time_of_day,
  CASE WHEN h >= 12 THEN 'PM' ELSE 'AM' END AS am_pm, count(*) AS orders,
  CAST(min(CASE WHEN h > 12 THEN h - 12 ELSE h END) AS INTEGER) AS min_hour_12,
  CAST(max(CASE WHEN h > 12 THEN h - 12 ELSE h END) AS INTEGER) AS max_hour_12
FROM t GROUP BY 1, 2"""

_STATUS_SEED = """seed AS (SELECT * FROM (VALUES (1, 'PENDING'), (2, 'PROCESSING'), (3, 'SHIPPED'), (4, 'DELIVERED'),
  (5, 'CANCELLED'), (6, 'REFUNDED')) v(status_key, status_code))"""

SQL["orders_by_status"] = f"""WITH {ORDERS}, {_STATUS_SEED}
SELECT s.status_key, o.status AS order_status, count(*) AS orders
FROM orders_s o LEFT JOIN seed s ON upper(o.status) = s.status_code GROUP BY 1, 2"""

_FACTS = f"""{CUSTOMERS}, {_body(ORDERS_CITY)}, {PRODUCTS}, {ITEMS}, {_STATUS_SEED},{CUST_B},{PROD_B},
lines AS (SELECT i.order_id, o.customer_id, i.product_id, o.order_date, o.order_time, o.status AS order_status,
    o.payment_method, o.shipping_city, i.quantity,
    CAST(CAST((CAST(i.total_price * 100 AS BIGINT) * 2 + i.quantity) // (2 * nullif(i.quantity, 0)) AS DOUBLE) / 100
      AS DECIMAL(10,2)) AS unit_price,
    CAST(i.total_price AS DECIMAL(12,2)) AS total_amount,
    CAST(i.quantity * p.cost_price AS DECIMAL(12,2)) AS cost_amount,
    CAST(i.total_price - CAST(i.quantity * p.cost_price AS DECIMAL(12,2)) AS DECIMAL(12,2)) AS profit_amount
  FROM items_s i JOIN orders_c o ON i.order_id = o.order_id LEFT JOIN products_s p ON i.product_id = p.product_id),
valid AS (SELECT * FROM lines WHERE coalesce(quantity > 0, true) AND coalesce(unit_price >= 0, true)
  AND coalesce(total_amount >= 0, true)),
fo AS (SELECT c.customer_key, p.product_key, CAST(strftime(v.order_date, '%Y%m%d') AS INTEGER) AS date_key,
    CAST(split_part(v.order_time, ':', 1) AS INTEGER) * 10000 + CAST(split_part(v.order_time, ':', 2) AS INTEGER) * 100
      + CAST(split_part(v.order_time, ':', 3) AS INTEGER) AS time_key, s.status_key, v.order_id, v.customer_id,
    v.product_id, v.order_status, v.payment_method, v.shipping_city, v.quantity, v.unit_price, v.total_amount,
    v.cost_amount, v.profit_amount, 'postgres_source' AS source_system, DATE '{RUN_DATE}' AS load_date
  FROM valid v
  LEFT JOIN dim2 c ON v.customer_id = c.customer_id AND v.order_date >= c.effective_date
    AND v.order_date < c.expiration_date
  LEFT JOIN pdim2 p ON v.product_id = p.product_id AND v.order_date >= p.effective_date
    AND v.order_date < p.expiration_date
  LEFT JOIN seed s ON upper(v.order_status) = s.status_code)"""

SQL["fact_orders"] = f"WITH {_FACTS}\nSELECT * FROM fo"

SQL["daily_sales"] = f"""WITH {_FACTS},
dd AS (SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS full_date FROM
  (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS d FROM orders))
SELECT dd.full_date, count(DISTINCT fo.order_id) AS total_orders, count(DISTINCT fo.customer_id) AS unique_customers,
  CAST(sum(fo.quantity) AS BIGINT) AS total_items, CAST(sum(fo.total_amount) AS DECIMAL(22,2)) AS total_revenue,
  CAST(sum(fo.total_amount) AS DOUBLE) / count(fo.total_amount) AS avg_order_value
FROM fo JOIN dd ON fo.date_key = dd.date_key GROUP BY dd.full_date"""

SQL["fact_payments"] = f"""WITH {CUST_BATCHES}, {PAYMENTS}
SELECT c.customer_key, CAST(strftime(p.payment_ts, '%Y%m%d') AS INTEGER) AS date_key,
  CAST(hour(p.payment_ts) * 10000 + minute(p.payment_ts) * 100 + second(p.payment_ts) AS INTEGER) AS time_key,
  p.payment_id, l.order_id, p.customer_id, p.payment_amount, p.payment_method, p.payment_status,
  'postgres_source' AS source_system, DATE '{RUN_DATE}' AS load_date
FROM payments_s p LEFT JOIN (SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS order_id
    FROM orders GROUP BY o_custkey) l ON p.customer_id = l.o_custkey
  LEFT JOIN dim2 c ON p.customer_id = c.customer_id
  AND CAST(p.payment_ts AS DATE) >= c.effective_date AND CAST(p.payment_ts AS DATE) < c.expiration_date"""

SQL["orphan_payments"] = f"""WITH {PAYMENTS}
SELECT * FROM payments_s p WHERE p.customer_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = p.customer_id)"""

_LINE_OK = ["l_quantity > 0", "l_discount BETWEEN 0 AND 0.09", "l_tax >= 0"]
_LINE_NAMES = ["quantity_positive", "discount_in_range", "tax_non_negative"]

SQL["constraint_violations"] = f"""SELECT l_orderkey, l_linenumber, l_quantity, l_discount, failed_checks FROM (
  SELECT *, array_to_string(list_filter([{', '.join(f"CASE WHEN NOT coalesce({c}, true) THEN '{n}' END"
                                                   for c, n in zip(_LINE_OK, _LINE_NAMES))}],
                                        lambda x: x IS NOT NULL), ',') AS failed_checks FROM lineitem)
WHERE failed_checks <> ''"""

SQL["duplicate_keys"] = """SELECT l_orderkey, l_linenumber, count(*) AS occurrences FROM lineitem
WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1"""


def _metrics(source: str, table: str, keys: str, ok: str, run: str, cols: list[str]) -> str:
    nulls = " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in cols)
    return f"""SELECT DATE '{run}' AS run_date, 'vitrina' AS dag_id, 'load' AS task_id, '{source}' AS source_name,
  count(*) AS total_records, count(*) FILTER (WHERE {ok}) AS valid_records,
  count(*) - count(*) FILTER (WHERE {ok}) AS invalid_records,
  count(*) - count(DISTINCT ({keys})) AS duplicate_records, CAST({nulls} AS BIGINT) AS null_values_count,
  CAST(0 AS BIGINT) AS error_count, CAST(NULL AS DECIMAL(10,2)) AS processing_time_seconds, 'success' AS status,
  CAST(NULL AS VARCHAR) AS error_message FROM {table}"""


_LI_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
            "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
_O_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
_C_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
METRICS = f"""m AS ({_metrics('lineitem', 'lineitem', 'l_orderkey, l_linenumber',
                         ' AND '.join(f'coalesce({c}, true)' for c in _LINE_OK), RUN_DATE, _LI_COLS)}
  UNION ALL {_metrics('orders', 'orders', 'o_orderkey', 'coalesce(o_totalprice > 0, true)', RUN_DATE, _O_COLS)}
  UNION ALL {_metrics('customer', 'customer', 'c_custkey', 'coalesce(c_acctbal >= 0, true)', R2, _C_COLS)})"""

SQL["quality_metrics"] = f"WITH {METRICS}\nSELECT * FROM m"

SQL["latest_quality"] = f"""WITH {METRICS}
SELECT source_name, run_date, total_records, valid_records,
  CAST(round(CAST(valid_records AS DECIMAL(20,6)) / CAST(nullif(total_records, 0) AS DECIMAL(20,6)) * 100, 2)
    AS DECIMAL(10,2)) AS quality_percentage, processing_time_seconds
FROM m WHERE run_date = (SELECT max(run_date) FROM m)"""

SQL["validation_report"] = f"""WITH {PRODUCTS}
SELECT false AS is_valid, ['missing required column: supplier'] AS errors,
  CASE WHEN count(*) = 0 THEN ['empty frame'] ELSE CAST([] AS VARCHAR[]) END AS warnings, count(*) AS total_rows,
  7 AS total_columns, CAST({' + '.join(f'count(*) FILTER (WHERE {c} IS NULL)' for c in
    ['product_id', 'product_name', 'category', 'brand', 'unit_price', 'cost_price', 'stock_quantity'])} AS BIGINT)
    AS missing_values FROM products_s"""

SQL["check_suite"] = f"""WITH {PAYMENTS},
c AS (
  SELECT 'orders_loaded' AS check_name, count(*) > 0 AS passed, CAST(count(*) AS DOUBLE) AS value FROM orders
  UNION ALL SELECT 'lineitem_keys_unique', count(*) = 0, CAST(count(*) AS DOUBLE) FROM (
    SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)
  UNION ALL SELECT 'payments_have_customer', count(*) = 0, CAST(count(*) AS DOUBLE) FROM payments_s p
    WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = p.customer_id)
  UNION ALL SELECT 'revenue_positive', sum(o_totalprice) > 0, sum(o_totalprice) FROM orders)
SELECT * FROM c
UNION ALL SELECT CASE WHEN count(*) FILTER (WHERE NOT passed) = 0 THEN 'success' ELSE 'warning' END,
  count(*) FILTER (WHERE NOT passed) = 0, CAST(count(*) FILTER (WHERE passed) AS DOUBLE) FROM c"""

SQL["latest_kpi"] = f"""WITH {_CLEAN_ORDERS}
SELECT order_date AS analytics_date, count(*) AS total_orders, CAST(sum(total_amount) AS DECIMAL(22,2))
    AS total_revenue, CAST(sum(total_amount) AS DOUBLE) / count(total_amount) AS avg_order_value,
    count(DISTINCT customer_id) AS active_customers,
    coalesce(mode() WITHIN GROUP (ORDER BY shipping_city), 'Не указан') AS top_city
FROM oc GROUP BY order_date ORDER BY analytics_date DESC LIMIT 1"""

_CSV = """csv AS (SELECT CAST(p_partkey AS INTEGER) AS product_id,
    CASE WHEN p_size = 7 THEN 'new' || chr(10) ELSE '' END || p_name AS product_name, p_type AS category,
    p_brand AS subcategory, CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price, p_size AS stock_quantity,
    'Supplier "' || p_brand || '", Ltd' AS supplier, CASE WHEN p_size < 5 THEN NULL ELSE 'Russia' END AS country_of_origin,
    CAST(p_size / 10 AS DECIMAL(6,2)) AS weight_kg,
    CASE WHEN p_size = 1 OR p_size BETWEEN 10 AND 19 THEN NULL ELSE '10x20x30' END AS dimensions,
    CASE WHEN p_size = 1 THEN NULL WHEN p_size < 25 THEN TIMESTAMP '2024-01-01 00:00:00'
      ELSE TIMESTAMP '2024-01-01 10:00:00' END AS created_at,
    CASE WHEN p_size = 1 OR p_size > 45 THEN NULL ELSE TIMESTAMP '2024-02-01 12:30:00' END AS updated_at
  FROM part WHERE p_size <> 50)"""

SQL["csv_timestamps"] = f"WITH {_CSV}\nSELECT product_id, created_at, updated_at FROM csv"

SQL["csv_products"] = f"""WITH {_CSV}
SELECT row_number() OVER (ORDER BY product_id) AS csv_product_key, product_id, substr(product_name, 1, 255)
    AS product_name, substr(category, 1, 100) AS category, substr(subcategory, 1, 100) AS subcategory, unit_price,
  coalesce(stock_quantity, 0) AS stock_quantity, substr(supplier, 1, 100) AS supplier,
  substr(country_of_origin, 1, 100) AS country_of_origin, weight_kg, substr(dimensions, 1, 100) AS dimensions,
  'csv_source' AS source_system, DATE '{RUN_DATE}' AS load_date FROM csv"""

SQL["csv_product_stats"] = f"""WITH {_CSV}
SELECT count(*) AS total_products, CAST(sum(stock_quantity) AS BIGINT) AS total_stock,
  coalesce(CAST(sum(unit_price) AS DOUBLE) / count(unit_price), 0.0) AS avg_price,
  count(DISTINCT category) AS categories_count, count(DISTINCT supplier) AS suppliers_count FROM csv"""

SQL["current_lookup_payments"] = f"""WITH {CUST_BATCHES}, {PAYMENTS}
SELECT p.*, c.customer_key FROM payments_s p LEFT JOIN dim2 c ON p.customer_id = c.customer_id AND c.is_current"""

SQL["rejected_orders"] = f"""WITH {ITEMS}
SELECT i.order_id, i.product_id, i.quantity, i.total_price AS total_amount, 'order_exists' AS reject_reason FROM items_s i
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = i.order_id AND o.o_orderdate < DATE '{SPLIT}')"""

SQL["scd2_rejected"] = f"""WITH {CUST_BATCHES},
k AS (SELECT CASE WHEN city <> 'CHINA' THEN customer_id END AS customer_id, seq, email FROM b2)
SELECT customer_id, seq, email, 'no natural key' AS reject_reason FROM k WHERE customer_id IS NULL
UNION ALL SELECT customer_id, seq, email, 'late' FROM k
WHERE customer_id IN (SELECT customer_id FROM b1)"""

SQL["kpis_with_orphans"] = f"""WITH {CUSTOMERS}, {ORDERS},
o AS (SELECT s.*, c.city AS shipping_city FROM orders_s s LEFT JOIN
  (SELECT * FROM customers_s WHERE country <> 'ASIA') c ON s.customer_id = c.customer_id)
SELECT order_date AS analytics_date, count(*) AS total_orders,
  CAST(sum(total_amount) AS DECIMAL(22,2)) AS total_revenue,
  CAST(sum(total_amount) AS DOUBLE) / count(total_amount) AS avg_order_value,
  count(DISTINCT customer_id) AS active_customers,
  coalesce(mode() WITHIN GROUP (ORDER BY shipping_city) FILTER (WHERE shipping_city IS NOT NULL), 'Не указан') AS top_city
FROM o GROUP BY order_date"""

SQL["orphan_orders"] = f"""WITH {ORDERS}
SELECT * FROM orders_s o WHERE o.customer_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = o.customer_id)"""

SQL["run_kpis_final"] = f"""WITH {ORDERS_CITY}, {FEEDBACK},
o AS (SELECT * FROM orders_c WHERE order_date >= DATE '{RUN_DATE}' - INTERVAL 7 DAY),
r AS (SELECT TRY_CAST(rating_raw AS DOUBLE) AS rating FROM feedback_s)
SELECT DATE '{RUN_DATE}' AS analytics_date, (SELECT count(*) FROM o) AS total_orders,
  (SELECT CAST(coalesce(sum(total_amount), 0) AS DECIMAL(22,2)) FROM o) AS total_revenue,
  (SELECT coalesce(CAST(sum(total_amount) AS DOUBLE) / nullif(count(*), 0), 0.0) FROM o) AS avg_order_value,
  (SELECT count(DISTINCT customer_id) FROM o) AS active_customers,
  (SELECT coalesce(mode() WITHIN GROUP (ORDER BY shipping_city), 'Москва') FROM o) AS top_city,
  (SELECT coalesce(avg(rating), 0.0) FROM r) AS avg_customer_rating,
  (SELECT count(*) FILTER (WHERE rating <= 2) FROM r) AS complaint_count"""

SQL["clean_products"] = f"""WITH {PRODUCTS}
SELECT product_id, product_name,
  coalesce(CASE WHEN stock_quantity > 5 THEN category END, 'Другое') AS category,
  coalesce(CASE WHEN stock_quantity % 3 > 0 THEN brand END, 'Неизвестно') AS brand,
  CASE WHEN stock_quantity = 10 THEN CAST(0 AS DECIMAL(10,2)) WHEN stock_quantity = 11 THEN NULL ELSE unit_price END
    AS unit_price,
  CASE WHEN stock_quantity < 48 THEN stock_quantity END AS stock_quantity FROM products_s"""

SQL["cleaned_events"] = """WITH e AS (SELECT user_id, event_id, ts,
    CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS event_type FROM events)
SELECT user_id, event_id, ts, coalesce(event_type, 'unknown') AS event_type FROM (SELECT *,
  row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC, event_type DESC) AS rn FROM e) WHERE rn = 1"""

SQL["normalized_orders"] = """SELECT o_orderkey AS order_id,
  CASE WHEN o_orderpriority = '3-MEDIUM' THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) END AS order_date,
  o_orderpriority AS payment_method FROM orders"""

SQL["dim_products_simple"] = f"""WITH {PRODUCTS}
SELECT product_id, product_name, CASE WHEN stock_quantity > 25 THEN NULL ELSE category END AS category,
  CASE WHEN stock_quantity > 25 THEN brand ELSE 'new' END AS brand, CAST(unit_price + 1 AS DECIMAL(10,2)) AS unit_price,
  stock_quantity FROM products_s"""

SQL["total_price"] = f"""WITH {PRODUCTS}, {ITEMS}
SELECT order_id, line_number, quantity, unit_price, CAST(quantity * unit_price AS DECIMAL(12,2)) AS total_price
FROM items_s LEFT JOIN products_s USING (product_id)"""

SQL["customer_history_ordered"] = f"""WITH {CUST_BATCHES}
SELECT row_number() OVER (ORDER BY customer_id, effective_date, customer_key) AS row_no, customer_id, effective_date,
  is_current FROM dim2"""

SQL["document_scan"] = """SELECT CAST(event_id AS VARCHAR) AS _id, CASE WHEN event_type <> 'error' THEN event_type END AS event_type,
  CASE WHEN event_type <> 'error' THEN "value" END AS value,
  CASE WHEN event_type = 'error' THEN 'malformed document' END AS reject_reason FROM events"""


def _long(section: str, source: str, long: list[str] = (), double: list[str] = (), text: list[str] = ()) -> str:
    kinds = [("value_long", "BIGINT", long), ("value_double", "DOUBLE", double), ("value_text", "VARCHAR", text)]
    rows = []
    for kind, _, names in kinds:
        for n in names:
            values = ", ".join(f"CAST({n if k == kind else 'NULL'} AS {t}) AS {k}" for k, t, _ in kinds)
            rows.append(f"SELECT '{section}' AS section, '{n}' AS metric, {values} FROM {source}")
    return "\nUNION ALL ".join(rows)


def _counts(section: str, source: str, name: str, n: str) -> str:
    return (f"SELECT '{section}', {name}, CAST({n} AS BIGINT), CAST(NULL AS DOUBLE), CAST(NULL AS VARCHAR) FROM {source}")


_TABLES = "\nUNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}"
                              for t in ("customer", "orders", "lineitem", "part"))
SQL["load_report"] = f"""WITH tables_ AS ({_TABLES}), ps AS ({SQL["product_stats"]}), tc AS ({SQL["top_categories"]}),
rs AS ({SQL["rating_stats"]}), lk AS ({SQL["latest_kpi"]})
{_long("csv_stats", "ps", ["total_products", "total_stock", "categories_count", "suppliers_count"], ["avg_price"])}
UNION ALL {_long("feedback", "rs", ["feedback_count"], ["avg_rating", "avg_nonzero_rating"])}
UNION ALL {_long("latest_kpi", "lk", ["total_orders", "active_customers"], ["total_revenue", "avg_order_value"],
                 ["analytics_date", "top_city"])}
UNION ALL {_counts("table_counts", "tables_", "table_name", "row_count")}
UNION ALL {_counts("table_counts", "(SELECT sum(row_count) AS n FROM tables_)", "'TOTAL'", "n")}
UNION ALL {_counts("top_categories", "tc", "category", '"count"')}"""


# ------------------------------------------------- indexed tables, one commit log
SQL["upsert_by_files"] = f"""WITH top AS (SELECT max(o_orderkey) AS k FROM orders)
SELECT o_orderkey AS order_id,
       CASE WHEN o_orderkey * 100 > k * 99 THEN lower(o_orderstatus) ELSE o_orderstatus END AS status,
       CASE WHEN o_orderkey * 100 > k * 99 THEN o_totalprice * 2 ELSE o_totalprice END AS total,
       CASE WHEN o_orderkey * 1000 <= k * 995 THEN 'first' ELSE 'second' END AS note,
       CASE WHEN o_orderkey * 100 > k * 99 THEN TIMESTAMP '{RUN_DATE} 09:00:00' END AS updated_at
FROM orders, top"""
SQL["scd2_by_buckets"] = SQL["scd2_customers"]
SQL["fact_orders_merged"] = SQL["fact_orders"]
SQL["insert_defaults"] = f"""SELECT o_orderkey AS order_id, CASE WHEN o_orderstatus = 'P' THEN 'Pending' ELSE o_orderstatus END AS status,
       CAST(NULL AS VARCHAR) AS payment_method, CAST(1 AS INTEGER) AS quantity, 'postgres_source' AS source_system,
       DATE '{RUN_DATE}' AS load_date, CAST(NULL AS VARCHAR) AS comment
FROM orders"""
SQL["warehouse_commit"] = f"""WITH n AS (SELECT (SELECT count(*) FROM ({SQL["fact_orders"]})) AS lines, (SELECT count(*) FROM lineitem) AS items)
SELECT 'dim_customers' AS table_name, count(*) AS row_count FROM customer
UNION ALL SELECT 'dim_customers_history', 0
UNION ALL SELECT 'dim_products', count(*) FROM part
UNION ALL SELECT 'dim_products_history', 0
UNION ALL SELECT 'fact_orders', lines FROM n
UNION ALL SELECT 'rejected_orders', items - lines FROM n
UNION ALL SELECT 'fact_payments', count(*) FROM events WHERE event_type = 'purchase'
UNION ALL SELECT 'data_quality_metrics', 2"""

SQL["daily_sales_by_load"] = SQL["daily_sales"]
SQL["declared_kpis_by_state"] = f"""SELECT * FROM ({SQL["declared_kpis"]})
WHERE analytics_date >= DATE '{RUN_DATE}' - INTERVAL 7 DAY"""
SQL["duplicates_across_loads"] = """WITH top AS (SELECT max(o_orderkey) AS top FROM orders), l AS (
  SELECT 'a' AS load, o_orderkey AS order_id FROM orders, top WHERE o_orderkey * 10 <= top * 6
  UNION ALL SELECT 'b', o_orderkey FROM orders, top WHERE o_orderkey * 100 > top * 55
  UNION ALL SELECT 'c', l_orderkey FROM lineitem WHERE l_quantity = 50
  UNION ALL SELECT 'd', l_orderkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45
), n AS (SELECT load, order_id, count(*) AS occurrences FROM l GROUP BY ALL),
e AS (
  SELECT *, count(*) OVER w AS earlier_loads, min(load) OVER w AS first_load FROM n
  WINDOW w AS (PARTITION BY order_id ORDER BY load ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
)
SELECT * FROM e WHERE occurrences > 1 OR earlier_loads > 0"""
