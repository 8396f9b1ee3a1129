"""DuckDB twins of the registered queries (same column names and types).

Stand-in CTEs mirror ``vitrina.sources.standins`` expression by expression.
"""

from __future__ import annotations

RUN_DATE = "1998-08-02"

GEO = """geo AS (SELECT n_nationkey, n_name AS city, r_name AS country
  FROM nation LEFT JOIN region ON n_regionkey = r_regionkey)"""

CUSTOMERS = GEO + """,
customers_s AS (SELECT c_custkey AS customer_id, split_part(c_name, '#', 1) AS first_name,
  split_part(c_name, '#', 2) AS last_name,
  lower(split_part(c_name, '#', 1)) || '.' || split_part(c_name, '#', 2) || '@example.com' AS email,
  '+7' || lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS phone, city, country, c_mktsegment AS customer_segment
  FROM customer LEFT JOIN geo ON c_nationkey = n_nationkey)"""

CUSTOMERS_RAW = GEO + """,
customers_raw AS (SELECT c_custkey AS customer_id,
  CASE WHEN c_acctbal < 0 THEN chr(9) || lower(c_mktsegment) || '''' || lower(city) || ' '
       ELSE ' ' || upper(c_mktsegment) || '-' || lower(city) || ' ' END AS first_name,
  split_part(c_name, '#', 2) AS last_name,
  ' ' || upper(split_part(c_name, '#', 1)) || '.' || split_part(c_name, '#', 2) || '@Example.COM' || chr(9) AS email,
  CASE WHEN c_acctbal < 0 THEN NULL ELSE city END AS city,
  CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN NULL ELSE country END AS country,
  CASE WHEN c_acctbal > 9000 THEN NULL ELSE c_mktsegment END AS customer_segment
  FROM customer LEFT JOIN geo ON c_nationkey = n_nationkey)"""

STATUS = """CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN 'Refunded'
       WHEN o_orderstatus = 'F' THEN 'Delivered'
       WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 'Cancelled'
       WHEN o_orderstatus = 'P' THEN 'Shipped' ELSE 'Pending' END"""

ORDER_COLS = f"""o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date,
  printf('%02d:%02d:%02d', ((o_orderkey * 7919) % 86400) // 3600, (((o_orderkey * 7919) % 86400) % 3600) // 60,
         ((o_orderkey * 7919) % 86400) % 60) AS order_time,
  CAST(o_totalprice AS DECIMAL(12,2)) AS total_amount, {STATUS} AS status, o_orderpriority AS payment_method"""

ORDERS = f"""orders_s AS (SELECT {ORDER_COLS} FROM orders)"""

ORDERS_CITY = GEO + f""",
orders_c AS (SELECT {ORDER_COLS}, city AS shipping_city, country AS shipping_country
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN geo ON c_nationkey = n_nationkey)"""

PRODUCTS = """products_s AS (SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
  p_brand AS brand, CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price,
  CAST(floor(p_retailprice * 60) / 100 AS DECIMAL(10,2)) AS cost_price, p_size AS stock_quantity FROM part)"""

ITEMS = """items_s AS (SELECT l_orderkey AS order_id, l_partkey AS product_id, l_linenumber AS line_number,
  CAST(l_quantity AS INTEGER) AS quantity, CAST(l_extendedprice AS DECIMAL(12,2)) AS total_price,
  CAST(l_shipdate AS DATE) AS ship_date FROM lineitem)"""

FEEDBACK = """feedback_s AS (SELECT d.doc_id, d.text AS comment,
  CASE WHEN l.toxic IS NULL THEN NULL WHEN l.toxic = 1 THEN 'x' ELSE CAST(d.n_chars % 8 AS VARCHAR) END AS rating_raw
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""

PAYMENTS = """payments_s AS (SELECT event_id AS payment_id, user_id AS customer_id, ts AS payment_ts,
  CAST("value" AS DECIMAL(12,2)) AS payment_amount, 'card' AS payment_method, 'Completed' AS payment_status
  FROM events WHERE event_type = 'purchase')"""

# The blank class and title-case tokens (see vitrina.functions.text).
BLANK = (r"[\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
         r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")


def ustrip(e: str) -> str:
    return f"regexp_replace({e}, '^{BLANK}+|{BLANK}+$', '', 'g')"


def title(e: str) -> str:
    toks = f"regexp_extract_all(lower({ustrip(e)}), '(\\p{{L}}+|[^\\p{{L}}]+)', 1)"
    return (f"CASE WHEN {e} IS NULL THEN NULL ELSE array_to_string(list_transform({toks}, "
            f"lambda t: CASE WHEN substr(t, 1, 1) = chr(223) THEN 'Ss' ELSE upper(substr(t, 1, 1)) END "
            f"|| substr(t, 2)), '') END")


def preview(e: str, n: int = 50) -> str:
    return f"CASE WHEN length({e}) > {n} THEN substr({e}, 1, {n}) || '...' ELSE {e} END"


def to_dec(e: str, p: int = 12, s: int = 2) -> str:
    return f"TRY_CAST({e} AS DECIMAL({p},{s}))"


def clip_rating(e: str) -> str:
    x = f"(CASE WHEN isnan(TRY_CAST({e} AS DOUBLE)) THEN NULL ELSE TRY_CAST({e} AS DOUBLE) END)"
    return f"CASE WHEN {x} IS NULL THEN 3.0 ELSE greatest(1.0, least(5.0, {x})) END"


SQL: dict[str, str] = {}

SQL["scan_filter_project"] = """SELECT o_orderkey, o_custkey, round(o_totalprice, 1) AS o_totalprice,
  CAST(o_orderdate AS DATE) AS order_date FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 300000"""

SQL["limited_sql_extract"] = """SELECT o_orderkey, coalesce(o_orderpriority, 'none') AS priority
FROM orders ORDER BY o_orderkey LIMIT 10"""

SQL["lookback_window"] = f"""WITH {ORDERS}
SELECT * FROM orders_s WHERE order_date >= DATE '{RUN_DATE}' - INTERVAL 7 DAY"""

SQL["limited_extract"] = f"""WITH {ORDERS}
SELECT * FROM orders_s ORDER BY order_id LIMIT 10"""

SQL["json_document_scan"] = """SELECT event_id, event_type,
  TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
  json_extract_string(props, '$.missing_field') AS missing_field FROM events"""

SQL["document_preview"] = f"""SELECT doc_id, {preview('text')} AS text, {preview('lang')} AS lang,
  {preview('source')} AS source FROM documents"""

SQL["fill_rules"] = f"""WITH {CUSTOMERS_RAW}
SELECT customer_id, coalesce(city, 'Не указан') AS city, coalesce(country, 'Россия') AS country,
  coalesce(customer_segment, 'Standard') AS customer_segment FROM customers_raw"""

SQL["title_case"] = f"""WITH {CUSTOMERS_RAW}
SELECT customer_id AS id, 'customer' AS kind, {title('first_name')} AS value FROM customers_raw
UNION ALL
SELECT doc_id AS id, 'document' AS kind, {title('text')} AS value FROM documents"""

SQL["email_norm"] = f"""WITH {CUSTOMERS_RAW}
SELECT customer_id, {ustrip('lower(email)')} AS email FROM customers_raw"""

SQL["clean_customers"] = f"""WITH {CUSTOMERS_RAW}
SELECT customer_id, {title('first_name')} AS first_name, {title('last_name')} AS last_name,
  {ustrip('lower(email)')} AS email, coalesce(city, 'Не указан') AS city, coalesce(country, 'Россия') AS country,
  coalesce(customer_segment, 'Standard') AS customer_segment FROM customers_raw"""

_RAW_NUM = """CASE WHEN event_type = 'error' THEN 'abc' WHEN event_type = 'view' THEN 'nan'
  WHEN event_type = 'signup' THEN ' ' || CAST("value" AS VARCHAR) || ' ' ELSE CAST("value" AS VARCHAR) END"""
SQL["coerce_number"] = f"""SELECT event_id, raw, coalesce({to_dec('raw')}, CAST(0 AS DECIMAL(12,2))) AS amount
FROM (SELECT event_id, {_RAW_NUM} AS raw FROM events)"""

SQL["clip_rating"] = f"""WITH {FEEDBACK}
SELECT doc_id, rating_raw, {clip_rating('rating_raw')} AS rating FROM feedback_s"""

SQL["coerce_date"] = f"""SELECT order_id, raw, TRY_CAST(raw AS DATE) AS order_date,
  coalesce(TRY_CAST(raw AS DATE), DATE '{RUN_DATE}') AS load_order_date
FROM (SELECT o_orderkey AS order_id, CASE WHEN o_orderpriority = '3-MEDIUM' THEN '1998-13-01'
  ELSE strftime(o_orderdate, '%Y-%m-%d') END AS raw FROM orders)"""

SQL["truncate_text"] = """SELECT doc_id, substr(text, 1, 500) AS text_500, substr(text, 1, 255) AS text_255,
  substr(source, 1, 100) AS source_100 FROM documents"""

SQL["dedupe_keep_last"] = """SELECT user_id, event_id, ts, event_type, "value" FROM (
  SELECT user_id, event_id, ts, event_type, "value",
    row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC, event_type DESC, "value" DESC) AS rn
  FROM events) WHERE rn = 1"""

SQL["cleaner_stats"] = """WITH e AS (SELECT user_id, event_id, ts,
    CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS event_type FROM events),
k AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC, event_type DESC) AS rn
  FROM e)
SELECT CAST(count(*) AS BIGINT) AS original_rows, CAST(count(*) - count(*) FILTER (WHERE rn = 1) AS BIGINT)
  AS duplicates_removed, CAST(count(*) FILTER (WHERE rn = 1 AND event_type IS NULL) AS BIGINT) AS nulls_filled,
  CAST(count(*) FILTER (WHERE rn = 1) AS BIGINT) AS cleaned_rows FROM k"""

SQL["normalizer_stats"] = """SELECT CAST(count(TRY_CAST(d AS TIMESTAMP)) AS BIGINT) AS dates_normalized,
  CAST(count(p) AS BIGINT) AS strings_normalized, CAST(0 AS BIGINT) AS types_converted
FROM (SELECT CASE WHEN o_orderpriority = '3-MEDIUM' THEN '1998-13-01' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS d,
  o_orderpriority AS p FROM orders)"""

SQL["daily_kpis_simple"] = f"""WITH {ORDERS_CITY}
SELECT order_date AS analytics_date, count(*) AS total_orders,
  CAST(sum(total_amount) AS DECIMAL(22,2)) AS total_revenue,
  CAST(sum(total_amount) AS DOUBLE) / count(total_amount) AS avg_order_value,
  count(DISTINCT customer_id) AS active_customers,
  coalesce(mode() WITHIN GROUP (ORDER BY shipping_city), 'Не указан') AS top_city
FROM orders_c GROUP BY order_date"""

SQL["daily_kpis_final"] = f"""WITH {ORDERS_CITY},
runs AS (SELECT o.*, CAST(r.d AS DATE) AS analytics_date FROM orders_c o,
  unnest(generate_series(CAST(o.order_date AS TIMESTAMP), CAST(o.order_date AS TIMESTAMP) + INTERVAL 7 DAY,
                         INTERVAL 1 DAY)) AS r(d))
SELECT analytics_date, count(*) AS total_orders, CAST(sum(total_amount) AS DECIMAL(22,2)) AS total_revenue,
  CAST(sum(total_amount) AS DOUBLE) / count(*) AS avg_order_value,
  count(DISTINCT customer_id) AS active_customers,
  coalesce(mode() WITHIN GROUP (ORDER BY shipping_city), 'Москва') AS top_city
FROM runs GROUP BY analytics_date"""

SQL["run_kpis"] = f"""WITH {ORDERS_CITY}, {FEEDBACK},
o AS (SELECT * FROM orders_c WHERE order_date >= DATE '{RUN_DATE}' - INTERVAL 7 DAY),
r AS (SELECT {clip_rating('rating_raw')} AS rating FROM feedback_s)
SELECT DATE '{RUN_DATE}' AS analytics_date, (SELECT count(*) FROM o) AS total_orders,
  (SELECT CAST(sum(total_amount) AS DECIMAL(22,2)) FROM o) AS total_revenue,
  (SELECT CAST(sum(total_amount) AS DOUBLE) / count(total_amount) FROM o) AS avg_order_value,
  (SELECT count(DISTINCT customer_id) FROM o) AS active_customers,
  (SELECT coalesce(mode() WITHIN GROUP (ORDER BY shipping_city), 'Не указан') FROM o) AS top_city,
  (SELECT coalesce(avg(rating), 0.0) FROM r) AS avg_customer_rating,
  (SELECT count(*) FILTER (WHERE rating <= 2) FROM r) AS complaint_count
WHERE (SELECT count(*) FROM o) > 0"""

SQL["top_categories"] = f"""WITH {PRODUCTS}
SELECT category, count(*) AS count FROM products_s GROUP BY category ORDER BY count DESC, category LIMIT 3"""

SQL["product_stats"] = f"""WITH {PRODUCTS}
SELECT count(*) AS total_products, CAST(sum(stock_quantity) AS BIGINT) AS total_stock,
  coalesce(CAST(sum(unit_price) AS DOUBLE) / count(unit_price), 0.0) AS avg_price,
  count(DISTINCT category) AS categories_count, count(DISTINCT brand) AS suppliers_count FROM products_s"""

SQL["table_counts"] = """SELECT * FROM (
  SELECT 'customer' AS table_name, count(*) AS row_count FROM customer
  UNION ALL SELECT 'orders', count(*) FROM orders
  UNION ALL SELECT 'lineitem', count(*) FROM lineitem
  UNION ALL SELECT 'part', count(*) FROM part
  UNION ALL SELECT 'documents', count(*) FROM documents
  UNION ALL SELECT 'events', count(*) FROM events)
UNION ALL SELECT 'TOTAL', CAST((SELECT count(*) FROM customer) + (SELECT count(*) FROM orders)
  + (SELECT count(*) FROM lineitem) + (SELECT count(*) FROM part) + (SELECT count(*) FROM documents)
  + (SELECT count(*) FROM events) AS BIGINT)"""

SQL["rating_stats"] = f"""WITH {FEEDBACK},
f AS (SELECT coalesce(TRY_CAST(rating_raw AS INTEGER), 0) AS rating FROM feedback_s)
SELECT count(*) AS feedback_count, coalesce(avg(CAST(rating AS DOUBLE)), 0.0) AS avg_rating,
  coalesce(avg(CAST(rating AS DOUBLE)) FILTER (WHERE rating <> 0), 0.0) AS avg_nonzero_rating FROM f"""

SQL["rating_histogram"] = f"""WITH {FEEDBACK},
c AS (SELECT TRY_CAST(rating_raw AS INTEGER) AS rating, count(*) AS n FROM feedback_s
  WHERE TRY_CAST(rating_raw AS INTEGER) IN (1, 2, 3, 4, 5) GROUP BY 1)
SELECT CAST(b.rating AS INTEGER) AS rating, coalesce(c.n, 0) AS feedback_count
FROM (SELECT unnest(range(1, 6)) AS rating) b LEFT JOIN c ON CAST(b.rating AS INTEGER) = c.rating"""

_RAW_COLS = ["customer_id", "first_name", "last_name", "email", "city", "country", "customer_segment"]
SQL["missing_cells"] = f"""WITH {CUSTOMERS_RAW}
SELECT {', '.join(f'count(*) FILTER (WHERE {c} IS NULL) AS missing_{c}' for c in _RAW_COLS)},
  CAST({' + '.join(f'count(*) FILTER (WHERE {c} IS NULL)' for c in _RAW_COLS)} AS BIGINT) AS missing_total
FROM customers_raw"""

SQL["declared_kpis"] = f"""WITH {ORDERS_CITY}, {ITEMS}, {PRODUCTS},
it AS (SELECT i.order_id, i.product_id, i.quantity, i.total_price, o.order_date, p.product_name, p.category,
  CAST(i.quantity * p.cost_price AS DECIMAL(12,2)) AS cost
  FROM items_s i JOIN orders_c o ON i.order_id = o.order_id JOIN products_s p ON i.product_id = p.product_id),
base AS (SELECT order_date, count(*) AS total_orders,
  count(*) FILTER (WHERE status = 'Pending') AS new_orders,
  count(*) FILTER (WHERE status = 'Cancelled') AS cancelled_orders,
  count(DISTINCT customer_id) AS active_customers,
  count(*) FILTER (WHERE status = 'Delivered') AS delivered,
  count(*) FILTER (WHERE status IN ('Delivered', 'Cancelled', 'Refunded')) AS closed
  FROM orders_c GROUP BY order_date),
firsts AS (SELECT first_date AS order_date, count(*) AS new_customers FROM
  (SELECT customer_id, min(order_date) AS first_date FROM orders_c GROUP BY customer_id) GROUP BY first_date),
city AS (SELECT order_date, CAST(to_json(map_from_entries(list(struct_pack(k := shipping_city, v := n)
  ORDER BY shipping_city, n))) AS VARCHAR) AS orders_by_city
  FROM (SELECT order_date, shipping_city, count(*) AS n FROM orders_c GROUP BY 1, 2) GROUP BY order_date),
money AS (SELECT order_date, CAST(sum(total_price) AS DECIMAL(22,2)) AS rev,
  CAST(sum(cost) AS DECIMAL(22,2)) AS total_cost FROM it GROUP BY order_date),
prod AS (SELECT order_date, arg_max(product_id, (rev, -product_id)) AS top_product_id,
  arg_max(product_name, (rev, -product_id)) AS top_product_name, max(rev) AS top_product_revenue
  FROM (SELECT order_date, product_id, product_name, CAST(sum(total_price) AS DECIMAL(22,2)) AS rev
        FROM it GROUP BY 1, 2, 3) GROUP BY order_date),
cat AS (SELECT order_date, arg_min(category, (-rev, category)) AS top_category,
  CAST(to_json(map_from_entries(list(struct_pack(k := category, v := CAST(rev AS VARCHAR)) ORDER BY category, rev)))
    AS VARCHAR) AS revenue_by_category
  FROM (SELECT order_date, category, CAST(sum(total_price) AS DECIMAL(22,2)) AS rev FROM it GROUP BY 1, 2)
  GROUP BY order_date)
SELECT b.order_date AS analytics_date, b.total_orders, b.new_orders, b.cancelled_orders,
  coalesce(m.total_cost, CAST(0 AS DECIMAL(22,2))) AS total_cost,
  coalesce(CAST(m.rev - m.total_cost AS DECIMAL(22,2)), CAST(0 AS DECIMAL(22,2))) AS total_profit,
  round(CAST(CAST(m.rev - m.total_cost AS DECIMAL(22,2)) AS DOUBLE) / nullif(CAST(m.rev AS DOUBLE), 0) * 100, 2)
    AS profit_margin,
  b.active_customers, coalesce(f.new_customers, 0) AS new_customers,
  b.active_customers - coalesce(f.new_customers, 0) AS returning_customers,
  p.top_product_id, p.top_product_name, p.top_product_revenue, c.orders_by_city, k.top_category,
  k.revenue_by_category, CAST(NULL AS DECIMAL(5,2)) AS avg_delivery_time_hours,
  round(CAST(b.delivered AS DOUBLE) / nullif(CAST(b.closed AS DOUBLE), 0) * 100, 2) AS delivery_success_rate
FROM base b LEFT JOIN firsts f ON b.order_date = f.order_date LEFT JOIN city c ON b.order_date = c.order_date
  LEFT JOIN money m ON b.order_date = m.order_date LEFT JOIN prod p ON b.order_date = p.order_date
  LEFT JOIN cat k ON b.order_date = k.order_date"""


def oracle_sql() -> dict[str, str]:
    from vitrina.plans import oracle_dw  # noqa: F401  (adds the warehouse queries)
    return dict(SQL)
