"""The registered queries as SQL for DuckDB, on views named like the tables.

Written from the meaning of each query, with plain joins and windows, not from the Spark plans.
"""

from __future__ import annotations

from depotstar.operators.reshape import SOURCE_ORDERS, SOURCE_SHIPPING
from depotstar.plans.retail_oracle import audit_sql
from depotstar.sources.retail import SOURCES

_ITEM_ID = (
    "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, "
    "strftime(l_shipdate, '%Y-%m-%d'))"
)
_TYPE = (
    "CASE p_type WHEN 'ECONOMY' THEN 1 WHEN 'LARGE' THEN 2 WHEN 'MEDIUM' THEN 3 "
    "WHEN 'PROMO' THEN 4 WHEN 'SMALL' THEN 5 WHEN 'STANDARD' THEN 6 END"
)
_STATUS = (
    "CASE l_returnflag WHEN 'A' THEN 'Advance shipping' WHEN 'N' THEN 'Shipping on time' "
    "WHEN 'R' THEN 'Late delivery' END"
)

# Staging tables as common table expressions.
_ORDERS = """
stg_orders AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, o_custkey AS customer_id,
         c_name AS customer_fname, CAST(NULL AS VARCHAR) AS customer_lname,
         c_mktsegment AS customer_segment, n_name AS order_city, n_name AS order_state,
         r_name AS order_country, CAST(o_orderdate AS DATE) AS order_date,
         o_orderstatus AS order_status
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey
       LEFT JOIN nation ON c_nationkey = n_nationkey
       LEFT JOIN region ON n_regionkey = r_regionkey
)"""
_ITEMS = f"""
priced AS (
  SELECT *, CAST(l_extendedprice AS DECIMAL(10,2)) AS sales,
         CAST(p_retailprice AS DECIMAL(10,2)) AS product_price,
         CAST(l_discount AS DECIMAL(5,2)) AS discount_rate,
         CAST(l_quantity AS INTEGER) AS quantity
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
),
discounted AS (
  SELECT *, CAST(sales * discount_rate AS DECIMAL(10,2)) AS discount FROM priced
),
valued AS (
  SELECT *, CAST(sales - discount - product_price * quantity AS DECIMAL(10,2)) AS profit
  FROM discounted
),
stg_items AS (
  SELECT {_ITEM_ID} AS order_item_id, CAST(l_orderkey AS VARCHAR) AS order_id,
         l_partkey AS product_id, CAST(l_partkey AS VARCHAR) AS product_card_id,
         p_name AS product_name, product_price, quantity, sales, discount, profit, discount_rate,
         CAST(floor(CAST(profit AS DOUBLE) / CAST(sales AS DOUBLE) * 100 + 0.5) / 100
              AS DECIMAL(5,2)) AS profit_ratio,
         CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS BIGINT) * 10 + {_TYPE} AS category_id,
         concat_ws(' ', p_brand, p_type) AS category_name,
         CAST({_TYPE} AS BIGINT) AS department_id, p_type AS department_name,
         l_linestatus, l_returnflag, l_orderkey, l_shipdate
  FROM valued
)"""
_SHIPMENTS = f"""
stg_shipments AS (
  SELECT {_ITEM_ID} AS shipment_id, CAST(l_orderkey AS VARCHAR) AS order_id,
         o_orderpriority AS shipping_mode, CAST(l_shipdate AS DATE) AS ship_date,
         {_STATUS} AS delivery_status,
         CASE WHEN l_linestatus = 'O' THEN '1' ELSE '0' END AS delivery_risk,
         n_name AS ship_city, n_name AS ship_state, r_name AS ship_country,
         CASE WHEN s_nationkey % 5 <> 0 THEN CAST(s_nationkey * 1.5 - 20 AS DECIMAL(10,6)) END
           AS latitude,
         CASE WHEN s_nationkey % 5 <> 0 THEN CAST(s_nationkey * 2.25 - 30 AS DECIMAL(10,6)) END
           AS longitude
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
       LEFT JOIN supplier ON l_suppkey = s_suppkey
       LEFT JOIN nation ON s_nationkey = n_nationkey
       LEFT JOIN region ON n_regionkey = r_regionkey
)"""
_STAGING = f"{_ORDERS},{_ITEMS},{_SHIPMENTS}"

# Dimensions, numbered in natural key order.
_DEPARTMENT = """
dim_department AS (
  SELECT row_number() OVER (ORDER BY department_id NULLS FIRST, department_name NULLS FIRST)
           AS department_key, department_id, department_name
  FROM (SELECT DISTINCT department_id, department_name FROM stg_items
        WHERE department_id IS NOT NULL)
)"""
_CATEGORY = """
dim_category AS (
  SELECT row_number() OVER (ORDER BY category_id NULLS FIRST, category_name NULLS FIRST,
                            department_key NULLS FIRST) AS category_key,
         category_id, category_name, department_key
  FROM (SELECT DISTINCT s.category_id, s.category_name, d.department_key
        FROM stg_items s LEFT JOIN dim_department d ON s.department_id = d.department_id
        WHERE s.category_id IS NOT NULL)
)"""
_PRODUCT = """
dim_product AS (
  SELECT row_number() OVER (ORDER BY product_id NULLS FIRST, product_name NULLS FIRST,
                            product_card_id NULLS FIRST, product_price NULLS FIRST,
                            category_key NULLS FIRST) AS product_key,
         category_key, product_id, product_name, product_card_id, product_price
  FROM (SELECT DISTINCT s.product_id, s.product_name, s.product_card_id, s.product_price,
               c.category_key
        FROM stg_items s LEFT JOIN dim_category c ON s.category_id = c.category_id
        WHERE s.product_id IS NOT NULL)
)"""
_CUSTOMER = """
dim_customer AS (
  SELECT row_number() OVER (ORDER BY customer_id NULLS FIRST, customer_fname NULLS FIRST,
                            customer_lname NULLS FIRST, customer_segment NULLS FIRST,
                            order_city NULLS FIRST, order_state NULLS FIRST,
                            order_country NULLS FIRST) AS customer_key,
         customer_id, customer_fname, customer_lname, customer_segment,
         order_city AS customer_city, order_state AS customer_state,
         order_country AS customer_country
  FROM (SELECT DISTINCT customer_id, customer_fname, customer_lname, customer_segment, order_city,
               order_state, order_country FROM stg_orders)
)"""
_GEOGRAPHY = """
dim_geography AS (
  SELECT row_number() OVER (ORDER BY city NULLS FIRST, state NULLS FIRST, country NULLS FIRST,
                            latitude NULLS FIRST, longitude NULLS FIRST) AS geography_key,
         city, state, country, latitude, longitude
  FROM (SELECT order_city AS city, order_state AS state, order_country AS country,
               CAST(NULL AS DECIMAL(10,6)) AS latitude, CAST(NULL AS DECIMAL(10,6)) AS longitude
        FROM stg_orders WHERE order_city IS NOT NULL
        UNION
        SELECT ship_city, ship_state, ship_country, latitude, longitude
        FROM stg_shipments WHERE ship_city IS NOT NULL)
)"""
_DATE = """
dim_date AS (
  SELECT row_number() OVER (ORDER BY full_date) AS date_key, full_date,
         CAST(isodow(full_date) AS INTEGER) AS day_of_week,
         CAST(month(full_date) AS INTEGER) AS month_number,
         CAST(quarter(full_date) AS INTEGER) AS quarter_number,
         CAST(year(full_date) AS INTEGER) AS year,
         isodow(full_date) IN (6, 7) AS is_weekend
  FROM (SELECT order_date AS full_date FROM stg_orders
        UNION SELECT ship_date FROM stg_shipments) WHERE full_date IS NOT NULL
)"""
_SHIPPING = """
dim_shipping AS (
  SELECT row_number() OVER (ORDER BY shipping_mode NULLS FIRST, delivery_status NULLS FIRST,
                            delivery_risk NULLS FIRST) AS shipping_key,
         shipping_mode, delivery_status, delivery_risk
  FROM (SELECT DISTINCT shipping_mode, delivery_status, delivery_risk FROM stg_shipments
        WHERE shipping_mode IS NOT NULL OR delivery_status IS NOT NULL
           OR delivery_risk IS NOT NULL)
)"""
_PRODUCT_CHAIN = f"{_DEPARTMENT},{_CATEGORY},{_PRODUCT}"
_DIMS = f"{_PRODUCT_CHAIN},{_CUSTOMER},{_GEOGRAPHY},{_DATE},{_SHIPPING}"

# Each order line with everything the star leads to; one row per line.
_LINES = """
lines AS (
  SELECT i.*, o.customer_id, o.order_date, o.order_status, o.order_city, o.order_country,
         s.shipping_mode, s.delivery_status, s.delivery_risk, s.ship_date
  FROM stg_items i LEFT JOIN stg_orders o ON i.order_id = o.order_id
       LEFT JOIN stg_shipments s ON i.order_item_id = s.shipment_id
)"""
_MEASURES = """
CAST(count(*) AS BIGINT) AS lines, CAST(sum(quantity) AS BIGINT) AS quantity,
CAST(sum(sales) AS DOUBLE) AS sales, CAST(sum(discount) AS DOUBLE) AS discount,
CAST(sum(profit) AS DOUBLE) AS profit"""


def _percent(part: str, whole: str, places: int = 2) -> str:
    scale = 10**places
    ratio = f"CAST({part} AS DOUBLE) / CAST({whole} AS DOUBLE) * 100"
    return f"round_even({ratio} * {scale}, 0) / {scale}"


_NOW = "'2024-01-01 00:00:00'"
_TOTAL_SALES = "(SELECT sum(CAST(l_extendedprice AS DECIMAL(10,2))) FROM lineitem)"
_PRODUCT_SALES = """
product_sales AS (
  SELECT p_name AS product_name, sum(CAST(l_extendedprice AS DECIMAL(10,2))) AS total
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_name
),
top AS (SELECT * FROM product_sales ORDER BY total DESC, product_name LIMIT 5)"""

# The untidy orders, and the same cleansed.
_DIRTY = """
copies AS (
  SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderkey % 10 = 0
),
dirty AS (
  SELECT CASE WHEN o_orderkey % 97 <> 0 THEN CAST(o_orderkey AS VARCHAR) END AS order_id,
         CASE WHEN o_orderkey % 89 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS customer_id,
         ' Customer ' || o_custkey || chr(9) AS customer_fname,
         CASE WHEN o_orderkey % 2 = 0 THEN 'XXXXXXXXX'
              ELSE 'c' || o_custkey || '@example.com' END AS customer_email,
         'XXXXXXXXX' AS customer_password,
         CASE WHEN o_orderkey % 83 <> 0 THEN '  ' || o_orderpriority END AS product_name,
         CASE WHEN o_orderkey % 53 = 0 THEN 'x' WHEN o_orderkey % 59 = 0 THEN '-5'
              WHEN o_orderkey % 61 = 0 THEN ' 1e3 ' WHEN o_orderkey % 67 = 0 THEN NULL
              ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) END AS sales,
         CASE WHEN o_orderkey % 71 = 0 THEN '-1'
              ELSE CAST(o_orderkey % 7 AS VARCHAR) END AS order_item_quantity,
         CASE WHEN o_orderkey % 73 = 0 THEN '31/12/2018 1:00' WHEN o_orderkey % 79 = 0 THEN NULL
              ELSE strftime(o_orderdate, '%-m/%-d/%Y %-H:%M') END AS order_date_dateorders,
         o_orderstatus || ' ' AS delivery_status
  FROM copies
)"""
_CLEANED = f"""{_DIRTY},
tidy AS (
  SELECT DISTINCT order_id, customer_id, trim(customer_fname, ' ' || chr(9)) AS customer_fname,
         nullif(customer_email, 'XXXXXXXXX') AS customer_email,
         nullif(customer_password, 'XXXXXXXXX') AS customer_password,
         trim(product_name) AS product_name,
         TRY_CAST(trim(sales) AS DOUBLE) AS sales,
         TRY_CAST(order_item_quantity AS DOUBLE) AS order_item_quantity,
         try_strptime(order_date_dateorders, '%m/%d/%Y %H:%M') AS order_date_dateorders,
         trim(delivery_status) AS delivery_status,
         order_id AS raw_order, sales AS raw_sales
  FROM dirty
),
cleaned AS (
  SELECT * EXCLUDE (raw_order, raw_sales),
         100 - CASE WHEN order_id IS NULL THEN 25 ELSE 0 END
             - CASE WHEN customer_id IS NULL THEN 25 ELSE 0 END
             - CASE WHEN product_name IS NULL THEN 25 ELSE 0 END
             - CASE WHEN sales IS NULL THEN 25 ELSE 0 END AS data_quality_score
  FROM tidy
)"""
_CHECKS = """
checks AS (
  SELECT 'Empty Columns' AS check_name, 'error' AS severity, false AS passed, 1.0 AS observed
  UNION ALL SELECT 'Critical Field ''Order Id''', 'error', count(*) = 0, count(*)
            FROM cleaned WHERE order_id IS NULL
  UNION ALL SELECT 'Critical Field ''Customer Id''', 'error', count(*) = 0, count(*)
            FROM cleaned WHERE customer_id IS NULL
  UNION ALL SELECT 'Critical Field ''Product Name''', 'error', count(*) = 0, count(*)
            FROM cleaned WHERE product_name IS NULL
  UNION ALL SELECT 'Critical Field ''Sales''', 'error', count(*) = 0, count(*)
            FROM cleaned WHERE sales IS NULL
  UNION ALL SELECT 'Masked ''Customer Email''', 'error', count(*) = 0, count(*)
            FROM cleaned WHERE contains(customer_email, 'XXXXXXXXX')
  UNION ALL SELECT 'Masked ''Customer Password''', 'error', count(*) = 0, count(*)
            FROM cleaned WHERE contains(customer_password, 'XXXXXXXXX')
  UNION ALL SELECT 'Non-negative ''Sales''', 'warning', count(*) = 0, count(*)
            FROM cleaned WHERE sales < 0
  UNION ALL SELECT 'Non-negative ''Order Item Quantity''', 'warning', count(*) = 0, count(*)
            FROM cleaned WHERE order_item_quantity < 0
  UNION ALL SELECT 'Data Quality Score', 'warning', avg(data_quality_score) >= 80,
                   round(avg(data_quality_score), 6) FROM cleaned
  UNION ALL SELECT 'Duplicates', 'error', count(*) = 0, count(*) FROM
            (SELECT * FROM cleaned GROUP BY ALL HAVING count(*) > 1)
)"""

_DIRTY_NAMES = {
    "Order Id": "order_id", "Customer Id": "customer_id", "Customer Fname": "customer_fname",
    "Customer Email": "customer_email", "Customer Password": "customer_password",
    "Product Name": "product_name", "Sales": "sales",
    "Order Item Quantity": "order_item_quantity",
    "order date (DateOrders)": "order_date_dateorders", "Delivery Status": "delivery_status",
    "Unnamed: 3": "NULL", "Empty": "NULL",
}
_MISSING = " UNION ALL ".join(
    f"SELECT '{name}' AS column_name, count(*) - count({c}) AS missing, count(*) AS n FROM dirty"
    for name, c in _DIRTY_NAMES.items()
)


def _numeric_summary(column: str) -> str:
    return f"""
SELECT '{column}' AS column_name, count({column}) AS n, round(avg({column}), 3) AS mean,
       round(stddev_samp({column}), 3) AS std, min({column}) AS min,
       round(quantile_cont({column}, 0.25), 3) AS q25,
       round(quantile_cont({column}, 0.5), 3) AS q50,
       round(quantile_cont({column}, 0.75), 3) AS q75, max({column}) AS max
FROM lineitem"""


def _text_summary(name: str, query: str) -> str:
    return f"""
SELECT '{name}' AS column_name, CAST(sum(k) AS BIGINT) AS n, count(*) AS distinct_values,
       arg_min(v, (-k, v)) AS top, max(k) AS freq
FROM (SELECT v, count(*) AS k FROM ({query}) WHERE v IS NOT NULL GROUP BY v)"""


def _warning(name: str, column: str, kind: str, test: str) -> str:
    return f"""
SELECT '{name}' AS column_name, '{kind}' AS kind, count(*) AS n FROM cleaned
WHERE {column} {test}"""


# Audits.


def _count(table: str, rule: str, kind: str, source: str, test: str) -> str:
    rule = rule.replace("'", "''")
    return (
        f"SELECT '{table}' AS table_name, '{rule}' AS rule, '{kind}' AS kind, "
        f"count(*) AS violations FROM {source} WHERE {test}"
    )


def _unique(table: str, source: str, key: list[str]) -> str:
    columns = ", ".join(key)
    present = " AND ".join(f"{k} IS NOT NULL" for k in key)
    return (
        f"SELECT '{table}' AS table_name, '{columns}' AS rule, 'UNIQUE' AS kind, "
        f"count(*) - (SELECT count(*) FROM (SELECT DISTINCT {columns} FROM {source} "
        f"WHERE {present})) AS violations FROM {source} WHERE {present}"
    )


def _orphans(
    table: str, column: str, parent: str, key: str, child_sql: str, parent_sql: str
) -> str:
    return _count(
        table, f"{column} -> {parent}.{key}", "FOREIGN KEY", f"{child_sql} AS child",
        f"{column} IS NOT NULL AND NOT EXISTS "
        f"(SELECT 1 FROM {parent_sql} AS parent WHERE parent.{key} = child.{column})",
    )


_RETAIL = ",\n".join(
    f'"R_{name}" AS (SELECT {", ".join(columns)} FROM {base})'
    for name, (base, columns) in SOURCES.items()
)


def _retail_audit() -> str:
    return f"WITH {_RETAIL}\n{audit_sql(SOURCES)}"


_STAR_FKS = "\nUNION ALL\n".join(
    f"SELECT 'order_items', '{rule}', 'FOREIGN KEY', 0"
    for rule in [
        "customer_key -> dim_customer.customer_key",
        "order_date_key -> dim_date.date_key",
        "shipping_date_key -> dim_date.date_key",
        "customer_geography_key -> dim_geography.geography_key",
        "order_geography_key -> dim_geography.geography_key",
        "shipping_key -> dim_shipping.shipping_key",
        "product_key -> dim_product.product_key",
    ]
)
_DEBT = "(SELECT customer_id FROM \"R_CUSTOMER\" WHERE total_points < 0)"
_FIRST_LINE = """
SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey
                               ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate) AS rn
  FROM lineitem) WHERE rn = 1"""

ORACLE: dict[str, str] = {
    "stg_orders": f"""
WITH {_ORDERS}
SELECT * REPLACE (CAST(order_date AS VARCHAR) AS order_date), {_NOW} AS load_timestamp,
       'OMS' AS source_system FROM stg_orders""",
    "stg_order_items": f"""
WITH {_ITEMS}
SELECT order_item_id, order_id, product_id, product_card_id, product_name,
       CAST(product_price AS DOUBLE) AS product_price, quantity, CAST(sales AS DOUBLE) AS sales,
       CAST(discount AS DOUBLE) AS discount, CAST(profit AS DOUBLE) AS profit,
       CAST(discount_rate AS DOUBLE) AS discount_rate, CAST(profit_ratio AS DOUBLE) AS profit_ratio,
       category_id, category_name, department_id, department_name, {_NOW} AS load_timestamp,
       'OMS' AS source_system FROM stg_items""",
    "stg_shipments": f"""
WITH {_SHIPMENTS}
SELECT shipment_id, order_id, shipping_mode, CAST(ship_date AS VARCHAR) AS ship_date,
       CAST(NULL AS VARCHAR) AS delivery_date, delivery_status, delivery_risk, ship_city,
       ship_state, ship_country, CAST(latitude AS DOUBLE) AS latitude,
       CAST(longitude AS DOUBLE) AS longitude, {_NOW} AS load_timestamp,
       'SLMS' AS source_system FROM stg_shipments""",
    "load_defaults": f"""
SELECT CAST(c_custkey AS INTEGER) AS customer_id, '+' || c_custkey AS phone_number,
       c_name AS full_name, CAST(NULL AS VARCHAR) AS email, 'Silver' AS membership_tier,
       0 AS total_points, {_NOW} AS registered_at, {_NOW} AS updated_at FROM customer""",
    "split_services": """
SELECT CAST(l_orderkey AS VARCHAR) AS order_id, count(*) AS lines,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(10,2))) AS DOUBLE) AS sales,
       count(*) AS shipments, count(*) FILTER (WHERE l_linestatus = 'O') AS late_shipments,
       CAST(CAST(max(l_shipdate) AS DATE) AS VARCHAR) AS last_ship_date
FROM lineitem GROUP BY l_orderkey""",
    "dim_department": f"WITH {_ITEMS},{_DEPARTMENT} SELECT * FROM dim_department",
    "dim_category": f"WITH {_ITEMS},{_DEPARTMENT},{_CATEGORY} SELECT * FROM dim_category",
    "dim_product": f"""
WITH {_ITEMS},{_PRODUCT_CHAIN}
SELECT product_key, category_key, product_id, product_name, product_card_id,
       CAST(product_price AS DOUBLE) AS product_price, CAST(NULL AS VARCHAR) AS product_image
FROM dim_product""",
    "dim_customer": f"WITH {_ORDERS},{_CUSTOMER} SELECT * FROM dim_customer",
    "dim_geography": f"""
WITH {_ORDERS},{_SHIPMENTS},{_GEOGRAPHY}
SELECT geography_key, city, state, country, CAST(NULL AS VARCHAR) AS region,
       CAST(NULL AS VARCHAR) AS market, CAST(latitude AS DOUBLE) AS latitude,
       CAST(longitude AS DOUBLE) AS longitude FROM dim_geography""",
    "dim_date": f"""
WITH {_ORDERS},{_SHIPMENTS},{_DATE}
SELECT * REPLACE (CAST(full_date AS VARCHAR) AS full_date) FROM dim_date""",
    "dim_shipping": f"WITH {_SHIPMENTS},{_SHIPPING} SELECT * FROM dim_shipping",
    "surrogate_keys": """
SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate)
         AS line_key, l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CAST(l_shipdate AS VARCHAR) AS l_shipdate
FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey,
             CAST(l_shipdate AS DATE) AS l_shipdate FROM lineitem)""",
    "fact_one_match": f"""
WITH {_STAGING},{_LINES},
known AS (
  SELECT ship_city AS city, min(latitude) AS latitude, arg_min(longitude, latitude) AS longitude
  FROM stg_shipments WHERE latitude IS NOT NULL GROUP BY ship_city
)
SELECT order_item_id, customer_id AS customer_customer_id, product_id AS product_product_id,
       category_name AS product_category_name, department_name AS product_department_name,
       CAST(order_date AS VARCHAR) AS order_date_full_date,
       CAST(ship_date AS VARCHAR) AS ship_date_full_date, order_city AS customer_geography_city,
       CAST(latitude AS DOUBLE) AS customer_geography_latitude,
       order_city AS order_geography_city, CAST(latitude AS DOUBLE) AS order_geography_latitude,
       CAST(longitude AS DOUBLE) AS order_geography_longitude,
       shipping_mode AS shipping_shipping_mode, delivery_status AS shipping_delivery_status,
       delivery_risk AS shipping_delivery_risk, quantity AS order_item_quantity,
       CAST(sales AS DOUBLE) AS sales, CAST(discount AS DOUBLE) AS order_item_discount,
       CAST(profit AS DOUBLE) AS order_item_profit,
       CAST(discount_rate AS DOUBLE) AS order_item_discount_rate,
       CAST(profit_ratio AS DOUBLE) AS order_item_profit_ratio
FROM lines LEFT JOIN known ON order_city = city""",
    "fact_as_written": f"""
WITH {_STAGING},{_DIMS}
SELECT sh.shipping_mode, o.order_status, count(*) AS fact_rows,
       CAST(sum(i.quantity) AS BIGINT) AS quantity, CAST(sum(i.sales) AS DOUBLE) AS sales,
       CAST(sum(i.discount) AS DOUBLE) AS discount, CAST(sum(i.profit) AS DOUBLE) AS profit
FROM stg_items i
LEFT JOIN stg_orders o ON i.order_id = o.order_id
LEFT JOIN stg_shipments sh ON i.order_item_id = sh.shipment_id
LEFT JOIN dim_customer c ON o.customer_id = c.customer_id
LEFT JOIN dim_product p ON i.product_id = p.product_id
LEFT JOIN dim_date od ON o.order_date = od.full_date
LEFT JOIN dim_date sd ON sh.ship_date = sd.full_date
LEFT JOIN dim_geography cg ON c.customer_city = cg.city AND c.customer_state = cg.state
     AND c.customer_country = cg.country
LEFT JOIN dim_geography og ON o.order_city = og.city AND o.order_state = og.state
     AND o.order_country = og.country
LEFT JOIN dim_shipping s ON sh.shipping_mode = s.shipping_mode
     AND sh.delivery_status = s.delivery_status AND sh.delivery_risk = s.delivery_risk
GROUP BY ALL""",
    "fact_fanout": f"""
WITH {_STAGING},{_DIMS},
counts AS (
  SELECT 'customer' AS lookup, count(*) AS n FROM dim_customer
    WHERE customer_id IS NOT NULL GROUP BY customer_id
  UNION ALL SELECT 'product', count(*) FROM dim_product GROUP BY product_id
  UNION ALL SELECT 'category', count(*) FROM dim_category GROUP BY category_id
  UNION ALL SELECT 'department', count(*) FROM dim_department GROUP BY department_id
  UNION ALL SELECT 'date', count(*) FROM dim_date GROUP BY full_date
  UNION ALL SELECT 'geography', count(*) FROM dim_geography
    WHERE state IS NOT NULL AND country IS NOT NULL GROUP BY city, state, country
  UNION ALL SELECT 'shipping', count(*) FROM dim_shipping
    WHERE shipping_mode IS NOT NULL AND delivery_status IS NOT NULL
      AND delivery_risk IS NOT NULL GROUP BY shipping_mode, delivery_status, delivery_risk
  UNION ALL SELECT 'category_by_brand', count(*) FROM
    (SELECT DISTINCT p_brand, p_type FROM lineitem JOIN part ON l_partkey = p_partkey)
    GROUP BY p_brand
)
SELECT lookup, count(*) AS lookup_keys, count(*) FILTER (WHERE n > 1) AS repeated_keys,
       max(n) AS most_rows FROM counts GROUP BY lookup""",
    "star_revenue": f"""
WITH {_STAGING},{_LINES}
SELECT department_name, CAST(year(order_date) AS INTEGER) AS year, {_MEASURES}
FROM lines GROUP BY 1, 2""",
    "star_products": f"""
WITH {_STAGING},{_LINES}
SELECT product_name, {_MEASURES}, {_percent("sum(profit)", "sum(sales)")} AS margin_pct
FROM lines GROUP BY 1""",
    "star_calendar": f"""
WITH {_STAGING},{_LINES}
SELECT CAST(year(order_date) AS INTEGER) AS year, CAST(month(order_date) AS INTEGER) AS month,
       isodow(ship_date) IN (6, 7) AS ship_weekend, {_MEASURES}
FROM lines GROUP BY 1, 2, 3""",
    "star_filtered": f"""
WITH {_STAGING},{_LINES}
SELECT order_country AS country, CAST(quarter(order_date) AS INTEGER) AS quarter, {_MEASURES}
FROM lines
WHERE department_name = 'PROMO' AND shipping_mode IN ('1-URGENT', '2-HIGH')
  AND contains(lower(category_name), 'brand#1') AND year(order_date) BETWEEN 1996 AND 1998
GROUP BY 1, 2""",
    "star_entitled": f"""
WITH {_STAGING},{_LINES}
SELECT order_country AS country, {_MEASURES} FROM lines
WHERE order_country LIKE 'A%' GROUP BY 1""",
    "late_by_mode": f"""
SELECT o_orderpriority AS shipping_mode, count(*) AS lines,
       count(*) FILTER (WHERE l_linestatus = 'O') AS late_lines,
       {_percent("count(*) FILTER (WHERE l_linestatus = 'O')", "count(*)")} AS late_pct
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""",
    "discount_effect": f"""
WITH {_ITEMS}
SELECT CAST(discount_rate AS DOUBLE) AS order_item_discount_rate, count(*) AS lines,
       CAST(sum(sales) AS DOUBLE) AS sales, CAST(sum(profit) AS DOUBLE) AS profit,
       {_percent("sum(profit)", "sum(sales)")} AS margin_pct
FROM stg_items GROUP BY 1""",
    "eda_totals": f"""
WITH {_ITEMS}
SELECT CAST(sum(sales) AS DOUBLE) AS total_revenue,
       round(CAST(sum(sales) AS DOUBLE) / count(*), 6) AS mean_line_sales,
       CAST(sum(profit) AS DOUBLE) AS total_profit,
       {_percent("sum(profit)", "sum(sales)")} AS margin_pct
FROM stg_items""",
    "eda_top_products": f"""
WITH {_PRODUCT_SALES} SELECT product_name, CAST(total AS DOUBLE) AS total FROM top""",
    "eda_top_contribution": f"""
WITH {_PRODUCT_SALES}
SELECT CAST(sum(total) AS DOUBLE) AS top_sales, {_percent("sum(total)", _TOTAL_SALES)} AS share_pct
FROM top""",
    "eda_status_share": f"""
SELECT {_STATUS} AS value, count(*) AS n,
       count(*) / CAST((SELECT count(*) FROM lineitem) AS DOUBLE) * 100 AS pct
FROM lineitem GROUP BY 1""",
    "eda_late_risk": """
SELECT CAST(count(*) FILTER (WHERE l_linestatus = 'O') AS DOUBLE) / count(*) * 100 AS late_pct
FROM lineitem""",
    "eda_market_sales": """
SELECT r_name AS market, CAST(sum(CAST(l_extendedprice AS DECIMAL(10,2))) AS DOUBLE) AS total
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
     JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
GROUP BY r_name""",
    "describe_numeric": " UNION ALL ".join(
        map(_numeric_summary, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    ),
    "describe_categorical": " UNION ALL ".join(
        [
            _text_summary(
                "Product Name",
                "SELECT p_name AS v FROM lineitem JOIN part ON l_partkey = p_partkey",
            ),
            _text_summary("Delivery Status", f"SELECT {_STATUS} AS v FROM lineitem"),
            _text_summary(
                "Shipping Mode",
                "SELECT o_orderpriority AS v FROM lineitem "
                "LEFT JOIN orders ON l_orderkey = o_orderkey",
            ),
        ]
    ),
    "null_profile": f"""
WITH {_DIRTY}
SELECT column_name, missing, {_percent("missing", "n")} AS missing_pct
FROM ({_MISSING}) WHERE missing > 0""",
    "frame_shape": f"""
WITH {_DIRTY}
SELECT max(n) AS n_rows, {len(_DIRTY_NAMES)} AS n_columns,
       CAST(sum(missing) AS BIGINT) AS missing_cells FROM ({_MISSING})""",
    "impute": f"""
WITH {_DIRTY},
typed AS (
  SELECT order_id, customer_id, TRY_CAST(trim(sales) AS DOUBLE) AS sales,
         trim(product_name) AS product_name FROM dirty
)
SELECT order_id, customer_id,
       coalesce(sales, (SELECT quantile_cont(sales, 0.5) FROM typed)) AS sales,
       coalesce(product_name, (SELECT product_name FROM typed WHERE product_name IS NOT NULL
                GROUP BY product_name ORDER BY count(*) DESC, product_name LIMIT 1))
         AS product_name
FROM typed""",
    "clean_orders": f"""
WITH {_CLEANED}
SELECT * REPLACE (strftime(order_date_dateorders, '%Y-%m-%d %H:%M:%S') AS order_date_dateorders),
       {_NOW} AS cleansing_timestamp, 'supply_chain' AS record_source FROM cleaned""",
    "dedupe_rows": f"""
WITH {_DIRTY}
SELECT (SELECT count(*) FROM dirty) - count(*) AS duplicate_rows,
       (SELECT count(*) FROM dirty) AS n_rows, count(*) AS distinct_rows
FROM (SELECT DISTINCT * FROM dirty)""",
    "dedupe_keep_first": f"""
SELECT l_orderkey, l_partkey AS partkey, l_suppkey AS suppkey, l_quantity, l_extendedprice
FROM ({_FIRST_LINE})""",
    "status_counts": f"""
WITH {_CLEANED} SELECT delivery_status AS value, count(*) AS n FROM cleaned GROUP BY 1""",
    "quality_score": f"""
WITH {_CLEANED}
SELECT data_quality_score, count(*) AS n,
       count(*) / CAST((SELECT count(*) FROM cleaned) AS DOUBLE) * 100 AS pct
FROM cleaned GROUP BY 1""",
    "cleaning_report": f"""
WITH {_CLEANED}
SELECT (SELECT count(*) FROM dirty) AS total_rows_original, count(*) AS total_rows_cleaned,
       (SELECT count(*) FROM dirty) - count(*) AS duplicates_removed,
       CAST(10 * count(*) - count(order_id) - count(customer_id) - count(customer_fname)
            - count(customer_email) - count(customer_password) - count(product_name)
            - count(sales) - count(order_item_quantity) - count(order_date_dateorders)
            - count(delivery_status) AS BIGINT) AS missing_cells,
       'Empty,Unnamed: 3' AS columns_dropped
FROM cleaned""",
    "cleaning_warnings": f"WITH {_CLEANED}"
    + " UNION ALL ".join(
        [
            _warning("Sales", "sales", "negative", "< 0"),
            _warning("Order Item Quantity", "order_item_quantity", "negative", "< 0"),
            _warning(
                "order date (DateOrders)", "order_date_dateorders", "invalid date", "IS NULL"
            ),
        ]
    ),
    "validation_checks": f"""
WITH {_CLEANED},{_CHECKS}
SELECT check_name, severity, passed, CAST(observed AS DOUBLE) AS observed FROM checks""",
    "validation_verdict": f"""
WITH {_CLEANED},{_CHECKS}
SELECT count(*) FILTER (WHERE passed) AS passed,
       count(*) FILTER (WHERE NOT passed AND severity = 'error') AS failed,
       count(*) FILTER (WHERE NOT passed AND severity = 'warning') AS warnings,
       count(*) FILTER (WHERE NOT passed AND severity = 'error') = 0 AS ready,
       (SELECT count(*) FROM cleaned WHERE data_quality_score = 100) AS perfect_records
FROM checks""",
    "fk_audit": " UNION ALL ".join(
        [
            _orphans("lineitem", "l_orderkey", "orders", "o_orderkey", "lineitem", "orders"),
            _orphans("lineitem", "l_partkey", "small_part", "p_partkey", "lineitem",
                     "(SELECT * FROM part WHERE p_size <= 25)"),
            _orphans("orders", "o_custkey", "solvent_customer", "c_custkey", "orders",
                     "(SELECT * FROM customer WHERE c_acctbal >= 0)"),
            _count("order_items", "customer_key -> some_customers.customer_key", "FOREIGN KEY",
                   "lineitem JOIN orders ON l_orderkey = o_orderkey", "o_custkey % 5 = 0"),
            _STAR_FKS,
        ]
    ),
    "check_audit": f"WITH {_ORDERS}, dated AS (SELECT * FROM lineitem LEFT JOIN orders "
    "ON l_orderkey = o_orderkey)\n"
    + " UNION ALL ".join(
        [
            _count("stg_oms_orders", c, "NOT NULL", "stg_orders", f"{c} IS NULL")
            for c in ("order_id", "customer_id", "customer_lname")
        ]
        + [
            _count("stg_oms_orders", f"{c} <= {n}", "LENGTH", "stg_orders", f"length({c}) > {n}")
            for c, n in {"customer_fname": 50, "order_city": 50, "customer_segment": 8}.items()
        ]
        + [
            _count("stg_oms_orders", "customer_segment", "DOMAIN", "stg_orders",
                   "customer_segment NOT IN "
                   "('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD')"),
            _count("lineitem", "l_orderkey", "NOT NULL", "dated", "l_orderkey IS NULL"),
            _count("lineitem", "l_returnflag", "DOMAIN", "dated", "l_returnflag NOT IN ('A', 'N')"),
            _count("lineitem", "ship_after_order", "CHECK", "dated", "l_shipdate < o_orderdate"),
            _count("lineitem", "sales_not_negative", "CHECK", "dated", "l_extendedprice < 0"),
            _count("lineitem", "quantity_range", "CHECK", "dated",
                   "l_quantity < 1 OR l_quantity > 45"),
        ]
    ),
    "unique_audit": " UNION ALL ".join(
        [
            _unique("lineitem", "lineitem", ["l_orderkey", "l_linenumber"]),
            _unique("lineitem", "lineitem",
                    ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]),
            _unique("part", "part", ["p_name"]),
            _unique("orders", "orders", ["o_orderkey"]),
        ]
    ),
    "retail_audit": _retail_audit(),
    "delete_actions": f"""
WITH {_RETAIL}
SELECT 'TRANSACTION' AS table_name, 'customer_id -> CUSTOMER.customer_id' AS rule,
       'SET NULL' AS action, count(*) AS affected
FROM "R_TRANSACTION" WHERE customer_id IN {_DEBT}
UNION ALL
SELECT 'LOYALTY_POINT', 'customer_id -> CUSTOMER.customer_id', 'CASCADE', count(*)
FROM "R_LOYALTY_POINT" WHERE customer_id IN {_DEBT}
UNION ALL
SELECT 'CUSTOMER', 'rows with a customer', 'AFTER', count(*)
FROM "R_CUSTOMER" WHERE customer_id NOT IN {_DEBT}
UNION ALL
SELECT 'TRANSACTION', 'rows with a customer', 'AFTER', count(*)
FROM "R_TRANSACTION" WHERE customer_id IS NOT NULL AND customer_id NOT IN {_DEBT}
UNION ALL
SELECT 'LOYALTY_POINT', 'rows with a customer', 'AFTER', count(*)
FROM "R_LOYALTY_POINT" WHERE customer_id NOT IN {_DEBT}""",
    "delete_restricted": f"""
WITH {_RETAIL}
SELECT 'PRODUCT_VARIANT' AS table_name, 'product_id -> PRODUCT.product_id' AS rule,
       'RESTRICT' AS action, count(*) AS affected
FROM "R_PRODUCT_VARIANT" WHERE product_id IN
     (SELECT product_id FROM "R_PRODUCT" WHERE category = 'Kids')""",
    "scd2_customer": """
WITH daily AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY o_custkey, CAST(o_orderdate AS DATE)
                                 ORDER BY o_orderkey DESC) AS rn FROM orders) WHERE rn = 1
),
marked AS (
  SELECT o_custkey, o_orderpriority, o_orderstatus, CAST(o_orderdate AS DATE) AS effective_date,
         lag(o_orderpriority) OVER w AS p, lag(o_orderstatus) OVER w AS s
  FROM daily WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate)
),
changes AS (
  SELECT * FROM marked WHERE p IS NULL OR p <> o_orderpriority OR s <> o_orderstatus
)
SELECT o_custkey, o_orderpriority, o_orderstatus, CAST(effective_date AS VARCHAR) AS effective_date,
       coalesce(CAST(CAST(lead(effective_date) OVER w - INTERVAL 1 DAY AS DATE) AS VARCHAR),
                '9999-12-31') AS expiry_date,
       lead(effective_date) OVER w IS NULL AS is_current,
       CAST(row_number() OVER w AS INTEGER) AS version
FROM changes WINDOW w AS (PARTITION BY o_custkey ORDER BY effective_date)""",
    "scd2_snapshot": """
WITH moved AS (
  SELECT CASE WHEN c_nationkey = 7 THEN c_custkey + 10000000 ELSE c_custkey END AS c_custkey,
         c_name, CASE WHEN c_acctbal < 0 THEN 'RISK' ELSE c_mktsegment END AS c_mktsegment
  FROM customer
),
changed AS (
  SELECT m.*, c.c_custkey AS known FROM moved m LEFT JOIN customer c ON m.c_custkey = c.c_custkey
  WHERE c.c_custkey IS NULL OR m.c_name <> c.c_name OR m.c_mktsegment <> c.c_mktsegment
)
SELECT c.c_custkey, c.c_name, c.c_mktsegment, '2024-01-01' AS effective_date,
       CASE WHEN x.c_custkey IS NULL THEN '9999-12-31' ELSE '2024-05-31' END AS expiry_date,
       x.c_custkey IS NULL AS is_current, 1 AS version
FROM customer c LEFT JOIN changed x ON c.c_custkey = x.c_custkey
UNION ALL
SELECT c_custkey, c_name, c_mktsegment, '2024-06-01', '9999-12-31', true,
       CASE WHEN known IS NULL THEN 1 ELSE 2 END
FROM changed""",
    "upsert_customer": """
WITH batch AS (
  SELECT CASE WHEN c_nationkey < 3 THEN c_custkey + 10000000 ELSE c_custkey END AS c_custkey,
         upper(c_name) AS c_name, abs(c_acctbal) AS c_acctbal
  FROM customer WHERE c_nationkey < 6
)
SELECT c_custkey, c_name, c_acctbal FROM customer
WHERE c_custkey NOT IN (SELECT c_custkey FROM batch)
UNION ALL SELECT * FROM batch""",
    "incremental_orders": f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM ({_FIRST_LINE})""",
    "hot_key_lookup": """
SELECT p_name, count(*) AS lines, sum(l_quantity) AS quantity
FROM (SELECT CASE l_orderkey % 3 WHEN 0 THEN 1 WHEN 2 THEN l_partkey END AS part, l_quantity FROM lineitem)
LEFT JOIN part ON part = p_partkey GROUP BY p_name""",
    "csv_mixed_headers": f"""
WITH {_STAGING},{_LINES}
SELECT order_item_id, '  ' || product_name || chr(10) || ' x ' AS product_name,
       CAST(sales AS VARCHAR) AS sales FROM lines""",
    "staging_failures": f"""
WITH {_DIRTY}
SELECT 'stg_oms_orders' AS table_name, 'order_date' AS column_name, count(*) AS failed
FROM dirty WHERE order_date_dateorders = '31/12/2018 1:00' HAVING count(*) > 0
UNION ALL SELECT 'stg_oms_order_items', 'sales', count(*) FROM dirty WHERE sales = 'x'
HAVING count(*) > 0""",
    "masked_values": f"""
WITH {_DIRTY}
SELECT 'Customer Email' AS column_name, count(*) FILTER (customer_email = 'XXXXXXXXX') AS masked FROM dirty
UNION ALL SELECT 'Customer Password', count(*) FROM dirty""",
    "incremental_events": """
SELECT user_id, event_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) WHERE rn = 1""",
    "csv_round_trip": """
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, o_custkey AS customer_id,
       c_mktsegment AS customer_segment, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_date,
       o_orderstatus AS order_status
FROM orders JOIN customer ON o_custkey = c_custkey
WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)""",
}

# The same numbers, however the star was loaded. Repeated line ids count once there.
ORACLE["incremental_star"] = f"""
WITH {_STAGING},{_LINES},
single AS (SELECT DISTINCT ON (order_item_id) * FROM lines ORDER BY order_item_id, sales DESC)
SELECT department_name, CAST(year(order_date) AS INTEGER) AS year, {_MEASURES}
FROM single GROUP BY 1, 2"""

# Of an item that is there twice, the row with the greater sales counts.
ORACLE["incremental_fact"] = ORACLE["fact_one_match"].replace(
    "FROM lines LEFT JOIN known",
    "FROM (SELECT DISTINCT ON (order_item_id) * FROM lines ORDER BY order_item_id, sales DESC) "
    "LEFT JOIN known",
)

# Cells as written to CSV: texts of columns of every type, each fifth order twice.
_CELLS = """
doubled AS (
  SELECT *, unnest(CASE WHEN o_orderkey % 5 = 0 THEN [0, 1] ELSE [0] END) AS again,
         (SELECT max(o_orderkey) FROM orders) AS last
  FROM orders
),
cells AS (
  SELECT (CASE again WHEN 1 THEN ' +' ELSE '' END) || o_orderkey AS order_id,
         CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) || (CASE again WHEN 1 THEN '00' ELSE '' END) AS price,
         o_orderkey % 100 || (CASE o_orderkey % 2 WHEN 0 THEN 'e-2' ELSE 'E-2' END) AS ratio,
         CASE again WHEN 1 THEN 'TRUE' ELSE 'true' END AS sent,
         strftime(o_orderdate, '%Y-%m-%d') AS day, strftime(o_orderdate, '%-m/%-d/%Y %-H:%M') AS placed,
         CASE o_orderkey % 2 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d')
           ELSE strftime(o_orderdate, '%-m/%-d/%Y') END AS two_formats,
         '10000000000000000' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS long_number,
         CASE WHEN o_orderkey = last THEN 'x' ELSE CAST(o_custkey AS VARCHAR) END AS nearly_whole,
         CAST(NULL AS VARCHAR) AS nothing, o_orderpriority AS priority
  FROM doubled
)"""


def _type_of(column: str, title: str) -> str:
    """The narrowest type that all texts of a column have, tried one after the other."""
    c = f"trim({column})"
    plain = f"bool_and(regexp_full_match({c}, '[+-]?[0-9]+([.][0-9]*)?'))"
    whole = f"bool_and(regexp_full_match({c}, '[+-]?[0-9]{{1,18}}'))"
    number = f"bool_and(regexp_full_match({c}, '[+-]?[0-9]+([.][0-9]*)?([eE][+-]?[0-9]+)?'))"
    left = f"max(length(ltrim(ltrim(split_part({c}, '.', 1), '+-'), '0')))"
    right = f"max(length(split_part({c}, '.', 2)))"
    days = {
        "M/d/yyyy H:mm": "%-m/%-d/%Y %-H:%M", "M/d/yyyy": "%-m/%-d/%Y", "yyyy-MM-dd": "%Y-%m-%d",
    }
    tried = {f: f"bool_and(try_strptime({c}, '{d}') IS NOT NULL)" for f, d in days.items()}
    kinds = " ".join(f"WHEN {t} THEN '{'timestamp' if 'H' in f else 'date'}'" for f, t in tried.items())
    formats = " ".join(f"WHEN {t} THEN '{f}'" for f, t in tried.items())
    return f"""
SELECT '{title}' AS column_name,
       CASE WHEN count({column}) = 0 THEN 'string'
            WHEN bool_and(lower({c}) IN ('true', 'false')) THEN 'boolean'
            WHEN {whole} THEN 'bigint'
            WHEN {plain} THEN 'decimal(' || ({left} + {right}) || ',' || {right} || ')'
            WHEN {number} THEN 'double' {kinds} ELSE 'string' END AS type,
       CASE WHEN count({column}) = 0 THEN NULL {formats} END AS date_format
FROM cells"""


_TITLES = {
    "order_id": "Order Id", "price": "Price", "ratio": "Ratio", "sent": "Sent", "day": "Day", "placed": "Placed",
    "two_formats": "Two formats", "long_number": "Long number", "nearly_whole": "Nearly whole",
    "nothing": "Nothing", "priority": "Priority",
}
ORACLE["type_census"] = f"WITH {_CELLS}" + " UNION ALL ".join(_type_of(c, t) for c, t in _TITLES.items())
ORACLE["typed_duplicates"] = f"""
WITH {_CELLS},
valued AS (
  SELECT CAST(trim(order_id) AS BIGINT) AS order_id, CAST(price AS DECIMAL(18,4)) AS price, CAST(ratio AS DOUBLE) AS ratio,
         lower(sent) AS sent, * EXCLUDE (order_id, price, ratio, sent)
  FROM cells
)
SELECT 'value' AS told_by, (SELECT count(*) FROM cells) AS n_rows, count(*) AS distinct_rows,
       (SELECT count(*) FROM cells) - count(*) AS duplicate_rows
FROM (SELECT DISTINCT * FROM valued)
UNION ALL
SELECT 'text', (SELECT count(*) FROM cells), count(*), (SELECT count(*) FROM cells) - count(*)
FROM (SELECT DISTINCT * FROM cells)"""

# All observations at once, one a customer and day.
ORACLE["scd2_late_snapshots"] = """
WITH seen AS (
  SELECT c_custkey, DATE '2020-01-01' + n::INTEGER AS day,
         CASE WHEN (c_custkey % 7 + n) % 3 = 0 THEN 'OTHER' ELSE c_mktsegment END AS c_mktsegment
  FROM customer, range(6) t(n)
  WHERE c_custkey % (n + 2) <> 0
),
compared AS (
  SELECT *, coalesce(lag(c_mktsegment) OVER w <> c_mktsegment, true) AS begins
  FROM seen WINDOW w AS (PARTITION BY c_custkey ORDER BY day)
),
numbered AS (
  SELECT *, sum(begins::INTEGER) OVER (PARTITION BY c_custkey ORDER BY day) AS version FROM compared
),
versions AS (
  SELECT c_custkey, version, any_value(c_mktsegment) AS c_mktsegment, min(day) AS effective,
         string_agg(strftime(day, '%Y-%m-%d'), ',' ORDER BY day) AS seen
  FROM numbered GROUP BY c_custkey, version
)
SELECT c_custkey, c_mktsegment, strftime(effective, '%Y-%m-%d') AS effective_date,
       coalesce(strftime(lead(effective) OVER w - 1, '%Y-%m-%d'), '9999-12-31') AS expiry_date,
       lead(effective) OVER w IS NULL AS is_current, CAST(version AS INTEGER) AS version, seen
FROM versions WINDOW w AS (PARTITION BY c_custkey ORDER BY version)"""

ORACLE["revenue_by_segment"] = """
WITH keyed AS (
  SELECT *, CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE o_custkey END AS custkey FROM orders
),
told AS (
  SELECT custkey, o_orderdate::DATE AS day, arg_max(o_orderpriority, o_orderkey) AS segment
  FROM keyed WHERE o_orderkey % 4 = 0 GROUP BY 1, 2
),
lines AS (
  SELECT custkey, l_shipdate::DATE AS day, CAST(l_extendedprice AS DECIMAL(12,2)) AS sales
  FROM lineitem LEFT JOIN keyed ON l_orderkey = o_orderkey
)
SELECT t.segment, count(*) AS lines, CAST(sum(sales) AS DOUBLE) AS sales
FROM lines l ASOF LEFT JOIN told t ON l.custkey = t.custkey AND l.day >= t.day
GROUP BY t.segment"""


def _digests(written: str, rows: str, columns: dict[str, str]) -> list[str]:
    """For each column (name -> value as text) its NULLs and the sum of the hashes of its values."""
    return [
        f"""SELECT '{written}' AS written, '{c}' AS column_name, count(*) AS rows_read,
       count(*) - count({v}) AS nulls,
       coalesce(sum(CAST('0x' || substr(md5({v}), 1, 15) AS BIGINT)), 0)::VARCHAR AS digest
FROM {rows}"""
        for c, v in columns.items()
    ]


def _rows_read(written: str, rows: str) -> str:
    return f"SELECT '{written}', '*', count(*), 0, '0' FROM {rows}"


def _six(value: str) -> str:
    return f"CAST(CAST({value} AS DECIMAL(38,6)) AS VARCHAR)"


_NOTHING = "CAST(NULL AS VARCHAR)"
_FILE = {
    "Order Id": "order_id", "Customer Id": "customer_id", "Customer Fname": "customer_fname",
    "Customer Email": "customer_email", "Customer Password": "customer_password",
    "Product Name": "product_name", "Sales": _six("sales"), "Order Item Quantity": _six("order_item_quantity"),
    "order date (DateOrders)": "strftime(order_date_dateorders, '%Y-%m-%d %H:%M:%S')",
    "Delivery Status": "delivery_status", "data_quality_score": _six("data_quality_score"),
    "cleansing_timestamp": _NOW, "record_source": "'supply_chain'",
}
_STAGED = {
    "stg_oms_orders": {
        "order_id": "order_id", "customer_id": "customer_id", "customer_fname": "customer_fname",
        "customer_lname": _NOTHING, "customer_segment": _NOTHING, "order_city": _NOTHING,
        "order_state": _NOTHING, "order_country": _NOTHING,
        "order_date": "strftime(order_date_dateorders, '%Y-%m-%d')", "order_status": _NOTHING,
        "load_timestamp": _NOW, "source_system": "'OMS'",
    },
    "stg_oms_order_items": {
        "order_item_id": _NOTHING, "order_id": "order_id", "product_id": _NOTHING,
        "product_card_id": _NOTHING, "product_name": "product_name", "product_price": _NOTHING,
        "quantity": "CAST(CAST(order_item_quantity AS INTEGER) AS VARCHAR)",
        "sales": _six("CAST(sales AS DECIMAL(10,2))"), "discount": _NOTHING, "profit": _NOTHING,
        "discount_rate": _NOTHING, "profit_ratio": _NOTHING, "category_id": _NOTHING,
        "category_name": _NOTHING, "department_id": _NOTHING, "department_name": _NOTHING,
        "load_timestamp": _NOW, "source_system": "'OMS'",
    },
    "stg_slms_shipments": {
        "shipment_id": _NOTHING, "order_id": "order_id", "shipping_mode": _NOTHING,
        "ship_date": _NOTHING, "delivery_date": _NOTHING, "delivery_status": "delivery_status",
        "delivery_risk": _NOTHING, "ship_city": _NOTHING, "ship_state": _NOTHING,
        "ship_country": _NOTHING, "latitude": _NOTHING, "longitude": _NOTHING,
        "load_timestamp": _NOW, "source_system": "'SLMS'",
    },
}


def _written() -> str:
    parts = _digests("newest cleaned file", "cleaned", _FILE) + [_rows_read("newest cleaned file", "cleaned")]
    for prefix in ("loaded ", "newest version of "):
        for table, columns in _STAGED.items():
            orders = table == "stg_oms_orders"
            parts += _digests(prefix + table, "named" if orders else "cleaned", columns)
            parts.append(_rows_read(prefix + table, "firsts" if orders else "cleaned"))
    parts += _digests("appended twice", "(SELECT * FROM named UNION ALL SELECT * FROM named)", _STAGED["stg_oms_orders"])
    parts.append(_rows_read("appended twice", "(SELECT * FROM firsts UNION ALL SELECT * FROM firsts)"))
    for table in (*_STAGED, "fact"):
        parts.append(f"SELECT 'emptied {table}', '*', 0, 0, '0'")
    for written, names in {
        "sales file": ["Order Id", "order date (DateOrders)", "Customer Id", "Customer Fname", "Product Name", "Sales",
                       "Order Item Quantity"],
        "logistics file": ["Order Id", "Delivery Status"],
    }.items():
        parts += _digests(written, "cleaned", {n: _FILE[n] for n in names})
        parts.append(_rows_read(written, "cleaned"))
    return f"""WITH {_CLEANED},
named AS (SELECT * FROM cleaned WHERE order_id IS NOT NULL),
firsts AS (SELECT DISTINCT order_id FROM cleaned)
""" + "\nUNION ALL ".join(parts)


ORACLE["warehouse_writes"] = _written()

_ORDER_TEXTS = {
    "customer_id": "customer_id", "customer_fname": "customer_fname", "customer_segment": "customer_segment",
    "order_id": "order_id", "order_date_dateorders": "order_date", "order_status": "order_status",
    "order_city": "order_city", "order_state": "order_city", "order_country": "order_country",
    "order_item_id": "order_item_id", "order_item_discount": "discount", "order_item_discount_rate": "discount_rate",
    "order_item_quantity": "quantity", "order_item_profit_ratio": "profit_ratio", "product_card_id": "product_id",
    "product_name": "product_name", "product_price": "product_price", "order_profit_per_order": "profit",
    "sales": "sales", "market": "order_country",
}
_SHIPPING_TEXTS = {
    "shipping_mode": "shipping_mode", "shipping_date_dateorders": "ship_date", "late_delivery_risk": "delivery_risk",
    "delivery_status": "delivery_status", "latitude": "latitude", "longitude": "longitude", "order_id": "order_id",
}


def _sources() -> str:
    parts = []
    for table, names, known in (
        ("source_orders", SOURCE_ORDERS, _ORDER_TEXTS), ("source_shipping", SOURCE_SHIPPING, _SHIPPING_TEXTS),
    ):
        parts += _digests(table, "flat", {
            c: f"CAST({known[c]} AS VARCHAR)" if c in known else _NOTHING for c in names
        })
    return f"""WITH {_STAGING},{_LINES},
flat AS (
  SELECT l.*, c.c_name AS customer_fname, c.c_mktsegment AS customer_segment, s.latitude, s.longitude
  FROM lines l LEFT JOIN customer c ON l.customer_id = c.c_custkey
       LEFT JOIN stg_shipments s ON l.order_item_id = s.shipment_id
)
""" + "\nUNION ALL ".join(parts)


ORACLE["load_sources"] = _sources()

ORACLE["delete_cycle"] = """
WITH RECURSIVE edges AS (
  SELECT 'client' AS parent, o_custkey AS parent_id, 'purchase' AS child, o_orderkey AS child_id FROM orders
  UNION ALL
  SELECT 'purchase', c_custkey * 10 + 3, 'client', c_custkey FROM customer WHERE c_custkey % 3 = 0
),
gone AS (
  SELECT 'client' AS t, c_custkey AS id FROM customer WHERE c_custkey % 97 = 1
  UNION
  SELECT e.child, e.child_id FROM gone g JOIN edges e ON e.parent = g.t AND e.parent_id = g.id
),
hits AS (
  SELECT e.child, count(*) AS n FROM edges e JOIN gone g ON e.parent = g.t AND e.parent_id = g.id GROUP BY e.child
)
SELECT t AS table_name, 'CASCADE' AS action, coalesce(n, 0) AS n, 0::BIGINT AS key_sum
FROM (VALUES ('client'), ('purchase')) AS v(t) LEFT JOIN hits ON child = t
UNION ALL
SELECT 'client', 'LEFT', count(*), sum(c_custkey)::BIGINT FROM customer
WHERE c_custkey NOT IN (SELECT id FROM gone WHERE t = 'client')
UNION ALL
SELECT 'purchase', 'LEFT', count(*), sum(o_orderkey)::BIGINT FROM orders
WHERE o_orderkey NOT IN (SELECT id FROM gone WHERE t = 'purchase')"""

# The declared column defaults, as texts; NOW is the load time.
_DEFAULTS = """
USER: role Sales, is_active true, created_at NOW, updated_at NOW
CUSTOMER: membership_tier Silver, total_points 0, registered_at NOW, updated_at NOW
STORE: is_active true, created_at NOW
PRODUCT: is_active true, created_at NOW, updated_at NOW
PRODUCT_VARIANT: price_adjustment 0.000000, is_active true, created_at NOW
INVENTORY: quantity_on_hand 0, reserved_quantity 0, available_quantity 0, last_updated NOW
STOCK_ADJUSTMENT: created_at NOW
STOCK_TRANSFER: status Pending, transfer_date NOW
PROMOTION: min_purchase_amount 0.000000, is_active true, created_at NOW
PROMOTION_PRODUCT: apply_to Product
TRANSACTION: transaction_date NOW, discount_amount 0.000000, tax_amount 0.000000, loyalty_points_earned 0, loyalty_points_used 0, status Completed, created_at NOW
TRANSACTION_ITEM: discount_amount 0.000000, created_at NOW
PAYMENT: payment_date NOW
RETURN: refund_amount 0.000000, status Pending, return_date NOW
LOYALTY_POINT: points_earned 0, points_used 0, created_at NOW
AUDIT_LOG: created_at NOW
"""


def _defaults() -> str:
    parts = []
    for line in _DEFAULTS.strip().splitlines():
        table, columns = line.split(": ")
        values = dict(c.split(" ") for c in columns.split(", "))
        parts += _digests(table, SOURCES[table][0], {
            c: _NOW if v == "NOW" else f"'{v}'" for c, v in values.items()
        })
    return "SELECT * RENAME (written AS table_name) FROM (" + "\nUNION ALL ".join(parts) + ")"


ORACLE["table_defaults"] = _defaults()

# Estimates within their stated error are told by true.
ORACLE["profile_by_parts"] = "\nUNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count({c}) AS n, min({c}) AS min, max({c}) AS max, true AS mean_right,
       true AS std_right, true AS q25_right,
       true AS q50_right, true AS q75_right, true AS distinct_right, NULL::BOOLEAN AS common_right
FROM lineitem"""
    for c in ("l_quantity", "l_extendedprice", "l_discount")
) + "".join(
    f"""
UNION ALL
SELECT '{n}', count(*), NULL, NULL, NULL, NULL, NULL, NULL, NULL, true, true FROM lineitem"""
    for n in ("part", "l_returnflag")
)

ORACLE["kept_audit"] = """
WITH c AS (
  SELECT c_custkey, c_custkey % 1400 AS phone FROM customer WHERE c_custkey % 7 = 0 OR c_custkey % 5 <> 0
),
o AS (
  SELECT o_orderkey, o_custkey + (CASE WHEN o_orderkey % 13 = 0 THEN 1 ELSE 0 END) AS o_custkey, o_orderpriority
  FROM orders WHERE o_orderkey % 11 <> 0
)
SELECT 'customer' AS table_name, 'c_custkey' AS rule, 'UNIQUE' AS kind, count(*) - count(DISTINCT c_custkey) AS violations FROM c
UNION ALL SELECT 'customer', 'phone', 'UNIQUE', count(*) - count(DISTINCT phone) FROM c
UNION ALL SELECT 'orders', 'o_orderkey', 'UNIQUE', count(*) - count(DISTINCT o_orderkey) FROM o
UNION ALL SELECT 'orders', 'o_custkey, o_orderpriority', 'UNIQUE',
                 (SELECT count(*) FROM o) - (SELECT count(*) FROM (SELECT DISTINCT o_custkey, o_orderpriority FROM o))
UNION ALL SELECT 'orders', 'o_custkey -> customer.c_custkey', 'FOREIGN KEY', count(*)
FROM o WHERE o_custkey NOT IN (SELECT c_custkey FROM c)"""

ORACLE["incremental_orders_once"] = ORACLE["incremental_orders"]

ORACLE["star_clustered"] = f"WITH {_STAGING},{_LINES}" + " UNION ALL ".join(
    f"""
SELECT '{name}' AS filter, count(*) AS lines, CAST(sum(sales) AS DOUBLE) AS sales, true AS pruned
FROM lines WHERE {test}"""
    for name, test in {
        "product": "product_id = 7", "customer": "customer_id = 7", "order_date": "order_date = DATE '1996-03-13'",
    }.items()
)

ORACLE["custom_cleaning"] = f"""
WITH {_CLEANED}
SELECT delivery_status AS status, 'manual' AS source_system, {_NOW} AS load_date, 'night job' AS loaded_by,
       count(*) AS n, CAST(sum(CAST(sales AS DECIMAL(18,2))) AS DOUBLE) AS sales
FROM cleaned WHERE sales >= 0 GROUP BY delivery_status"""
