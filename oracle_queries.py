"""The same results in plain SQL over the driver's tables, written independently of the Spark jobs."""

from __future__ import annotations

# Raw tables, all columns as text, with the defects derived from the ids.
_RAW = r"""
raw_customers AS (
  SELECT CASE WHEN k % 97 <> 0 THEN 'CUST' || k END AS customer_id,
    CASE WHEN k % 13 <> 0 THEN split_part(c_name, '#', 1) END AS first_name,
    split_part(c_name, '#', 2) AS last_name,
    CASE WHEN k % 211 = 0 THEN 'invalid.address' WHEN k % 3 = 0 THEN '  User' || k || '@Example.COM '
         ELSE 'user' || k || '@example.com' END AS email,
    '(555) 010-' || lpad(CAST(k % 10000 AS VARCHAR), 4, '0') AS phone,
    k || ' Main St' AS address,
    CASE WHEN older THEN 'Old City' ELSE 'City ' || (k % 50) END AS city,
    n_name AS state,
    lpad(CAST(k % 100000 AS VARCHAR), 5, '0') AS zip_code,
    'USA' AS country,
    CASE WHEN older THEN '1989-06-01' WHEN k % 17 = 0 THEN NULL
         ELSE CAST(DATE '1990-01-01' + CAST(k % 3000 AS INTEGER) AS VARCHAR) END AS created_date,
    CASE WHEN k % 7 <> 0 THEN CAST(k % 5 <> 0 AS VARCHAR) END AS is_active
  FROM (SELECT c_custkey AS k, c_name, n_name, o.older
        FROM customer JOIN nation ON c_nationkey = n_nationkey,
             (VALUES (false), (true)) AS o(older)
        WHERE NOT o.older OR c_custkey % 10 = 0)
),
raw_products AS (
  SELECT CASE WHEN k % 103 <> 0 THEN 'PROD' || k END AS product_id,
    CASE WHEN older THEN 'old ' || p_name WHEN k % 4 = 0 THEN '  ' || p_name || ' ' ELSE p_name END AS product_name,
    CASE WHEN k % 3 = 0 THEN ' ' || lower(p_type) ELSE p_type END AS category,
    'Size ' || ((p_size - 1) // 10) AS subcategory,
    p_brand AS brand,
    CASE WHEN older THEN '1.00' WHEN k % 101 = 0 THEN '-1.00' WHEN k % 107 = 0 THEN '0.00' WHEN k % 109 = 0 THEN NULL
         ELSE CAST(price AS VARCHAR) END AS unit_price,
    CASE WHEN k % 19 <> 0 THEN CAST(CAST(price * CAST(40 + p_size + CASE WHEN k % 23 = 0 THEN 80 ELSE 0 END AS DECIMAL(4,0))
         * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(10,2)) AS VARCHAR) END AS cost,
    CASE WHEN k % 11 <> 0 THEN CAST(k % 8 <> 0 AS VARCHAR) END AS is_active
  FROM (SELECT p_partkey AS k, part.*, CAST(p_retailprice AS DECIMAL(10,2)) AS price, o.older
        FROM part, (VALUES (false), (true)) AS o(older)
        WHERE NOT o.older OR p_partkey % 20 = 0)
),
raw_locations AS (
  SELECT CASE WHEN k % 53 <> 0 THEN 'LOC' || k END AS location_id,
    CASE WHEN older THEN 'Zed ' || s_name WHEN k % 3 = 0 THEN '  ' || s_name || ' ' ELSE s_name END AS store_name,
    k || ' Market Sq' AS address,
    ' City ' || (k % 20) AS city,
    CASE WHEN k % 2 = 0 THEN lower(n_name) ELSE n_name END AS state,
    lpad(CAST(k % 100000 AS VARCHAR), 5, '0') AS zip_code,
    CASE WHEN k % 29 = 0 THEN 'Unknown' WHEN k % 5 = 0 THEN lower(r_name) ELSE r_name END AS region,
    ' usa' AS country
  FROM (SELECT s_suppkey AS k, s_name, n_name, r_name, o.older
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey,
             (VALUES (false), (true)) AS o(older)
        WHERE NOT o.older OR s_suppkey % 25 = 0)
),
raw_sales AS (
  SELECT l_orderkey || '-' || l_partkey || '-' || l_suppkey || '-' || l_linenumber AS sale_id,
    CASE WHEN k % 101 = 0 THEN NULL WHEN k % 89 = 0 THEN 'CUST999999999' WHEN k % 83 = 0 THEN 'cust' || buyer
         ELSE 'CUST' || buyer END AS customer_id,
    CASE WHEN k % 113 = 0 THEN 'PROD999999999' ELSE 'PROD' || l_partkey END AS product_id,
    'LOC' || l_suppkey AS location_id,
    CASE WHEN k % 997 = 0 THEN 'not-a-date' WHEN k % 499 = 0 THEN '1990-01-15'
         ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS sale_date,
    CASE WHEN k % 1009 = 0 THEN 'many' WHEN k % 307 = 0 THEN q || '.0' WHEN k % 311 = 0 THEN q || '.5'
         ELSE CAST(q AS VARCHAR) END AS quantity,
    CAST(price AS VARCHAR) AS unit_price,
    CASE WHEN k % 5 <> 0 THEN CAST(CAST(q * price * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(10,2)) AS VARCHAR) END AS discount_amount,
    CASE WHEN k % 7 <> 0 THEN CAST(CAST(q * price * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(10,2)) AS VARCHAR) END AS tax_amount
  FROM (SELECT l.*, l_orderkey AS k, o_orderdate,
               CASE WHEN o_custkey % 31 = 0 THEN o_custkey + 1 ELSE o_custkey END AS buyer,
               CAST(CASE WHEN l_orderkey % 251 = 0 THEN -l_quantity WHEN l_orderkey % 241 = 0 THEN 0 ELSE l_quantity END AS DECIMAL(6,0)) AS q,
               CAST(p_retailprice AS DECIMAL(10,2)) AS price
        FROM lineitem l JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)
)"""

_DIMS = r"""
customer_dim AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY substr(md5(customer_id), 1, 3), customer_id) AS customer_key, * EXCLUDE (rn)
  FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY created_date DESC NULLS LAST, full_name DESC NULLS LAST,
               email DESC NULLS LAST, phone DESC NULLS LAST, address DESC NULLS LAST, city DESC NULLS LAST) AS rn
        FROM (SELECT customer_id, trim(concat_ws(' ', first_name, last_name)) AS full_name, lower(trim(email)) AS email,
                     regexp_replace(phone, '[^0-9]', '', 'g') AS phone, address, city, state, zip_code, country,
                     coalesce(CAST(created_date AS DATE), DATE '2001-12-31') AS created_date,
                     coalesce(CAST(is_active AS BOOLEAN), true) AS is_active
              FROM raw_customers WHERE customer_id IS NOT NULL)) WHERE rn = 1
),
product_dim AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY substr(md5(product_id), 1, 3), product_id) AS product_key, * EXCLUDE (rn),
    TRY_CAST(CASE WHEN unit_price > 0 THEN
      sign(unit_price - cost) * ((abs(CAST((unit_price - cost) * 100 AS BIGINT)) * 20000 + CAST(unit_price * 100 AS BIGINT))
           // (2 * CAST(unit_price * 100 AS BIGINT))) * CAST(0.01 AS DECIMAL(3,2)) ELSE 0 END AS DECIMAL(5,2)) AS margin
  FROM (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY product_name DESC NULLS LAST, category DESC NULLS LAST,
               subcategory DESC NULLS LAST, brand DESC NULLS LAST, unit_price DESC NULLS LAST, cost DESC NULLS LAST) AS rn
        FROM (SELECT product_id, trim(product_name) AS product_name, upper(trim(category)) AS category,
                     upper(trim(subcategory)) AS subcategory, brand, CAST(unit_price AS DECIMAL(10,2)) AS unit_price,
                     CAST(cost AS DECIMAL(10,2)) AS cost, coalesce(CAST(is_active AS BOOLEAN), true) AS is_active
              FROM raw_products WHERE product_id IS NOT NULL)) WHERE rn = 1 AND unit_price >= 0
),
location_dim AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY substr(md5(location_id), 1, 3), location_id) AS location_key, * EXCLUDE (rn)
  FROM (SELECT *, row_number() OVER (PARTITION BY location_id ORDER BY store_name DESC NULLS LAST, address DESC NULLS LAST) AS rn
        FROM (SELECT location_id, trim(store_name) AS store_name, address, trim(city) AS city, upper(trim(state)) AS state,
                     zip_code, upper(trim(region)) AS region, upper(trim(country)) AS country
              FROM raw_locations WHERE location_id IS NOT NULL)) WHERE rn = 1
),
date_dim AS MATERIALIZED (
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS date_value,
    CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month,
    strftime(d, '%B') AS month_name, CAST(day(d) AS INTEGER) AS day, CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week,
    strftime(d, '%A') AS day_name, CAST(weekofyear(d) AS INTEGER) AS week_of_year, dayofweek(d) IN (0, 6) AS is_weekend,
    CAST(CASE WHEN month(d) >= 7 THEN year(d) + 1 ELSE year(d) END AS INTEGER) AS fiscal_year
  FROM range(TIMESTAMP '1995-01-01', TIMESTAMP '2002-01-01', INTERVAL 1 DAY) AS t(d)
)"""

_FACT = r"""
resolved AS MATERIALIZED (
  SELECT s.sale_id, s.customer_id, s.product_id, s.location_id, s.sale_date, customer_key, product_key, location_key, date_key,
    q AS quantity, CAST(s.unit_price AS DECIMAL(10,2)) AS unit_price,
    CAST(q * CAST(s.unit_price AS DECIMAL(10,2)) AS DECIMAL(12,2)) AS gross_amount,
    coalesce(CAST(s.discount_amount AS DECIMAL(10,2)), 0) AS discount_amount,
    coalesce(CAST(s.tax_amount AS DECIMAL(10,2)), 0) AS tax_amount,
    CAST(q * CAST(s.unit_price AS DECIMAL(10,2)) - coalesce(CAST(s.discount_amount AS DECIMAL(10,2)), 0)
         + coalesce(CAST(s.tax_amount AS DECIMAL(10,2)), 0) AS DECIMAL(12,2)) AS net_amount
  FROM (SELECT *, CASE WHEN regexp_full_match(quantity, '-?\d+(\.0)?') THEN CAST(split_part(quantity, '.', 1) AS INTEGER) END AS q
        FROM raw_sales) s LEFT JOIN customer_dim c ON s.customer_id = c.customer_id
    LEFT JOIN product_dim p ON s.product_id = p.product_id
    LEFT JOIN location_dim l ON s.location_id = l.location_id
    LEFT JOIN date_dim d ON TRY_CAST(s.sale_date AS DATE) = d.date_value
),
sales_fact AS MATERIALIZED (
  SELECT * FROM resolved
  WHERE customer_key IS NOT NULL AND product_key IS NOT NULL AND location_key IS NOT NULL AND date_key IS NOT NULL
    AND quantity IS NOT NULL AND unit_price IS NOT NULL
),
star AS (
  SELECT f.*, d.* EXCLUDE (date_key), p.product_name, p.category, p.subcategory, p.brand, l.store_name, l.region, l.state,
         c.full_name, c.city AS customer_city, c.state AS customer_state
  FROM sales_fact f JOIN date_dim d USING (date_key) JOIN product_dim p USING (product_key)
    JOIN location_dim l USING (location_key) JOIN customer_dim c USING (customer_key)
)"""

_NET = "CAST(sum(net_amount) AS DOUBLE)"
_AVG = "CAST(sum(net_amount) AS DOUBLE) / count(net_amount)"


def _on_raw(sql: str) -> str:
    return f"WITH {_RAW}\n{sql}"


def _on_dims(sql: str) -> str:
    return f"WITH {_RAW},{_DIMS}\n{sql}"


def _on_star(sql: str) -> str:
    return f"WITH {_RAW},{_DIMS},{_FACT}\n{sql}"


_D = "strftime({0}, '%Y-%m-%d') AS {0}".format

_CUSTOMER = f"""SELECT customer_key, customer_id, full_name, email, phone, address, city, state, zip_code, country,
  {_D('created_date')}, is_active FROM customer_dim"""
_PRODUCT = """SELECT product_key, product_id, product_name, category, subcategory, brand, CAST(unit_price AS DOUBLE) AS unit_price,
  CAST(cost AS DOUBLE) AS cost, CAST(margin AS DOUBLE) AS margin, is_active FROM product_dim"""
_FACT_ROWS = """SELECT sale_id, customer_key, product_key, location_key, date_key, quantity, CAST(unit_price AS DOUBLE) AS unit_price,
  CAST(gross_amount AS DOUBLE) AS gross_amount, CAST(discount_amount AS DOUBLE) AS discount_amount,
  CAST(tax_amount AS DOUBLE) AS tax_amount, CAST(net_amount AS DOUBLE) AS net_amount FROM sales_fact"""
_MONTHLY = f"""SELECT year, month, month_name, category, subcategory, region, state,
  count(DISTINCT customer_key) AS unique_customers, count(*) AS total_transactions,
  CAST(sum(quantity) AS BIGINT) AS total_quantity_sold, CAST(sum(gross_amount) AS DOUBLE) AS total_gross_sales,
  CAST(sum(discount_amount) AS DOUBLE) AS total_discounts, {_NET} AS total_net_sales, {_AVG} AS avg_transaction_value
  FROM star GROUP BY ALL"""
_SUMMARY = f"""SELECT c.customer_key, c.customer_id, c.full_name, c.city, c.state, count(s.sale_id) AS total_purchases,
  CAST(sum(quantity) AS BIGINT) AS total_items_purchased, {_NET} AS lifetime_value, {_AVG} AS avg_order_value,
  strftime(max(date_value), '%Y-%m-%d') AS last_purchase_date, strftime(min(date_value), '%Y-%m-%d') AS first_purchase_date
  FROM customer_dim c LEFT JOIN sales_fact s USING (customer_key) LEFT JOIN date_dim d USING (date_key)
  GROUP BY c.customer_key, c.customer_id, c.full_name, c.city, c.state"""
_KPIS = f"""{_NET} AS total_sales, count(*) AS total_transactions, {_AVG} AS avg_transaction_value,
  count(DISTINCT customer_key) AS unique_customers, CAST(sum(discount_amount) AS DOUBLE) AS total_discount,
  CASE WHEN coalesce(sum(gross_amount), 0) = 0 THEN 0.0
       ELSE coalesce(CAST(sum(discount_amount) AS DOUBLE) / CAST(sum(gross_amount) AS DOUBLE), 0) END AS discount_rate"""
_SEGMENTS = """(SELECT customer_id, CAST(value AS DOUBLE) AS lifetime_value, value,
  CASE WHEN above * 10 <= n - 1 THEN 'VIP' WHEN above * 2 <= n - 1 THEN 'Regular' ELSE 'Occasional' END AS segment
  FROM (SELECT customer_id, value, rank() OVER (ORDER BY value DESC) - 1 AS above, count(*) OVER () AS n
        FROM (SELECT customer_id, coalesce(sum(net_amount), 0) AS value
              FROM (SELECT customer_key, customer_id FROM customer_dim)
              LEFT JOIN (SELECT customer_key, net_amount FROM sales_fact) USING (customer_key) GROUP BY customer_id)))"""


def _growth(keys: str, join: str, source: str) -> str:
    return f"""SELECT {keys}, CAST(net AS DOUBLE) AS current_sales, CAST(prev AS DOUBLE) AS previous_sales,
      CASE WHEN coalesce(prev, 0) = 0 THEN 0.0 ELSE coalesce(CAST(net - prev AS DOUBLE) / CAST(prev AS DOUBLE), 0) END AS yoy_growth
      FROM (SELECT a.*, b.net AS prev FROM ({source}) a LEFT JOIN ({source}) b ON {join})"""


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


# (table, column, rule, condition of a broken value); what the raw contract asks for.
def _type_rule(table: str, column: str, kind: str) -> tuple:
    return (table, column, "type", f"{column} IS NOT NULL AND TRY_CAST({column} AS {kind}) IS NULL")


def _null_rules(table: str, columns: str) -> list[tuple]:
    return [(table, c, "not_null", f"{c} IS NULL") for c in columns.split()]


_MONEY = "DECIMAL(10,2)"


def _below(column: str, bound: int) -> str:
    return f"TRY_CAST({column} AS DECIMAL(38,10)) < {bound}"


_RAW_RULES = [
    *_null_rules("customers", "customer_id first_name last_name email"),
    _type_rule("customers", "created_date", "DATE"), _type_rule("customers", "is_active", "BOOLEAN"),
    ("customers", "customer_id", "pattern", r"NOT regexp_matches(customer_id, '^CUST\p{Nd}+$')"),
    ("customers", "first_name", "length_1_100", "length(first_name) NOT BETWEEN 1 AND 100"),
    ("customers", "last_name", "length_1_100", "length(last_name) NOT BETWEEN 1 AND 100"),
    ("customers", "email", "pattern", r"NOT regexp_matches(email, '^[\pL\pM\p{Nd}\p{Pc}.-]+@[\pL\pM\p{Nd}\p{Pc}.-]+\.[\pL\pM\p{Nd}\p{Pc}]+$')"),
    ("customers", "state", "length_2_50", "length(state) NOT BETWEEN 2 AND 50"),
    *_null_rules("products", "product_id product_name category unit_price"),
    _type_rule("products", "unit_price", _MONEY), _type_rule("products", "cost", _MONEY),
    _type_rule("products", "is_active", "BOOLEAN"),
    ("products", "product_id", "pattern", r"NOT regexp_matches(product_id, '^PROD\p{Nd}+$')"),
    ("products", "product_name", "length_1_255", "length(product_name) NOT BETWEEN 1 AND 255"),
    ("products", "unit_price", "at_least_0", _below("unit_price", 0)),
    ("products", "unit_price", "less_than_100000", "TRY_CAST(unit_price AS DECIMAL(38,10)) >= 100000"),
    ("products", "cost", "at_least_0", _below("cost", 0)),
    *_null_rules("locations", "location_id store_name city state country"),
    ("locations", "location_id", "pattern", r"NOT regexp_matches(location_id, '^LOC\p{Nd}+$')"),
    ("locations", "region", "allowed_value", "region NOT IN ('AFRICA', 'AMERICA', 'ASIA', 'EUROPE', 'MIDDLE EAST')"),
    *_null_rules("sales", "sale_id customer_id product_id location_id sale_date quantity unit_price"),
    _type_rule("sales", "sale_date", "DATE"),
    ("sales", "quantity", "type", r"NOT regexp_full_match(quantity, '-?\d+(\.0)?')"),
    *[_type_rule("sales", c, _MONEY) for c in ("unit_price", "discount_amount", "tax_amount")],
    ("sales", "customer_id", "pattern", r"NOT regexp_matches(customer_id, '^CUST\p{Nd}+$')"),
    ("sales", "product_id", "pattern", r"NOT regexp_matches(product_id, '^PROD\p{Nd}+$')"),
    ("sales", "location_id", "pattern", r"NOT regexp_matches(location_id, '^LOC\p{Nd}+$')"),
    ("sales", "quantity", "more_than_0", "TRY_CAST(quantity AS DECIMAL(38,10)) <= 0"),
    ("sales", "quantity", "less_than_10000", "TRY_CAST(quantity AS DECIMAL(38,10)) >= 10000"),
    ("sales", "unit_price", "at_least_0", _below("unit_price", 0)),
    ("sales", "discount_amount", "at_least_0", _below("discount_amount", 0)),
    ("sales", "tax_amount", "at_least_0", _below("tax_amount", 0)),
]


def _repeated(table: str, column: str) -> str:
    return f"(SELECT {column}, count(*) AS n FROM {table} WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1)"


def _rule_row(label: str, source: str, column: str, rule: str, broken: str) -> str:
    return (f"SELECT '{label}' AS table_name, '{column}' AS column_name, '{rule}' AS rule, "
            f"count(*) FILTER (WHERE {broken}) AS violations, count(*) FILTER (WHERE {broken}) = 0 AS passed FROM {source}")


def _unique_row(label: str, source: str, column: str) -> str:
    return (f"SELECT '{label}' AS table_name, '{column}' AS column_name, 'unique' AS rule, count(*) AS violations, "
            f"count(*) = 0 AS passed FROM {_repeated(source, column)}")


_RAW_ID = {"customers": "customer_id", "products": "product_id", "locations": "location_id", "sales": "sale_id"}
_KEYED_FACT = "(SELECT *, row_number() OVER () AS sale_key FROM sales_fact)"
_DIM_KEYS = {"customer_dim": "customer", "product_dim": "product", "location_dim": "location"}
_FACT_NOT_NULL = "customer_key product_key location_key date_key quantity unit_price gross_amount net_amount".split()


def _duplicates(label: str, source: str, column: str) -> str:
    return (f"SELECT '{label}' AS table_name, '{column}' AS column_name, count(*) AS duplicate_values, "
            f"CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS surplus_rows FROM {_repeated(source, column)}")


def _unknown(column: str, table: str) -> str:
    missing = f"(SELECT DISTINCT {column} AS id FROM raw_sales WHERE {column} IS NOT NULL AND {column} NOT IN (SELECT {column} FROM {table} WHERE {column} IS NOT NULL))"
    return (f"SELECT '{column}' AS column_name, count(*) AS invalid_ids, "
            f"(SELECT coalesce(string_agg(id, ',' ORDER BY id), '') FROM (SELECT id FROM {missing} ORDER BY id LIMIT 5)) AS sample_ids, "
            f"count(*) = 0 AS passed FROM {missing}")


def _orphans(column: str, table: str) -> str:
    return f"SELECT count(*) FROM resolved s LEFT JOIN {table} x ON s.{column} = x.{column} WHERE x.{column} IS NULL"


def _profile(table: str, columns: str) -> str:
    parts = []
    for c in columns.split():
        parts.append(f"""SELECT '{table}' AS table_name, '{c}' AS column_name, count(*) AS row_count,
          count(*) - count({c}) AS null_count, CAST(count(*) - count({c}) AS DOUBLE) / count(*) * 100 AS null_percent,
          count(DISTINCT {c}) AS distinct_count, CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value
          FROM {table}""")
    return _union(parts)


# The stored tables' columns, but the load time and what only the storage needs.
_COLUMNS = {
    "customer_dim": "customer_key customer_id full_name email phone address city state zip_code country created_date is_active",
    "product_dim": "product_key product_id product_name category subcategory brand unit_price cost margin is_active",
    "location_dim": "location_key location_id store_name address city state zip_code region country",
    "date_dim": "date_key date_value year quarter month month_name day day_of_week day_name week_of_year is_weekend fiscal_year",
    "sales_fact": "sale_id customer_key product_key location_key date_key quantity unit_price gross_amount discount_amount"
                  " tax_amount net_amount",
}


def _row_text(table: str) -> str:
    parts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in _COLUMNS[table].split())
    return f"SELECT '{table}' AS table_name, concat_ws('|', {parts}) AS row_text FROM {table}"


# Type by the contract, and the type found in text files where it differs: digits look like numbers, and a few
# unreadable values make a column text.
_TYPES = {
    "customers": "customer_id:string first_name:string last_name:string:int email:string phone:string address:string city:string"
                 " state:string zip_code:string:int country:string created_date:date is_active:boolean",
    "products": "product_id:string product_name:string category:string subcategory:string brand:string"
                " unit_price:decimal(10,2):double cost:decimal(10,2):double is_active:boolean",
    "locations": "location_id:string store_name:string address:string city:string state:string zip_code:string:int region:string"
                 " country:string",
    "sales": "sale_id:string customer_id:string product_id:string location_id:string sale_date:date:string quantity:int:string"
             " unit_price:decimal(10,2):double discount_amount:decimal(10,2):double tax_amount:decimal(10,2):double",
}


def _drift() -> str:
    rows = []
    for table, columns in _TYPES.items():
        for name, contract, *found in (c.split(":") for c in columns.split()):
            rows.append((table, name, contract, *(found or [contract]), "type_differs" if found else "match"))
    return f"SELECT * FROM (VALUES {', '.join(map(str, rows))}) AS t(table_name, column_name, contract_type, found_type, status)"


_SLICE = """date_value BETWEEN DATE '1997-03-05' AND DATE '1999-07-09'
  AND brand IN ('Brand#2', 'Brand#3', 'Brand#5', 'Brand#7')"""
_PURCHASES = "SELECT customer_key, count(sale_id) AS purchases FROM customer_dim LEFT JOIN sales_fact USING (customer_key) GROUP BY customer_key"
_DAILY = "SELECT date_value, year, quarter, month, day, fiscal_year, is_weekend, sum(net_amount) AS net, count(*) AS sales FROM star GROUP BY ALL"
_MONTHS = "SELECT year, month, sum(net_amount) AS net FROM star GROUP BY ALL"
_PRODUCTS = "SELECT category, product_name, CAST(sum(quantity) AS BIGINT) AS units_sold, sum(net_amount) AS revenue FROM star GROUP BY ALL"
_TOP_CUSTOMERS = f"""SELECT customer_id, full_name, customer_city AS city, customer_state AS state,
  count(*) AS total_purchases, {_NET} AS lifetime_value FROM star GROUP BY ALL
  ORDER BY lifetime_value DESC, customer_id LIMIT {{0}}"""
_COUNTS = {"customer_dim": "customers", "product_dim": "products", "location_dim": "locations", "date_dim": "dates",
           "sales_fact": "sales_transactions"}
_PLURAL = {"customer_key": "customers", "product_key": "products", "location_key": "locations", "date_key": "dates"}
_NO_KEY = "customer_key IS NULL OR product_key IS NULL OR location_key IS NULL OR date_key IS NULL"

ORACLE: dict[str, str] = {
    "scan_raw_tables": _on_raw(_union([
        f"SELECT '{t}' AS table_name, count(*) AS row_count, count({c}) AS id_count FROM raw_{t}" for t, c in _RAW_ID.items()])),
    "bulk_load_with_error_budget": _on_star(_union(["""SELECT 'sales' AS table_name, count(*) AS rows_read,
        count(*) - count(*) FILTER (WHERE bad) AS rows_loaded, count(*) FILTER (WHERE bad) AS rows_rejected
        FROM (SELECT TRY_CAST(sale_date AS DATE) IS NULL OR NOT regexp_full_match(quantity, '-?\\d+') OR customer_id IS NULL AS bad
              FROM raw_sales)""",
        *[f"SELECT '{t}' AS table_name, count(*) AS rows_read, count(*) AS rows_loaded, CAST(0 AS BIGINT) AS rows_rejected FROM {t}"
          for t in _COLUMNS]])),
    "recent_load_errors": """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, user_id, value FROM events
        WHERE event_type = 'error' AND ts > TIMESTAMP '2024-01-30 11:00:00' AND ts <= TIMESTAMP '2024-01-30 12:00:00'""",
    "customer_dim": _on_dims(_CUSTOMER),
    "product_dim": _on_dims(_PRODUCT),
    "load_replace": _on_dims(_union([_row_text(t) for t in _COLUMNS if t != "sales_fact"])),
    "location_dim": _on_dims("SELECT * FROM location_dim"),
    "date_dim": _on_dims(f"SELECT * EXCLUDE (date_value), {_D('date_value')} FROM date_dim"),
    "sales_fact": _on_star(_FACT_ROWS),
    "curated_roundtrip": _on_star(_union([_row_text(t) for t in _COLUMNS])),
    "compact_sorted": _on_star(_union([_row_text(t) for t in _COLUMNS])),
    "input_gate": _on_star(_union(
        [f"SELECT 'raw' AS stage, '{t}' AS folder, count(*) > 0 AS present, count(*) > 0 AS passed FROM raw_{t}" for t in _RAW_ID]
        + [f"SELECT 'curated' AS stage, '{f}' AS folder, count(*) > 0 AS present, count(*) > 0 AS passed FROM {t}" for f, t in (
            *((t, t) for t in _COLUMNS if t != "sales_fact"), ("sales_lines", "resolved"))])),
    "schema_drift": _drift(),
    "sales_fact_rejects": _on_star(f"""SELECT sale_id, customer_id, product_id, location_id, sale_date,
        concat_ws(',', CASE WHEN customer_key IS NULL THEN 'customer_key' END, CASE WHEN product_key IS NULL THEN 'product_key' END,
          CASE WHEN location_key IS NULL THEN 'location_key' END, CASE WHEN date_key IS NULL THEN 'date_key' END,
          CASE WHEN quantity IS NULL THEN 'quantity,gross_amount,net_amount' END) AS reject_reason
        FROM resolved WHERE {_NO_KEY} OR quantity IS NULL"""),
    "surrogate_key_map": """WITH ids AS (SELECT 'CUST' || c_custkey AS customer_id, c_acctbal < 0 AS late FROM customer)
        SELECT customer_id, CASE WHEN late THEN (SELECT count(*) FROM ids WHERE NOT late) ELSE 0 END
          + row_number() OVER (PARTITION BY late ORDER BY substr(md5(customer_id), 1, 3), customer_id) AS customer_key FROM ids""",
    "sales_enriched": _on_star("""SELECT sale_id, customer_key, product_key, location_key, date_key, quantity,
        CAST(unit_price AS DOUBLE) AS unit_price, CAST(gross_amount AS DOUBLE) AS gross_amount,
        CAST(discount_amount AS DOUBLE) AS discount_amount, CAST(tax_amount AS DOUBLE) AS tax_amount,
        CAST(net_amount AS DOUBLE) AS net_amount, strftime(date_value, '%Y-%m-%d') AS date_value, year, quarter, month, month_name,
        day, is_weekend, fiscal_year, product_id, product_name, category, subcategory, brand, location_id, store_name, region,
        state, customer_id, full_name, customer_state FROM star"""),
    "load_append_idempotent": _on_star(f"""SELECT CAST(year * 100 + month AS INTEGER) AS month_key, count(*) AS sales,
        {_NET} AS net_amount FROM star GROUP BY year, month"""),
    "mv_monthly_sales": _on_star(_MONTHLY),
    "mv_refresh_incremental": _on_star(_MONTHLY),
    "mv_after_failed_append": _on_star(_MONTHLY),
    "mv_customer_summary": _on_star(_SUMMARY),
    "mv_customer_merge": _on_star(_SUMMARY),
    "catalog_statistics": _on_star(_union([
        f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {t}" for n, t in (
            *((t, t) for t in _COLUMNS), ("sales_lines", "resolved"), ("mv_customer_summary", "customer_dim"),
            ("mv_monthly_sales", f"({_MONTHLY})"))])),
    "top_customers": _on_star(_TOP_CUSTOMERS.format(10)),
    "top20_customers": _on_star(_TOP_CUSTOMERS.format(20)),
    "monthly_trend": _on_star(f"""SELECT year, month_name, count(DISTINCT customer_key) AS unique_customers,
        CAST(sum(quantity) AS BIGINT) AS units_sold, {_NET} AS total_revenue, {_AVG} AS avg_transaction_value
        FROM star GROUP BY year, month, month_name ORDER BY year, month"""),
    "top_products": _on_star(f"""SELECT category, product_name, units_sold, CAST(revenue AS DOUBLE) AS total_revenue
        FROM ({_PRODUCTS}) ORDER BY revenue DESC, category, product_name LIMIT 20"""),
    "top_products_per_category": _on_star(f"""SELECT category, product_name, units_sold, CAST(revenue AS DOUBLE) AS total_revenue, rank
        FROM (SELECT *, CAST(row_number() OVER (PARTITION BY category ORDER BY revenue DESC, product_name) AS INTEGER) AS rank
              FROM ({_PRODUCTS})) WHERE rank <= 3"""),
    "regional_performance": _on_star(f"""SELECT region, state, count(DISTINCT customer_key) AS unique_customers,
        count(*) AS transactions, {_NET} AS total_sales FROM star GROUP BY ALL ORDER BY total_sales DESC, region, state"""),
    "weekend_vs_weekday": _on_star(f"""SELECT CASE WHEN is_weekend THEN 'Weekend' ELSE 'Weekday' END AS day_type,
        count(*) AS transactions, {_NET} AS total_sales, {_AVG} AS avg_transaction FROM star GROUP BY is_weekend ORDER BY 1"""),
    "category_by_month": _on_star(f"""SELECT year, month_name, category, {_NET} AS revenue FROM star
        GROUP BY year, month, month_name, category ORDER BY year, month, revenue DESC, category"""),
    "kpi_summary": _on_star(f"SELECT {_KPIS} FROM sales_fact"),
    "yoy_growth": _on_star(_growth("year, month", "a.year = b.year + 1 AND a.month = b.month", _MONTHS)),
    "yoy_growth_daily": _on_star(_growth(
        _D("date_value"), "CAST(a.date_value - INTERVAL 1 YEAR AS DATE) = b.date_value",
        "SELECT date_value, sum(net_amount) AS net FROM star GROUP BY date_value")),
    "top10_products_total": _on_star("""SELECT count(*) AS products, CAST(sum(revenue) AS DOUBLE) AS top_products_sales
        FROM (SELECT product_name, sum(net_amount) AS revenue, rank() OVER (ORDER BY sum(net_amount) DESC) AS r
              FROM star GROUP BY product_name) WHERE r <= 10"""),
    "customer_ltv": _on_star(f"SELECT customer_id, {_NET} AS customer_ltv FROM star GROUP BY customer_id"),
    "sales_ma30": _on_star(f"""SELECT {_D('date_value')}, daily_sales, sales_ma30 FROM (
        SELECT date_value, CAST(net AS DOUBLE) AS daily_sales, CAST(sum(net) OVER w AS DOUBLE) / nullif(count(net) OVER w, 0) AS sales_ma30
        FROM date_dim LEFT JOIN (SELECT date_value, sum(net_amount) AS net FROM star GROUP BY date_value) USING (date_value)
        WHERE date_value <= (SELECT max(date_value) FROM star)
        WINDOW w AS (ORDER BY date_value RANGE BETWEEN INTERVAL 29 DAYS PRECEDING AND CURRENT ROW)) WHERE sales_ma30 IS NOT NULL"""),
    "kpi_mom": _on_star(f"""SELECT year, month, total_sales, total_transactions, avg_transaction_value, unique_customers,
        lag(total_sales) OVER w AS previous_total_sales, lag(total_transactions) OVER w AS previous_total_transactions,
        lag(avg_transaction_value) OVER w AS previous_avg_transaction_value, lag(unique_customers) OVER w AS previous_unique_customers
        FROM (SELECT DISTINCT year, month FROM date_dim) LEFT JOIN (SELECT year, month, {_KPIS} FROM star GROUP BY year, month)
        USING (year, month) WINDOW w AS (ORDER BY year, month)"""),
    "trend_last_12m": _on_star(f"""SELECT year, month, month_name, {_NET} AS total_sales, count(*) AS transactions FROM star
        WHERE date_value >= DATE '2000-08-01' AND date_value < DATE '2001-08-01' GROUP BY ALL"""),
    "sales_by_category": _on_star(f"SELECT category, {_NET} AS total_sales, count(*) AS transactions FROM star GROUP BY ALL"),
    "sales_by_state": _on_star(f"SELECT state, {_NET} AS total_sales, count(*) AS transactions FROM star GROUP BY ALL"),
    "product_matrix_rollup": _on_star(f"""SELECT category, subcategory, product_name,
        CAST(grouping(category, subcategory, product_name) AS INTEGER) AS level, CAST(sum(quantity) AS BIGINT) AS units_sold,
        {_NET} AS total_sales FROM star GROUP BY ROLLUP (category, subcategory, product_name)"""),
    "price_vs_volume": _on_star(f"""SELECT product_id, product_name, CAST(sum(unit_price) AS DOUBLE) / count(unit_price) AS avg_price,
        CAST(sum(quantity) AS BIGINT) AS units_sold, {_NET} AS total_sales FROM star GROUP BY product_id, product_name"""),
    "category_waterfall": _on_star("""SELECT category, CAST(net AS DOUBLE) AS total_sales,
        CAST(sum(net) OVER (ORDER BY net DESC, category ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running_total,
        CAST(net AS DOUBLE) / CAST(sum(net) OVER () AS DOUBLE) AS share
        FROM (SELECT category, sum(net_amount) AS net FROM star GROUP BY category)"""),
    "purchase_frequency_hist": _on_star(f"SELECT purchases, count(*) AS customers FROM ({_PURCHASES}) GROUP BY purchases"),
    "customer_segments": _on_star(f"SELECT customer_id, lifetime_value, segment FROM {_SEGMENTS}"),
    "customer_segment_summary": _on_star(f"""SELECT segment, count(*) AS customers, CAST(sum(value) AS DOUBLE) AS total_ltv,
        CAST(sum(value) AS DOUBLE) / count(*) AS avg_ltv FROM {_SEGMENTS} GROUP BY segment"""),
    "rfm": _on_star(f"""SELECT customer_id, CAST(DATE '2001-12-31' - max(date_value) AS INTEGER) AS recency_days,
        count(*) AS frequency, {_NET} AS monetary FROM star GROUP BY customer_id"""),
    "store_performance": _on_star(f"""SELECT location_id, store_name, state, region, count(*) AS transactions,
        count(DISTINCT customer_key) AS unique_customers, {_NET} AS total_sales, {_AVG} AS avg_ticket FROM star
        GROUP BY location_id, store_name, state, region"""),
    "top_stores": _on_star(f"""SELECT location_id, store_name, {_NET} AS total_sales FROM star GROUP BY location_id, store_name
        ORDER BY total_sales DESC, location_id LIMIT 10"""),
    "regional_trend": _on_star(f"SELECT region, year, month, {_NET} AS total_sales FROM star GROUP BY ALL"),
    "sliced_sales": _on_star(f"SELECT region, category, {_KPIS} FROM star WHERE {_SLICE} GROUP BY region, category"),
    "calendar_rollup": _on_star(f"""SELECT year, month, day, CAST(grouping(year, month, day) AS INTEGER) AS level,
        {_NET} AS total_sales, count(*) AS transactions FROM star GROUP BY ROLLUP (year, month, day)"""),
    "fiscal_year_sales": _on_star(f"SELECT fiscal_year, {_NET} AS total_sales, count(*) AS transactions FROM star GROUP BY ALL"),
    "seasonality_index": _on_star(f"""SELECT month, CAST(sum(net) AS DOUBLE) / count(net) AS avg_sales,
        CAST(sum(net) AS DOUBLE) / count(net) / (SELECT CAST(sum(net) AS DOUBLE) / count(net) FROM ({_MONTHS})) AS seasonality_index
        FROM ({_MONTHS}) GROUP BY month"""),
    "seasonal_factors": _on_star(f"""SELECT month, years, mean / 1e9 AS mean_ratio,
          CAST(mean AS DOUBLE) * (count(mean) OVER ()) / CAST(sum(mean) OVER () AS DOUBLE) AS seasonal_factor
        FROM (SELECT a.month, count(*) AS years,
            CAST(floor(CAST(sum(floor(CAST(a.net AS DOUBLE) * 24 / CAST(c.twice AS DOUBLE) * 1e9::DOUBLE + 0.5)) AS DOUBLE) / count(*) + 0.5) AS BIGINT) AS mean
          FROM ({_MONTHS}) a JOIN (SELECT m.year, m.month, sum(o.net * CASE WHEN abs(o.year * 12 + o.month - m.year * 12 - m.month) = 6 THEN 1 ELSE 2 END) AS twice
            FROM ({_MONTHS}) m JOIN ({_MONTHS}) o ON o.year * 12 + o.month BETWEEN m.year * 12 + m.month - 6 AND m.year * 12 + m.month + 6
            GROUP BY m.year, m.month HAVING count(*) = 13) c ON c.year = a.year AND c.month = a.month
          GROUP BY a.month)"""),
    "rls_store_filter": _on_star(f"""SELECT location_id, count(*) AS sales, {_NET} AS net_amount FROM star
        WHERE state = 'NATION_7' GROUP BY location_id"""),
    "rls_region_filter": _on_star(f"SELECT count(*) AS sales, {_NET} AS net_amount FROM star WHERE region = 'ASIA'"),
    "table_row_counts": _on_star(_union([f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in _COUNTS])),
    "table_counts_wide": _on_star("SELECT 'Summary' AS description, " + ", ".join(
        f"(SELECT count(*) FROM {t}) AS {n}" for t, n in _COUNTS.items())),
    "null_key_profile": _on_star("SELECT count(*) AS total_rows, " + ", ".join(
        f"count({k}) AS valid_{n}, count(*) - count({k}) AS null_{n}" for k, n in _PLURAL.items()) + " FROM resolved"),
    "null_key_verdict": _on_star(f"""SELECT CASE WHEN count(*) > 0 THEN 'FAIL: Null keys found in sales_fact' ELSE 'PASS' END AS null_check,
        count(*) AS null_rows FROM resolved WHERE {_NO_KEY}"""),
    "orphan_checks": _on_star(_union([
        f"SELECT 'Orphaned {n}' AS check_type, ({_orphans(c, t)}) AS orphan_count" for n, c, t in (
            ("Customers", "customer_key", "customer_dim"), ("Products", "product_key", "product_dim"),
            ("Locations", "location_key", "location_dim"), ("Dates", "date_key", "date_dim"))])),
    "cross_table_ri": _on_raw(_union([_unknown(_RAW_ID[t], f"raw_{t}") for t in ("customers", "products", "locations")])),
    "anomaly_counts": _on_star(_union([
        f"SELECT '{n}' AS anomaly_type, count(*) AS anomalies FROM sales_fact WHERE {c}" for n, c in (
            ("Negative Quantities", "quantity < 0"), ("Negative Prices", "unit_price < 0"),
            ("Zero Sales Amount", "net_amount = 0"), ("Gross < Net (Invalid)", "gross_amount < net_amount"))])),
    "raw_rule_report": _on_raw(_union(
        [_rule_row(t, f"raw_{t}", c, r, cond) for t, c, r, cond in _RAW_RULES]
        + [_unique_row(t, f"raw_{t}", _RAW_ID[t]) for t in ("customers", "products", "locations")])),
    "curated_rule_report": _on_star(_union(
        [_rule_row("customer_dim", "customer_dim", c, r, cond) for c, r, cond in (
            ("customer_key", "not_null", "customer_key IS NULL"), ("customer_key", "at_least_0", "customer_key < 0"),
            ("customer_id", "not_null", "customer_id IS NULL"),
            ("email", "pattern", r"NOT regexp_matches(email, '^[\pL\pM\p{Nd}\p{Pc}.-]+@[\pL\pM\p{Nd}\p{Pc}.-]+\.[\pL\pM\p{Nd}\p{Pc}]+$')"))]
        + [_unique_row("customer_dim", "customer_dim", c) for c in ("customer_key", "customer_id")]
        + [_rule_row("sales_fact", _KEYED_FACT, c, "not_null", f"{c} IS NULL")
           for c in ("sale_key", "customer_key", "product_key", "location_key", "date_key", "quantity", "gross_amount", "net_amount")]
        + [_rule_row("sales_fact", _KEYED_FACT, c, r, cond) for c, r, cond in (
            ("sale_key", "at_least_0", "sale_key < 0"), ("quantity", "more_than_0", "quantity <= 0"),
            ("gross_amount", "at_least_0", "gross_amount < 0"), ("net_amount", "at_least_0", "net_amount < 0"))]
        + [_unique_row("sales_fact", _KEYED_FACT, "sale_key")])),
    "duplicate_keys": _on_star(_union(
        [_duplicates(t, f"raw_{t}", c) for t, c in _RAW_ID.items()]
        + [_duplicates(t, t, f"{n}_{k}") for t, n in _DIM_KEYS.items() for k in ("id", "key")]
        + [_duplicates("date_dim", "date_dim", "date_key"), _duplicates("date_dim", "date_dim", "date_value"),
           _duplicates("sales_fact", _KEYED_FACT, "sale_key"), _duplicates("sales_fact", "sales_fact", "sale_id")])),
    "failure_cases": _on_raw(_union([
        f"SELECT '{t}' AS table_name, {_RAW_ID[t]} AS row_id, '{c}' AS column_name, '{r}' AS rule, {c} AS value "
        f"FROM raw_{t} WHERE {cond}" for t, c, r, cond in _RAW_RULES])),
    "constraint_report": _on_star(_union(
        [_rule_row(t, t, f"{n}_{k}", "not_null", f"{n}_{k} IS NULL") for t, n in _DIM_KEYS.items() for k in ("key", "id")]
        + [_rule_row("product_dim", "product_dim", c, "at_least_0", f"{c} < 0") for c in ("unit_price", "cost")]
        + [_rule_row("product_dim", "product_dim", "margin", "fits_type", "unit_price > 0 AND cost IS NOT NULL AND margin IS NULL")]
        + [_rule_row("date_dim", "date_dim", c, "not_null", f"{c} IS NULL") for c in ("date_key", "date_value")]
        + [_rule_row("date_dim", "date_dim", c, f"between_1_{n}", f"{c} NOT BETWEEN 1 AND {n}")
           for c, n in (("quarter", 4), ("month", 12), ("day", 31), ("day_of_week", 7))]
        + [_rule_row("sales_fact", _KEYED_FACT, c, "not_null", f"{c} IS NULL") for c in ("sale_key", *_FACT_NOT_NULL)]
        + [_rule_row("sales_fact", "sales_fact", c, r, cond) for c, r, cond in (
            ("quantity", "more_than_0", "quantity <= 0"), ("gross_amount", "at_least_0", "gross_amount < 0"),
            ("net_amount", "at_least_0", "net_amount < 0"))])),
    "expectation_suite": _on_star(_union([
        f"SELECT {i} AS position, '{kind}' AS expectation, {column} AS column_name, ({count}) AS unexpected, ({count}) = 0 AS success"
        for i, (kind, column, count) in enumerate([
            ("column_exists", "'customer_key'", "SELECT CAST(0 AS BIGINT)"), ("column_exists", "'product_key'", "SELECT CAST(0 AS BIGINT)"),
            ("column_exists", "'net_amount'", "SELECT CAST(0 AS BIGINT)"),
            ("not_null", "'customer_key'", "SELECT count(*) FROM sales_fact WHERE customer_key IS NULL"),
            ("not_null", "'product_key'", "SELECT count(*) FROM sales_fact WHERE product_key IS NULL"),
            ("not_null", "'date_key'", "SELECT count(*) FROM sales_fact WHERE date_key IS NULL"),
            ("between", "'quantity'", "SELECT count(*) FROM sales_fact WHERE quantity < 1 OR quantity > 10000"),
            ("between", "'net_amount'", "SELECT count(*) FROM sales_fact WHERE net_amount < 0"),
            ("unique", "'sale_key'", f"SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM {_repeated(_KEYED_FACT, 'sale_key')}"),
            ("row_count_at_least", "NULL", "SELECT CASE WHEN count(*) >= 1 THEN CAST(0 AS BIGINT) ELSE 1 END FROM sales_fact"),
        ])])),
    "business_rule_check": _on_star(_union(
        ["SELECT 'gross = quantity * unit_price' AS rule, count(*) AS violations, count(*) = 0 AS passed FROM sales_fact WHERE gross_amount <> quantity * unit_price",
         "SELECT 'net = gross - discount + tax', count(*), count(*) = 0 FROM sales_fact WHERE net_amount <> gross_amount - discount_amount + tax_amount"]
        + [f"SELECT 'unique {t}.{c}', count(*), count(*) = 0 FROM {_repeated(s, c)}" for t, s, c in (
            ("customer_dim", "customer_dim", "customer_key"), ("product_dim", "product_dim", "product_key"),
            ("location_dim", "location_dim", "location_key"), ("date_dim", "date_dim", "date_key"),
            ("sales_fact", _KEYED_FACT, "sale_key"))])),
    "negative_values": _on_star("""SELECT count(*) FILTER (WHERE quantity < 0) AS negative_quantity,
        count(*) FILTER (WHERE net_amount < 0) AS negative_amount,
        count(*) FILTER (WHERE quantity < 0 OR net_amount < 0) = 0 AS passed FROM sales_fact"""),
    "future_dates": _on_star("""SELECT count(*) AS future_date_count, count(*) = 0 AS passed
        FROM sales_fact JOIN date_dim USING (date_key) WHERE date_value > DATE '2001-06-30'"""),
    "quality_verdict": _on_star(f"""SELECT CASE WHEN max(violations) OVER () = 0 THEN 'PASSED' ELSE 'FAILED' END AS overall_status,
        check_name, violations, violations = 0 AS passed FROM (
          SELECT 'Null Foreign Keys' AS check_name, count(*) AS violations FROM resolved WHERE {_NO_KEY}
          UNION ALL SELECT 'Negative Values', count(*) FILTER (WHERE quantity < 0) + count(*) FILTER (WHERE net_amount < 0) FROM resolved
          UNION ALL SELECT 'Future Dates', count(*) FROM resolved JOIN date_dim USING (date_key) WHERE date_value > DATE '2001-06-30'
          UNION ALL SELECT 'Orphaned Records', ({_orphans('customer_key', 'customer_dim')}) + ({_orphans('product_key', 'product_dim')}))"""),
    "data_freshness": """SELECT event_type, strftime(last_modified, '%Y-%m-%d %H:%M:%S.%f') AS last_modified,
        round(seconds * 100 / 3600.0) / 100 AS age_hours, seconds <= 24 * 3600 AS fresh, 24 AS threshold_hours,
        CASE WHEN seconds <= 24 * 3600 THEN 'FRESH' ELSE 'STALE' END AS status
        FROM (SELECT event_type, max(ts) AS last_modified,
              CAST(epoch(TIMESTAMP '2024-01-30 12:00:00') - floor(epoch(max(ts))) AS BIGINT) AS seconds FROM events GROUP BY event_type)""",
    "job_health": """SELECT user_id AS job_name,
        max(CASE WHEN n = 1 THEN CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'signup' THEN 'RUNNING' ELSE 'SUCCEEDED' END END) AS last_run_status,
        strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS last_run_time,
        CAST(count(*) FILTER (WHERE event_type NOT IN ('error', 'signup')) AS DOUBLE) / count(*) * 100 AS success_rate,
        coalesce(CAST(sum(CAST(value AS DECIMAL(18,2))) FILTER (WHERE event_type <> 'signup') AS DOUBLE)
          / nullif(count(value) FILTER (WHERE event_type <> 'signup'), 0), 0) AS avg_duration_minutes
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events)
        WHERE n <= 5 GROUP BY user_id""",
    "calendar_validity": _on_star("""SELECT 'unique' AS check_name, count(*) - count(DISTINCT date_value) AS violations,
          count(*) = count(DISTINCT date_value) AS passed FROM date_dim
        UNION ALL SELECT 'gap_free', count(*), count(*) = 0
          FROM (SELECT date_value, lead(date_value) OVER (ORDER BY date_value) AS next FROM date_dim) WHERE next <> date_value + 1
        UNION ALL SELECT 'covers_fact', count(*), count(*) = 0
          FROM sales_fact WHERE date_key NOT IN (SELECT date_key FROM date_dim)"""),
    "column_profile": _on_star(_union([_profile(t, c) for t, c in _COLUMNS.items()])),
    "cdc_merge": """WITH latest AS (SELECT o_custkey, o_orderpriority, o_orderstatus,
          row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS n FROM orders)
        SELECT c_custkey, CASE WHEN o_custkey IS NULL THEN c_mktsegment ELSE o_orderpriority END AS last_order
        FROM customer FULL JOIN (SELECT * FROM latest WHERE n = 1) ON c_custkey = o_custkey
        WHERE o_custkey IS NULL OR o_orderstatus <> 'P'""",
    "scd2_customer": """WITH per_day AS (
          SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, max(o_orderpriority) AS o_orderpriority FROM orders GROUP BY 1, 2),
        changed AS (SELECT * FROM (SELECT *, lag(o_orderpriority) OVER (PARTITION BY o_custkey ORDER BY day) AS before FROM per_day)
          WHERE before IS NULL OR before <> o_orderpriority)
        SELECT o_custkey, o_orderpriority, strftime(day, '%Y-%m-%d') AS valid_from,
          strftime(lead(day) OVER w, '%Y-%m-%d') AS valid_to, lead(day) OVER w IS NULL AS is_current
        FROM changed WINDOW w AS (PARTITION BY o_custkey ORDER BY day)""",
    "scd2_late_versions": """WITH days AS (SELECT o_orderkey % 5 = 0 AS late, o_custkey, CAST(o_orderdate AS DATE) AS day,
            max(o_orderpriority) AS p FROM orders GROUP BY ALL),
        stored AS (SELECT * FROM (SELECT o_custkey, day, p, lag(p) OVER (PARTITION BY o_custkey ORDER BY day) AS before FROM days WHERE NOT late)
          WHERE before IS NULL OR before <> p),
        versions AS (SELECT o_custkey, day, p FROM days WHERE late UNION ALL SELECT o_custkey, day, p FROM stored
          WHERE (o_custkey, day) NOT IN (SELECT (o_custkey, day) FROM days WHERE late)),
        changed AS (SELECT * FROM (SELECT *, lag(p) OVER (PARTITION BY o_custkey ORDER BY day) AS before FROM versions)
          WHERE before IS NULL OR before <> p)
        SELECT o_custkey, p AS o_orderpriority, strftime(day, '%Y-%m-%d') AS valid_from,
          strftime(lead(day) OVER w, '%Y-%m-%d') AS valid_to, lead(day) OVER w IS NULL AS is_current
        FROM changed WINDOW w AS (PARTITION BY o_custkey ORDER BY day)""",
    "shipments_as_of": """WITH days AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, max(o_orderpriority) AS p FROM orders GROUP BY 1, 2),
        shipped AS (SELECT o_custkey, CAST(l_shipdate AS DATE) AS day FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
        SELECT p AS priority_when_shipped, count(*) AS shipments, count(DISTINCT s.o_custkey) AS customers
        FROM shipped s ASOF LEFT JOIN days d ON s.o_custkey = d.o_custkey AND s.day >= d.day GROUP BY p""",
    "stream_sales": """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, user_id, value
        FROM events WHERE event_type = 'purchase'""",
}
ORACLE["cdc_merge_buckets"] = ORACLE["cdc_merge"]
# Answers from stored group-bys are those of the fact.
ORACLE |= {f"{q}_from_lattice": ORACLE[q] for q in (
    "sliced_sales", "kpi_summary", "regional_performance", "regional_trend", "fiscal_year_sales")}
ORACLE["lattice_after_failed_append"] = ORACLE["sliced_sales"]
ORACLE["compact_small_files"] = ORACLE["load_append_idempotent"]
