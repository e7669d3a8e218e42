"""Independent SQL statement of every registered query (DuckDB dialect).

Each statement is a CTE chain over the driver's tables (``lineitem``, ``orders``,
``customer``, ``nation``, ``region``, ``part`` views).  It restates the rules in
SQL rather than calling the Spark code, so a shared bug cannot hide.

Agreement notes (see SURVEY §5): DuckDB sums integers to HUGEINT, so counts and
integer sums are cast to BIGINT; money sums use the same exact-cents form as the
Spark queries (``exact_money=True``); dedup ordering spells out NULLS FIRST,
which is Spark's ascending default.
"""

from __future__ import annotations

from tiers.sources import synthetic as syn

# ---- the chain ------------------------------------------------------------------------

FEED = """
feed AS (
  SELECT
    CASE WHEN l.l_orderkey % 1009 = 0 THEN CAST(NULL AS VARCHAR)
         ELSE 'ORD-' || CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) END AS order_id,
    'CUST-' || CAST(o.o_custkey AS VARCHAR) AS customer_id,
    p.p_name AS product,
    p.p_type AS category,
    CASE WHEN l.l_orderkey % 997 = 0 THEN 'n/a'
         WHEN l.l_quantity >= 50 THEN '0'
         ELSE CAST(CAST(trunc(l.l_quantity) AS INTEGER) AS VARCHAR) END AS quantity,
    CASE WHEN l.l_partkey % 97 = 0 THEN '-1.00'
         ELSE CAST(CAST(l.l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) END AS unit_price,
    CASE WHEN l.l_orderkey % 991 = 0 THEN '31/12/1999'
         ELSE CAST(CAST(o.o_orderdate AS DATE) AS VARCHAR) END AS order_date,
    r.r_name AS region,
    CASE WHEN l.l_suppkey % 41 = 0 THEN 'unknown'
         WHEN o.o_orderstatus = 'F' THEN 'completed'
         WHEN o.o_orderstatus = 'O' THEN 'pending'
         WHEN o.o_orderstatus = 'P' THEN 'cancelled' END AS status
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  JOIN part p ON l.l_partkey = p.p_partkey
)"""

TYPED = """
typed0 AS (
  SELECT order_id, customer_id, product, category,
         TRY_CAST(quantity AS INTEGER) AS quantity,
         TRY_CAST(unit_price AS DOUBLE) AS unit_price,
         CAST(TRY_STRPTIME(order_date, '%Y-%m-%d') AS DATE) AS order_date,
         region, status
  FROM feed
),
typed AS (
  SELECT *, quantity * unit_price AS total_amount, strftime(order_date, '%Y-%m') AS year_month
  FROM typed0
)"""

DEDUP = """
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY order_id
    ORDER BY customer_id NULLS FIRST, product NULLS FIRST, category NULLS FIRST, quantity NULLS FIRST,
             unit_price NULLS FIRST, order_date NULLS FIRST, region NULLS FIRST, status NULLS FIRST) AS rn
  FROM typed
),
dedup AS (SELECT * EXCLUDE (rn) FROM ranked WHERE rn = 1)"""

SILVER = """
silver AS (
  SELECT * FROM dedup
  WHERE order_id IS NOT NULL AND quantity > 0 AND unit_price > 0
    AND status IN ('completed', 'pending', 'cancelled')
)"""


def _cents(x: str) -> str:
    return f"CAST(ROUND({x} * 100.0) AS BIGINT)"


def _money_sum(x: str) -> str:
    return f"(CAST(SUM({_cents(x)}) AS DOUBLE) / CAST(100 AS DOUBLE))"


def _money_avg(x: str) -> str:
    return f"({_money_sum(x)} / COUNT({_cents(x)}))"


GOLD = f"""
gold_sales AS (
  SELECT region, year_month,
         {_money_sum('total_amount')} AS total_revenue,
         COUNT(order_id) AS order_count,
         {_money_avg('total_amount')} AS avg_order_value,
         COUNT(DISTINCT customer_id) AS unique_customers
  FROM silver WHERE status = 'completed'
  GROUP BY region, year_month
),
gold_products AS (
  SELECT product, category,
         {_money_sum('total_amount')} AS total_revenue,
         CAST(SUM(quantity) AS BIGINT) AS total_units_sold,
         COUNT(order_id) AS order_count,
         {_money_avg('unit_price')} AS avg_unit_price
  FROM silver WHERE status = 'completed'
  GROUP BY product, category
)"""

SUMMARY = f"""
summary AS (
  SELECT ROUND({_money_sum('total_revenue')}, 2) AS total_revenue,
         CAST(SUM(order_count) AS BIGINT) AS total_orders,
         ROUND(AVG(avg_order_value), 2) AS avg_order_value
  FROM gold_sales
)"""

FEED_CASTABLE = (FEED.replace("""    CASE WHEN l.l_orderkey % 997 = 0 THEN 'n/a'
         WHEN l.l_quantity >= 50 THEN '0'""", """    CASE WHEN l.l_quantity >= 50 THEN '0'""")
                 .replace("""    CASE WHEN l.l_orderkey % 991 = 0 THEN '31/12/1999'
         ELSE CAST(CAST(o.o_orderdate AS DATE) AS VARCHAR) END AS order_date,""",
                          """    CAST(CAST(o.o_orderdate AS DATE) AS VARCHAR) AS order_date,"""))

TYPED_STRICT = """
typed0 AS (
  SELECT order_id, customer_id, product, category,
         CAST(quantity AS INTEGER) AS quantity,
         CAST(unit_price AS DOUBLE) AS unit_price,
         CAST(strptime(order_date, '%Y-%m-%d') AS DATE) AS order_date,
         region, status
  FROM feed
),
typed AS (
  SELECT *, quantity * unit_price AS total_amount, strftime(order_date, '%Y-%m') AS year_month
  FROM typed0
)"""

_STAGES = {"feed": [FEED], "typed_strict": [FEED_CASTABLE, TYPED_STRICT], "typed": [FEED, TYPED], "dedup": [FEED, TYPED, DEDUP],
           "silver": [FEED, TYPED, DEDUP, SILVER], "gold": [FEED, TYPED, DEDUP, SILVER, GOLD],
           "summary": [FEED, TYPED, DEDUP, SILVER, GOLD, SUMMARY]}


def chain(stage: str, body: str) -> str:
    return "WITH " + ",".join(_STAGES[stage]) + "\n" + body


# ---- synthetic orders -----------------------------------------------------------------

def _synthetic_sql(seed: int = 42) -> str:
    p = syn.MODULUS
    fields = ["customer", "product", "quantity", "price", "date", "region", "status"]
    u = ", ".join(f"((id % {p}) * {syn.MULT_A} + (id // {p} % {p}) * {syn.MULT_Q} + {syn.salt(seed, f)}) % {p} AS u_{f}" for f in fields)
    v = ", ".join(f"(u_{f} * u_{f} + {syn.SQUARE_OFFSET}) % {p} AS v_{f}" for f in fields)
    w = ", ".join(f"(v_{f} * {syn.MULT_B} + u_{f}) % {p} AS w_{f}" for f in fields)
    names = ", ".join(f"'{n}'" for n, _, _ in syn.PRODUCTS)
    cats = ", ".join(f"'{c}'" for _, c, _ in syn.PRODUCTS)
    bases = ", ".join(str(round(b * 100)) for _, _, b in syn.PRODUCTS)
    regions = ", ".join(f"'{r}'" for r in syn.REGIONS)
    total_share = sum(s for _, s in syn.STATUS_SHARES)
    status, upper = "CASE", 0
    for name, share in syn.STATUS_SHARES:
        upper += share
        status += f" WHEN w_status % {total_share} < {upper} THEN '{name}'"
    status += " END"
    return f"""
WITH ids AS (SELECT o_orderkey + 1 AS id FROM orders),
u AS (SELECT id, {u} FROM ids),
v AS (SELECT id, {", ".join(f"u_{f}" for f in fields)}, {v} FROM u),
w AS (SELECT id, {", ".join(f"u_{f}" for f in fields)}, {w} FROM v),
priced AS (
  SELECT *, w_product % {len(syn.PRODUCTS)} AS prod,
         ([{bases}][w_product % {len(syn.PRODUCTS)} + 1] * (w_price % {syn.PRICE_FACTOR_STEPS} + {syn.PRICE_FACTOR_MIN})
          + 5000) // 10000 AS price_cents
  FROM w
)
SELECT printf('{syn.ORDER_ID_FORMAT}', id) AS order_id,
       printf('{syn.CUSTOMER_ID_FORMAT}', w_customer % {syn.CUSTOMERS} + 1) AS customer_id,
       [{names}][prod + 1] AS product,
       [{cats}][prod + 1] AS category,
       CAST(w_quantity % {syn.MAX_QUANTITY} + 1 AS VARCHAR) AS quantity,
       CAST(price_cents // 100 AS VARCHAR) || '.' || lpad(CAST(price_cents % 100 AS VARCHAR), 2, '0') AS unit_price,
       strftime(DATE '{syn.BASE_DATE.isoformat()}' + CAST(w_date % {syn.DAY_SPAN} AS INTEGER), '%Y-%m-%d') AS order_date,
       [{regions}][w_region % {len(syn.REGIONS)} + 1] AS region,
       {status} AS status
FROM priced"""


# ---- the statements -------------------------------------------------------------------

_LANDING_COLUMNS = "order_id, customer_id, product, category, quantity, unit_price, order_date, region, status"
_SILVER_COUNTS = """
SELECT 'bronze_orders' AS table_name, CAST(COUNT(*) AS BIGINT) AS row_count FROM feed
UNION ALL SELECT 'silver_orders', CAST(COUNT(*) AS BIGINT) FROM silver
UNION ALL SELECT 'gold_sales_by_region', CAST(COUNT(*) AS BIGINT) FROM gold_sales
UNION ALL SELECT 'gold_top_products', CAST(COUNT(*) AS BIGINT) FROM gold_products
UNION ALL SELECT 'duplicates', (SELECT COUNT(*) FROM feed) - (SELECT COUNT(*) FROM dedup)
UNION ALL SELECT 'quality_drops', (SELECT COUNT(*) FROM dedup) - (SELECT COUNT(*) FROM silver)"""


_FILE_TOTALS = f"""
SELECT TRUE AS has_files, TRUE AS all_csv, TRUE AS distinct_names,
       CAST(SUM({" + ".join(f"strlen(coalesce({c}, ''))" for c in _LANDING_COLUMNS.split(", "))} + 8 + 1)
            AS BIGINT) AS payload_bytes
FROM feed"""


def statements() -> dict[str, str]:
    return {
        "bronze_orders": chain("feed", "SELECT * FROM feed"),
        "landing_inventory": chain("feed", _FILE_TOTALS),
        "landing_totals": chain("feed", _FILE_TOTALS),
        "preflight_report": chain("feed", f"""
SELECT '2024-03-31' AS run_date, TRUE AS has_csv, CAST(COUNT(*) AS BIGINT) AS "rows",
       CAST(9 AS INTEGER) AS cols, '{_LANDING_COLUMNS}' AS "columns", TRUE AS passed,
       CAST(NULL AS VARCHAR) AS reason
FROM feed"""),
        "preflight_outcomes": chain("feed", """
SELECT 'full' AS landing, TRUE AS has_csv, CAST(COUNT(*) AS BIGINT) AS "rows", TRUE AS passed,
       CAST(NULL AS VARCHAR) AS reason FROM feed
UNION ALL SELECT 'header_only', TRUE, 0, FALSE, 'landing folder has no rows'
UNION ALL SELECT 'text_only', FALSE, 0, FALSE, 'no CSV files in landing folder'
UNION ALL SELECT 'missing', FALSE, 0, FALSE, 'landing folder not found'"""),
        "gold_sales_plain": chain("silver", """
SELECT region, year_month, ROUND(SUM(total_amount), 2) AS total_revenue, COUNT(order_id) AS order_count,
       ROUND(AVG(total_amount), 8) AS avg_order_value, COUNT(DISTINCT customer_id) AS unique_customers
FROM silver WHERE status = 'completed' GROUP BY region, year_month"""),
        "gold_products_plain": chain("silver", """
SELECT product, category, ROUND(SUM(total_amount), 2) AS total_revenue,
       CAST(SUM(quantity) AS BIGINT) AS total_units_sold, COUNT(order_id) AS order_count,
       ROUND(AVG(unit_price), 8) AS avg_unit_price
FROM silver WHERE status = 'completed' GROUP BY product, category"""),
        "widget_sql_revenue_by_region": chain("gold", """
SELECT region, ROUND(SUM(total_revenue), 2) AS total_revenue FROM gold_sales GROUP BY region"""),
        "widget_sql_revenue_trend": chain("gold", """
SELECT year_month, ROUND(SUM(total_revenue), 2) AS total_revenue FROM gold_sales GROUP BY year_month"""),
        "cast_quantity": chain("feed", """
SELECT order_id, quantity AS quantity_raw, TRY_CAST(quantity AS INTEGER) AS quantity FROM feed"""),
        "cast_unit_price": chain("feed", """
SELECT order_id, unit_price AS unit_price_raw, TRY_CAST(unit_price AS DOUBLE) AS unit_price FROM feed"""),
        "parse_order_date": chain("feed", """
SELECT order_id, order_date AS order_date_raw,
       CAST(TRY_STRPTIME(order_date, '%Y-%m-%d') AS DATE) AS order_date FROM feed"""),
        "year_month": chain("typed", "SELECT order_id, order_date, year_month FROM typed"),
        "total_amount": chain("typed", "SELECT order_id, quantity, unit_price, total_amount FROM typed"),
        "silver_typed": chain("typed", "SELECT * FROM typed"),
        "dedup_orders": chain("dedup", "SELECT * FROM dedup"),
        "dedup_faithful_keys": chain("feed", "SELECT DISTINCT order_id FROM feed"),
        "silver_typed_strict": chain("typed_strict", "SELECT * FROM typed"),
        "filter_not_null": chain("dedup", "SELECT * FROM dedup WHERE order_id IS NOT NULL"),
        "filter_positive": chain("dedup", "SELECT * FROM dedup WHERE quantity > 0 AND unit_price > 0"),
        "filter_status_in": chain("dedup", """
SELECT * FROM dedup WHERE status IN ('completed', 'pending', 'cancelled')"""),
        "filter_completed": chain("silver", "SELECT * FROM silver WHERE status = 'completed'"),
        "silver_orders": chain("silver", "SELECT * FROM silver"),
        "silver_metrics": chain("silver", """
SELECT CAST((SELECT COUNT(*) FROM feed) AS BIGINT) AS bronze_rows,
       CAST((SELECT COUNT(*) FROM feed) - (SELECT COUNT(*) FROM dedup) AS BIGINT) AS duplicates,
       CAST((SELECT COUNT(*) FROM dedup) - (SELECT COUNT(*) FROM silver) AS BIGINT) AS quality_drops,
       CAST((SELECT COUNT(*) FROM silver) AS BIGINT) AS silver_rows"""),
        "gold_sales_by_region": chain("gold", "SELECT * FROM gold_sales"),
        "gold_top_products": chain("gold", "SELECT * FROM gold_products"),
        "gold_sales_table": chain("gold", "SELECT * FROM gold_sales"),
        "gold_products_table": chain("gold", "SELECT * FROM gold_products"),
        "schema_replace": chain("silver", "SELECT * FROM silver"),
        "placeholder_tables": chain("feed", """
SELECT 'bronze_orders' AS table_name, CAST(9 AS INTEGER) AS column_count,
       CAST(COUNT(*) AS BIGINT) AS row_count FROM feed
UNION ALL SELECT 'silver_orders', 11, CAST(0 AS BIGINT)
UNION ALL SELECT 'gold_sales_by_region', 6, CAST(0 AS BIGINT)
UNION ALL SELECT 'gold_top_products', 6, CAST(0 AS BIGINT)"""),
        "dataset_region_sales": chain("gold", """
SELECT region, year_month, total_revenue, order_count, avg_order_value, unique_customers
FROM gold_sales ORDER BY region NULLS FIRST, year_month NULLS FIRST"""),
        "dataset_top_products": chain("gold", """
SELECT product, category, total_revenue, total_units_sold, order_count, avg_unit_price
FROM gold_products ORDER BY total_revenue DESC"""),
        "dataset_summary_metrics": chain("summary", "SELECT * FROM summary"),
        "dataset_sql_summary_metrics": chain("summary", "SELECT * FROM summary"),
        "dataset_sql_top_products": chain("gold", """
SELECT product, category, total_revenue, total_units_sold, order_count, avg_unit_price
FROM gold_products ORDER BY total_revenue DESC"""),
        "dataset_sql_region_sales": chain("gold", """
SELECT region, year_month, total_revenue, order_count, avg_order_value, unique_customers
FROM gold_sales ORDER BY region NULLS FIRST, year_month NULLS FIRST"""),
        "widget_sql_total_orders": chain("summary", 'SELECT CAST(SUM(total_orders) AS BIGINT) AS "sum(total_orders)" FROM summary'),
        "widget_sql_avg_order_value": chain("summary", 'SELECT SUM(avg_order_value) AS "sum(avg_order_value)" FROM summary'),
        "widget_sql_total_revenue": chain("summary", 'SELECT SUM(total_revenue) AS "sum(total_revenue)" FROM summary'),
        "widget_sql_top_products": chain("gold", """
SELECT product, category, total_revenue, total_units_sold FROM gold_products"""),
        "widget_total_revenue": chain("summary", f"SELECT {_money_sum('total_revenue')} AS total_revenue FROM summary"),
        "widget_total_orders": chain("summary", "SELECT CAST(SUM(total_orders) AS BIGINT) AS total_orders FROM summary"),
        "widget_avg_order_value": chain("summary", "SELECT SUM(avg_order_value) AS avg_order_value FROM summary"),
        "widget_revenue_by_region": chain("gold", f"""
SELECT region, {_money_sum('total_revenue')} AS total_revenue FROM gold_sales GROUP BY region"""),
        "widget_revenue_trend": chain("gold", f"""
SELECT year_month, {_money_sum('total_revenue')} AS total_revenue FROM gold_sales GROUP BY year_month"""),
        "widget_top_products": chain("gold", """
SELECT product, category, total_revenue, total_units_sold FROM gold_products"""),
        "preview_orders": chain("feed", f"""
SELECT * FROM feed ORDER BY {", ".join(c + " NULLS FIRST" for c in _LANDING_COLUMNS.split(", "))} LIMIT 5"""),
        "synthetic_orders": _synthetic_sql(42),
        "full_refresh": chain("gold", _SILVER_COUNTS),
    }
