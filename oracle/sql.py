"""Independent ANSI-SQL (DuckDB) statement of every registered query.

Written the straightforward way: per-key windows for SCD2, a global NTILE
for RFM, float-free money (DECIMAL sums, integer half-up rounding). Each
query is assembled as ``WITH <the CTEs it needs> SELECT ...`` over the
driver's pre-registered tables.
"""

from __future__ import annotations

# Fixed values, written out here on purpose: nothing is imported from the
# package, so a wrong value there shows as a difference.
LO, HI = "1997-01-01 00:00:00", "1998-12-31 23:59:59"
AS_OF = "2002-01-01"
ACQUIRED_SINCE = "1995-07-02"  # 90 days before 1995-09-30
RUN_TS = "2002-01-01 00:00:00"
PAYMENT_METHODS = ("Cash", "Credit Card", "Debit Card", "Mobile Pay", "Gift Card", "UPI", "Net Banking")
SCD2_TRACK = {
    "customers": ("name", "email", "address", "phone_number", "gender"),
    "products": ("name", "category", "brand", "price", "description", "color", "size"),
    "stores": ("name", "address", "manager", "status"),
}
CATEGORY_FAMILIES = (
    ("footwear", "shoe|sandal|chappal|loafer|slipper|boot"),
    ("accessories", "belt|cap|scarf|socks|muffler|backpack"),
    ("ethnic", "saree|salwar|kameez|lehenga|kurti|dupatta|anarkali|churidar|kurta|sherwani|nehru|dhoti|pajama|pathani"),
    ("sport", "track|sport|active|gym|workout|jersey"),
    ("formal", "shirt|blazer|suit|tie|formal"),
    ("winter", "jacket|sweater|hoodie|sweatshirt"),
    ("party", "gown|dress|party"),
)
EVENT_RANGE = f"event_time >= TIMESTAMP '{LO}' AND event_time <= TIMESTAMP '{HI}'"
DATE_RANGE = f"sale_date >= TIMESTAMP '{LO}' AND sale_date <= TIMESTAMP '{HI}'"


def _in(values) -> str:
    return ", ".join("'" + v + "'" for v in values)


def money(x: str) -> str:
    return f"CAST({x} AS DECIMAL(28,6))"


def r2(num_hundredths: str, den: str) -> str:
    """ROUND(n / d, 2), half away from zero, from 100 * n (up to four decimals) and an integer d."""
    n, d = f"CAST({num_hundredths} AS DECIMAL(30,4))", f"CAST({den} AS HUGEINT)"
    sign = f"(CASE WHEN ({n} < 0) <> ({d} < 0) THEN -1 ELSE 1 END)"
    whole = f"CAST(abs({n}) * 10000 AS HUGEINT)"
    return (f"(CASE WHEN {d} = 0 THEN NULL ELSE CAST({sign} * ((2 * {whole} + 10000 * abs({d})) // (20000 * abs({d}))) "
            f"AS DOUBLE) / 100 END)")


def round2(dec: str) -> str:
    return f"CAST(round({dec}, 2) AS DOUBLE)"


def cents(dec: str) -> str:
    return f"CAST({dec} AS DECIMAL(28,6)) * 100"


def msum(col: str) -> str:
    """ROUND(SUM(money), 2) as double."""
    return round2(f"sum({money(col)})")


def ok(pred: str) -> str:
    return f"coalesce(({pred}), false)"


# --- landing-shaped feeds (FIXTURES.md section 2) -------------------------------
FEEDS = {
    "sales": """
with b as (
 select l.*, o.o_custkey, o.o_orderkey, o.o_orderpriority,
  case when l_returnflag = 'R' and l_linenumber = 7 then -cast(l_quantity as bigint)
       when l_linenumber = 1 and l_suppkey % 25 = 0 then 0 else cast(l_quantity as bigint) end as quantity,
  (l_partkey * 37) % 20000 + 90000 as cents
 from lineitem l join orders o on l.l_orderkey = o.o_orderkey),
t as (select *, cast(quantity as hugeint) * cents * case when cents <= 100000 then 5 else 12 end as tax_parts from b)
select cast(l_orderkey as bigint) as transaction_id,
 cast(case when l_suppkey % 20 = 9 then l_suppkey + 10000000 else l_suppkey end as bigint) as store_id,
 cast(l_shipdate + l_linenumber * interval '1' hour as timestamp) as event_time,
 cast(case when o_orderkey % 37 = 5 then o_custkey + 10000000 else o_custkey end as bigint) as customer_id,
 cast(l_partkey as bigint) as product_id, quantity,
 cast(cents as double) / 100 as unit_price, cast(quantity * cents as double) / 100 as total_amount,
 case o_orderpriority when '1-URGENT' then 'Credit Card' when '2-HIGH' then 'UPI' when '3-MEDIUM' then 'Cash'
  when '4-NOT SPECIFIED' then 'Net Banking' else 'Cheque' end as payment_method,
 case when l_partkey % 50 = 0 then -(l_discount + 0.01e0) else l_discount end as discount_applied,
 cast(case when tax_parts < 0 then -((50 - tax_parts) // 100) else (tax_parts + 50) // 100 end as double) / 100 as tax_amount
from t""",
    "customers": """
with x as (select *, unnest(range(0, c_custkey % 4 + 1)) as v from customer)
select cast(c_custkey as bigint) as customer_id, c_name as name,
 case when c_custkey % 50 = 0 or (v = 1 and c_custkey % 3 = 0) then null when c_custkey % 50 = 1 then 'bad-email'
  when v = 2 then concat(c_name, '.new@x.io') else concat(c_name, '@x.io') end as email,
 concat('addr ', cast(c_nationkey + case when v = 3 then 100 else 0 end as varchar), chr(10), 'floor ',
  cast(c_custkey % 9 as varchar)) as address, timestamp '1994-06-01 00:00:00' as join_date,
 cast(floor(c_acctbal) as bigint) + v * 10 as loyalty_points, concat('p', cast(c_custkey as varchar)) as phone_number,
 cast(c_custkey % 110 as bigint) as age,
 case c_custkey % 4 when 0 then 'Male' when 1 then 'Female' when 2 then 'Other' else 'n/a' end as gender,
 timestamp '1995-01-01 00:00:00' + interval 1 day * (case when c_custkey % 11 = 0 and v = 1 then 0
  when c_custkey % 2 = 1 then 3 - v else v end) as last_update_time
from x""",
    "products": """
with x as (select *, unnest(range(0, p_partkey % 3 + 1)) as v from part)
select cast(p_partkey as bigint) as product_id,
 concat(p_name, ' ', list_extract(['Shoe', 'Belt', 'Saree', 'Track', 'Shirt', 'Sweater', 'Gown', 'Jeans', 'Cap'],
  p_partkey % 9 + 1)) as name,
 case when p_partkey % 40 = 7 then null else p_type end as category,
 case when p_partkey % 30 = 0 or (v = 1 and p_partkey % 4 = 1) then null else p_brand end as brand,
 case when p_partkey % 25 = 3 then 50.0e0 when p_partkey % 25 = 4 then 10000.0e0
  else p_retailprice + case when v = 2 then 1.0e0 else 0.0e0 end end as price,
 cast(case when p_partkey % 23 = 0 then 3000000000 else p_partkey % 7 - 1 + v end as bigint) as stock_quantity,
 cast(p_size as varchar) as size, split_part(p_name, ' ', 1) as color, concat('about ', p_name) as description,
 timestamp '1995-01-01 00:00:00' + interval 1 day * ((v * 2) % 3) as last_update_time
from x""",
    "stores": """
with x as (select *, unnest(range(0, s_suppkey % 3 + 1)) as v from supplier)
select cast(s_suppkey as bigint) as store_id, s_name as name, concat('addr ', cast(s_nationkey as varchar)) as address,
 case when s_suppkey % 10 = 3 then null else concat('m', cast(s_nationkey as varchar)) end as manager,
 timestamp '1994-01-01 00:00:00' as open_date,
 case (s_suppkey + v // 2) % 4 when 0 then 'Under Renovation' when 1 then 'Closed' else 'Open' end as status,
 concat('p', cast(s_suppkey as varchar), '-', cast(v as varchar)) as phone_number,
 timestamp '1995-01-01 00:00:00' + interval 1 day * (2 - v) as last_update_time
from x""",
    "product_grades": """
select cast(l_partkey as int) as product_id, l_returnflag as grade,
 case when l_linenumber % 3 <> 0 then l_linestatus end as state, cast(l_quantity as int) as quantity,
 cast(l_shipdate + (l_linenumber % 2) * interval '1' hour as timestamp) as last_update_time from lineitem""",
    "customer_changes": """
select cast(user_id as int) as customer_id, concat('n', cast(user_id as varchar)) as name,
 case when event_type = 'error' then null else concat(event_type, '@x.io') end as email,
 cast(floor(value) as int) as loyalty_points, cast(ts as timestamp) as last_update_time from events""",
}

COLUMNS = {
    "sales": ["transaction_id", "store_id", "event_time", "customer_id", "product_id", "quantity",
              "unit_price", "total_amount", "payment_method", "discount_applied", "tax_amount"],
    "customers": ["customer_id", "name", "email", "address", "join_date", "loyalty_points",
                  "phone_number", "age", "gender", "last_update_time"],
    "products": ["product_id", "name", "category", "brand", "price", "stock_quantity", "size", "color",
                 "description", "last_update_time"],
    "stores": ["store_id", "name", "address", "manager", "open_date", "status", "phone_number",
               "last_update_time"],
}
KEY = {"sales": "transaction_id", "customers": "customer_id", "products": "product_id", "stores": "store_id"}


def scd2_sql(src: str, key: str, seq: str, cols: list[str], track: list[str]) -> str:
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in cols)
    fills = ", ".join(
        f"last_value({c} IGNORE NULLS) OVER (PARTITION BY {key} ORDER BY {seq} "
        f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {c}" for c in cols)
    changed = " OR ".join(f"NOT ({c} IS NOT DISTINCT FROM lag({c}) OVER w)" for c in track)
    picks = ", ".join(f"arg_max({c}, {seq}) AS {c}" for c in cols)
    return f"""
 WITH d AS (SELECT {key}, {seq}, {', '.join(cols)} FROM (
     SELECT *, row_number() OVER (PARTITION BY {key}, {seq} ORDER BY {order}) AS rn_
     FROM {src} WHERE {seq} IS NOT NULL) WHERE rn_ = 1),
 f AS (SELECT {key}, {seq}, {fills} FROM d),
 g AS (SELECT *, CASE WHEN lag({seq}) OVER w IS NULL OR {changed} THEN 1 ELSE 0 END AS chg_
       FROM f WINDOW w AS (PARTITION BY {key} ORDER BY {seq})),
 v AS (SELECT *, sum(chg_) OVER (PARTITION BY {key} ORDER BY {seq} ROWS UNBOUNDED PRECEDING) AS ver_ FROM g),
 x AS (SELECT {key}, ver_, min({seq}) AS start_, {picks} FROM v GROUP BY {key}, ver_)
 SELECT {key}, {', '.join(cols)}, start_ AS __START_AT,
   lead(start_) OVER (PARTITION BY {key} ORDER BY start_) AS __END_AT FROM x"""


def _scd2_for(entity: str, src: str) -> str:
    cols = [c for c in COLUMNS[entity] if c not in (KEY[entity], "last_update_time")]
    return scd2_sql(src, KEY[entity], "last_update_time", cols, list(SCD2_TRACK[entity]))


CUSTOMER_PRED = [
    ("valid customer_id", "customer_id IS NOT NULL", "drop"),
    ("valid_email", "email IS NULL OR email LIKE '%@%.%'", "warn"),
    ("realistic_age", "age >= 16 AND age <= 100", "warn"),
    ("realistic_loyalty_points", "loyalty_points >= 0", "warn"),
    ("valid_gender", "gender IN ('Male', 'Female', 'Other')", "warn"),
]
PRODUCT_PRED = [
    ("valid_product_id", "product_id IS NOT NULL", "drop"),
    ("valid_product_price", "price >= 99 AND price < 10000", "drop"),
    ("valid_category", "category IS NOT NULL", "drop"),
    ("non_negative_stock", "stock_quantity >= 0", "warn"),
    ("valid_brand", "brand IS NOT NULL", "warn"),
]
STORE_PRED = [
    ("valid_store_id", "store_id IS NOT NULL", "drop"),
    ("valid_manager_name", "manager IS NOT NULL", "warn"),
    ("valid_status", "status IN ('Open', 'Under Renovation')", "warn"),
]
SALES_PRED = [
    ("valid_payment_method", f"payment_method IN ({_in(PAYMENT_METHODS)})", "warn"),
    ("realistic_discount", "discount_applied >= 0", "warn"),
]
FACT_PRED = [
    ("valid_discount", "discount_applied >= 0", "drop"),
    ("valid_store_id", "store_id IS NOT NULL", "drop"),
    ("valid_customer_id", "customer_id IS NOT NULL", "drop"),
    ("valid_product_id", "product_id IS NOT NULL", "drop"),
]


def drops(rules) -> str:
    preds = [ok(p) for _, p, a in rules if a == "drop"]
    return " AND ".join(preds) if preds else "TRUE"


INTS = ("transaction_id", "store_id", "customer_id", "product_id", "quantity", "loyalty_points", "age", "stock_quantity")
FILE = {"sales": "lineitem", "customers": "customer", "products": "part", "stores": "supplier"}


def _bronze(entity: str) -> str:
    # Whole numbers land as BIGINT; one that does not fit is NULL. E1 keeps key IS NOT NULL.
    cols = ", ".join(f"try_cast({c} AS INTEGER) AS {c}" if c in INTS else c for c in COLUMNS[entity])
    return (f"SELECT * FROM (SELECT {cols}, TIMESTAMP '{RUN_TS}' AS ingest_timestamp, '{FILE[entity]}.parquet' AS source_file_path "
            f"FROM feed_{entity}) WHERE {KEY[entity]} IS NOT NULL")


def _clv(as_of) -> str:
    return f"""
 WITH a AS (SELECT customer_id, customer_name, sum({money('coalesce(total_amount, 0)')}) AS s_,
     count(DISTINCT transaction_id) AS total_orders, CAST(min(event_time) AS DATE) AS first_purchase_date,
     CAST(max(event_time) AS DATE) AS last_purchase_date, count(*) AS n_
   FROM gold_facts GROUP BY customer_id, customer_name),
 b AS (SELECT customer_id, coalesce(customer_name, 'Unknown') AS customer_name, {round2('s_')} AS total_spend,
     total_orders, {r2(cents('s_'), 'n_')} AS avg_order_value, first_purchase_date, last_purchase_date,
     CAST(datediff('day', last_purchase_date, DATE '{as_of}') AS INTEGER) AS days_since_last_purchase
   FROM a WHERE total_orders > 0 AND round(s_, 2) >= 0 AND last_purchase_date IS NOT NULL),
 c AS (SELECT *,
     CAST(ntile(5) OVER (ORDER BY days_since_last_purchase ASC, customer_id ASC, customer_name ASC) AS INTEGER) AS r_score,
     CAST(ntile(5) OVER (ORDER BY total_orders DESC, customer_id ASC, customer_name ASC) AS INTEGER) AS f_score,
     CAST(ntile(5) OVER (ORDER BY total_spend DESC, customer_id ASC, customer_name ASC) AS INTEGER) AS m_score
   FROM b WHERE days_since_last_purchase >= 0)
 SELECT customer_id, customer_name, total_spend, total_orders, avg_order_value, first_purchase_date,
   last_purchase_date, days_since_last_purchase, r_score, f_score, m_score,
   concat(CAST(r_score AS VARCHAR), CAST(f_score AS VARCHAR), CAST(m_score AS VARCHAR)) AS rfm_score,
   CASE WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'Champions'
        WHEN r_score >= 3 AND f_score >= 3 AND m_score >= 3 THEN 'Loyal Customers'
        WHEN r_score <= 2 AND (f_score >= 3 OR m_score >= 3) THEN 'At Risk'
        WHEN r_score >= 4 AND (f_score <= 2 OR m_score <= 2) THEN 'New/Potential'
        ELSE 'Lost' END AS rfm_segment
 FROM c"""


# name -> (sql body, dependencies)
CTES: dict[str, tuple[str, list[str]]] = {}
for _e in ("sales", "customers", "products", "stores", "customer_changes", "product_grades"):
    CTES[f"feed_{_e}"] = (FEEDS[_e], [])
for _e in ("sales", "customers", "products", "stores"):
    CTES[f"bronze_{_e}"] = (_bronze(_e), [f"feed_{_e}"])
CTES["customers_cleaned"] = (f"SELECT * FROM bronze_customers WHERE {drops(CUSTOMER_PRED)}", ["bronze_customers"])
CTES["products_cleaned"] = (f"SELECT * FROM bronze_products WHERE {drops(PRODUCT_PRED)}", ["bronze_products"])
CTES["stores_body"] = ("SELECT * REPLACE (coalesce(manager, 'Unknown') AS manager) FROM bronze_stores",
                       ["bronze_stores"])
CTES["stores_cleaned"] = (f"SELECT * FROM stores_body WHERE {drops(STORE_PRED)}", ["stores_body"])
for _e, _src in (("customers", "customers_cleaned"), ("products", "products_cleaned"), ("stores", "stores_cleaned")):
    CTES[f"silver_{_e}"] = (_scd2_for(_e, _src), [_src])
    CTES[f"{_e}_current"] = (f"SELECT * FROM silver_{_e} WHERE __END_AT IS NULL", [f"silver_{_e}"])
CTES["sales_body"] = ("""SELECT *, CAST(event_time AS DATE) AS date FROM bronze_sales
  WHERE store_id IN (SELECT store_id FROM stores_current)
    AND customer_id IN (SELECT customer_id FROM customers_current)
    AND product_id IN (SELECT product_id FROM products_current)""",
                      ["bronze_sales", "stores_current", "customers_current", "products_current"])
CTES["sales_cleaned"] = ("SELECT * FROM sales_body", ["sales_body"])
CTES["silver_sales"] = (f"SELECT * FROM sales_cleaned WHERE quantity > 0 AND {drops(FACT_PRED)}", ["sales_cleaned"])
CTES["returns_body"] = ("""SELECT * EXCLUDE (quantity, total_amount), abs(quantity) AS returned_quantity,
  abs(total_amount) AS returned_amount FROM sales_cleaned WHERE quantity < 0""", ["sales_cleaned"])
CTES["silver_returns"] = (f"SELECT * FROM returns_body WHERE {drops(FACT_PRED)}", ["returns_body"])
CTES["gold_facts"] = ("""SELECT s.transaction_id, s.event_time, s.customer_id, c.name AS customer_name,
  s.product_id, p.name AS product_name, p.category AS product_category, s.store_id, st.name AS store_name,
  s.quantity, s.unit_price, s.total_amount, s.payment_method, s.discount_applied, s.tax_amount
  FROM silver_sales s JOIN stores_current st ON s.store_id = st.store_id
  JOIN customers_current c ON s.customer_id = c.customer_id
  JOIN products_current p ON s.product_id = p.product_id""",
                      ["silver_sales", "stores_current", "customers_current", "products_current"])
CTES["gold_daily"] = (f"""SELECT CAST(event_time AS DATE) AS sale_date, store_id, store_name,
  {round2(f"sum({money('total_amount')})")} AS total_revenue, count(transaction_id) AS total_transactions,
  CAST(sum(quantity) AS BIGINT) AS total_items_sold, count(DISTINCT customer_id) AS unique_customers
  FROM gold_facts GROUP BY CAST(event_time AS DATE), store_id, store_name""", ["gold_facts"])
CTES["gold_product"] = (f"""SELECT product_id, product_name, product_category,
  {round2(f"sum({money('total_amount')})")} AS total_revenue, CAST(sum(quantity) AS BIGINT) AS total_quantity_sold,
  count(transaction_id) AS total_orders
  FROM gold_facts GROUP BY product_id, product_name, product_category""", ["gold_facts"])
CTES["gold_customer"] = (_clv(AS_OF), ["gold_facts"])
CTES["store_kpis"] = (f"""SELECT store_name, sum({money('total_revenue')}) AS rev_,
  CAST(sum(total_transactions) AS BIGINT) AS total_transactions,
  CAST(sum(unique_customers) AS BIGINT) AS total_unique_customers, CAST(sum(total_items_sold) AS BIGINT) AS items_
  FROM gold_daily WHERE {DATE_RANGE} GROUP BY store_name""", ["gold_daily"])


def _report(dataset: str, src: str, rules) -> str:
    counts = ", ".join(f"count_if(NOT {ok(p)}) AS f{i}" for i, (_, p, _) in enumerate(rules))
    rows = " UNION ALL ".join(
        f"SELECT '{dataset}' AS dataset, '{n}' AS rule, '{a}' AS action, "
        f"CAST(n_ - f{i} AS BIGINT) AS passed, CAST(f{i} AS BIGINT) AS failed FROM q"
        for i, (n, _, a) in enumerate(rules))
    return f"(WITH q AS (SELECT count(*) AS n_, {counts} FROM {src}) {rows})"


CTES["quality_report"] = (" UNION ALL ".join([
    _report("bronze_sales", "feed_sales", [("valid_transaction_id", "transaction_id IS NOT NULL", "fail")]),
    _report("bronze_customers", "feed_customers", [("valid_customer_id", "customer_id IS NOT NULL", "fail")]),
    _report("bronze_products", "feed_products", [("valid_product_id", "product_id IS NOT NULL", "fail")]),
    _report("bronze_stores", "feed_stores", [("valid_store_id", "store_id IS NOT NULL", "fail")]),
    _report("customers_cleaned", "bronze_customers", CUSTOMER_PRED),
    _report("products_cleaned", "bronze_products", PRODUCT_PRED),
    _report("stores_cleaned", "stores_body", STORE_PRED),
    _report("sales_cleaned", "sales_body", SALES_PRED),
    _report("silver_sales", "(SELECT * FROM sales_cleaned WHERE quantity > 0)", FACT_PRED),
    _report("silver_returns", "returns_body", FACT_PRED),
]), ["feed_sales", "feed_customers", "feed_products", "feed_stores", "bronze_customers", "bronze_products",
     "stores_body", "sales_body", "sales_cleaned", "returns_body"])

CTES["product_grades_history"] = (
    scd2_sql("feed_product_grades", "product_id", "last_update_time", ["grade", "state", "quantity"], ["grade", "state"]),
    ["feed_product_grades"])
_CHANGE_COLS = ["name", "email", "loyalty_points"]
CTES["customer_changes_history"] = (
    scd2_sql("feed_customer_changes", "customer_id", "last_update_time", _CHANGE_COLS, ["name", "email"]),
    ["feed_customer_changes"])


def _segment_order() -> str:
    return ("CASE rfm_segment WHEN 'Champions' THEN 1 WHEN 'Loyal Customers' THEN 2 WHEN 'At Risk' THEN 3 "
            "WHEN 'New/Potential' THEN 4 WHEN 'Lost' THEN 5 END")


# query name -> (final SELECT, dependencies)
QUERIES: dict[str, tuple[str, list[str]]] = {
    "b1_bronze_sales": ("SELECT * FROM bronze_sales", ["bronze_sales"]),
    "b2_bronze_customers": ("SELECT * FROM bronze_customers", ["bronze_customers"]),
    "b3_bronze_products": ("SELECT * FROM bronze_products", ["bronze_products"]),
    "b4_bronze_stores": ("SELECT * FROM bronze_stores", ["bronze_stores"]),
    "c1_customers_cleansed": ("SELECT * FROM customers_cleaned", ["customers_cleaned"]),
    "c2_products_cleansed": ("SELECT * FROM products_cleaned", ["products_cleaned"]),
    "c3_stores_cleansed": ("SELECT * FROM stores_cleaned", ["stores_cleaned"]),
    "c4_sales_cleansed": ("SELECT * FROM sales_cleaned", ["sales_cleaned"]),
    "h1_scd2_customers": ("SELECT * FROM silver_customers", ["silver_customers"]),
    "h2_scd2_products": ("SELECT * FROM silver_products", ["silver_products"]),
    "h3_scd2_stores": ("SELECT * FROM silver_stores", ["silver_stores"]),
    "h4_scd2_customer_changes": ("SELECT * FROM customer_changes_history", ["customer_changes_history"]),
    "h5_scd2_hot_keys": ("SELECT * FROM product_grades_history", ["product_grades_history"]),
    "v1_customers_current": ("SELECT * FROM customers_current", ["customers_current"]),
    "v2_products_current": ("SELECT * FROM products_current", ["products_current"]),
    "v3_stores_current": ("SELECT * FROM stores_current", ["stores_current"]),
    "v4_customer_changes_current": ("SELECT * FROM customer_changes_history WHERE __END_AT IS NULL",
                                    ["customer_changes_history"]),
    "k1_silver_sales": ("SELECT * FROM silver_sales", ["silver_sales"]),
    "k2_silver_returns": ("SELECT * FROM silver_returns", ["silver_returns"]),
    "g1_denormalized_facts": ("SELECT * FROM gold_facts", ["gold_facts"]),
    "g2_daily_store": ("SELECT * FROM gold_daily", ["gold_daily"]),
    "g3_product_performance": ("SELECT * FROM gold_product", ["gold_product"]),
    "g4_customer_lifetime_value": ("SELECT * FROM gold_customer", ["gold_customer"]),
    "e4_quality_report": ("SELECT * FROM quality_report", ["quality_report"]),
    "q01_total_revenue": (f"SELECT {msum('total_amount')} AS total_revenue "
                          f"FROM gold_facts WHERE {EVENT_RANGE}", ["gold_facts"]),
    "q02_total_transactions": (f"SELECT count(DISTINCT transaction_id) AS total_transactions FROM gold_facts "
                               f"WHERE {EVENT_RANGE}", ["gold_facts"]),
    "q03_total_customers": (f"SELECT count(DISTINCT customer_id) AS total_customers FROM gold_facts "
                            f"WHERE {EVENT_RANGE}", ["gold_facts"]),
    "q04_avg_order_value": (f"SELECT {r2(cents(f"sum({money('total_amount')})"), 'count(total_amount)')} "
                            f"AS avg_order_value FROM gold_facts WHERE {EVENT_RANGE}", ["gold_facts"]),
    "q05_daily_revenue": (f"SELECT sale_date, {msum('total_revenue')} AS "
                          f"daily_total_revenue FROM gold_daily WHERE {DATE_RANGE} GROUP BY sale_date "
                          f"ORDER BY sale_date ASC", ["gold_daily"]),
    "q06_top_stores": (f"SELECT store_name, {msum('total_revenue')} AS total_revenue "
                       f"FROM gold_daily WHERE {DATE_RANGE} GROUP BY store_name "
                       f"ORDER BY total_revenue DESC, store_name LIMIT 5", ["gold_daily"]),
    "q07_top_products": (f"SELECT product_name, product_category, "
                         f"{msum('total_amount')} AS total_revenue FROM gold_facts "
                         f"WHERE {EVENT_RANGE} GROUP BY product_name, product_category "
                         f"ORDER BY total_revenue DESC, product_name, product_category LIMIT 5", ["gold_facts"]),
    "q08_revenue_by_category": (f"SELECT product_category, {msum('total_amount')} "
                                f"AS total_revenue FROM gold_facts WHERE {EVENT_RANGE} GROUP BY product_category "
                                f"ORDER BY total_revenue DESC", ["gold_facts"]),
    "q09_revenue_by_payment": (f"SELECT payment_method, {msum('total_amount')} "
                               f"AS total_revenue FROM gold_facts WHERE {EVENT_RANGE} GROUP BY payment_method "
                               f"ORDER BY total_revenue DESC", ["gold_facts"]),
    "q10_category_performance": (
        f"SELECT product_category, count(DISTINCT product_id) AS product_count, {msum('total_amount')} AS total_revenue, "
        f"CAST(sum(quantity) AS BIGINT) AS total_quantity, "
        f"{r2(cents(f"sum({money('total_amount')})"), 'sum(quantity)')} AS avg_price "
        f"FROM gold_facts WHERE {EVENT_RANGE} GROUP BY product_category ORDER BY total_revenue DESC", ["gold_facts"]),
    "q11_top20_products": (
        f"SELECT product_name, product_category, {msum('total_amount')} AS total_revenue, "
        f"CAST(sum(quantity) AS BIGINT) AS total_quantity_sold, count(transaction_id) AS total_orders "
        f"FROM gold_facts WHERE {EVENT_RANGE} GROUP BY product_name, product_category "
        f"ORDER BY total_revenue DESC, product_name, product_category LIMIT 20", ["gold_facts"]),
    "q12_store_performance": (
        f"SELECT store_name, {round2('rev_')} AS total_revenue, total_transactions, total_unique_customers, "
        f"{r2(cents('rev_'), 'total_transactions')} AS avg_transaction_value, "
        f"{r2('items_ * 100', 'total_transactions')} AS items_per_transaction, "
        f"{r2('total_transactions * 100', 'total_unique_customers')} AS transactions_per_customer "
        f"FROM store_kpis ORDER BY total_revenue DESC", ["store_kpis"]),
    "q13_bottom_stores": (
        f"SELECT store_name, sale_date, {msum('total_revenue')} AS total_revenue "
        f"FROM gold_daily WHERE {DATE_RANGE} GROUP BY store_name, sale_date "
        f"ORDER BY total_revenue ASC, store_name, sale_date LIMIT 5", ["gold_daily"]),
    "q14_active_stores": (
        f"SELECT CASE WHEN sf.store_id IS NOT NULL THEN 'Active' ELSE 'Inactive' END AS store_status, "
        f"count(DISTINCT st.store_id) AS store_count FROM silver_stores st LEFT JOIN ("
        f"SELECT DISTINCT store_id FROM gold_facts WHERE {EVENT_RANGE}) sf ON st.store_id = sf.store_id "
        f"GROUP BY store_status", ["silver_stores", "gold_facts"]),
    "q15_engagement_top10": (
        f"SELECT *, items_per_transaction * transactions_per_customer AS customer_engagement_Index FROM ("
        f"SELECT store_name, {round2('rev_')} AS total_revenue, total_transactions, total_unique_customers, "
        f"{r2(cents('rev_'), 'total_transactions')} AS avg_transaction_value, "
        f"{r2('items_ * 100', 'total_transactions')} AS items_per_transaction, "
        f"{r2('total_transactions * 100', 'total_unique_customers')} AS transactions_per_customer "
        f"FROM store_kpis) ORDER BY total_revenue DESC, store_name LIMIT 10", ["store_kpis"]),
    "q16_rfm_counts": (f"SELECT rfm_segment, count(*) AS customer_count FROM gold_customer GROUP BY rfm_segment "
                       f"ORDER BY {_segment_order()}", ["gold_customer"]),
    "q17_rfm_performance": (
        f"SELECT rfm_segment, customer_count, {round2('spend_')} AS total_revenue, "
        f"{r2(cents('spend_'), 'customer_count')} AS avg_spend, {r2('orders_ * 100', 'customer_count')} AS avg_orders, "
        f"{r2(cents('aov_'), 'customer_count')} AS avg_order_value, "
        f"{r2('customer_count * 10000', 'sum(customer_count) OVER ()')} AS percentage FROM ("
        f"SELECT rfm_segment, count(*) AS customer_count, sum({money('total_spend')}) AS spend_, "
        f"sum(total_orders) AS orders_, sum({money('avg_order_value')}) AS aov_ FROM gold_customer "
        f"GROUP BY rfm_segment) ORDER BY {_segment_order()}", ["gold_customer"]),
    "q18_acquisition": (
        f"SELECT CAST(first_purchase_date AS DATE) AS acquisition_date, count(*) AS new_customers "
        f"FROM gold_customer WHERE first_purchase_date >= DATE '{ACQUIRED_SINCE}' "
        f"GROUP BY CAST(first_purchase_date AS DATE) ORDER BY acquisition_date ASC", ["gold_customer"]),
    "q19_top100_customers": (
        "SELECT customer_id, customer_name, round(total_spend, 2) AS total_spend, total_orders, "
        "round(avg_order_value, 2) AS avg_order_value, first_purchase_date, last_purchase_date, rfm_segment "
        "FROM gold_customer ORDER BY total_spend DESC, customer_id LIMIT 100", ["gold_customer"]),
}


_FAMILY = ("CASE " + " ".join(f"WHEN regexp_matches(lower(name), '{words}') THEN '{fam}'"
                              for fam, words in CATEGORY_FAMILIES) + f" ELSE 'default' END")
_TAX_RATE = "CAST(CASE WHEN unit_price <= 1000 THEN 0.05 ELSE 0.12 END AS DECIMAL(4,2))"

QUERIES["a8_store_customers"] = (f"""SELECT f.store_id, f.store_name, d.summed_daily_customers, count(DISTINCT f.customer_id) AS unique_customers
  FROM gold_facts f JOIN (SELECT store_id, store_name, CAST(sum(unique_customers) AS BIGINT) AS summed_daily_customers
                          FROM gold_daily WHERE {DATE_RANGE} GROUP BY store_id, store_name) d
    ON d.store_id = f.store_id AND d.store_name IS NOT DISTINCT FROM f.store_name
  WHERE CAST(f.event_time AS DATE) >= TIMESTAMP '{LO}' AND CAST(f.event_time AS DATE) <= TIMESTAMP '{HI}'
  GROUP BY ALL""", ["gold_facts", "gold_daily"])
QUERIES.update({
    "j8_orphans": (" UNION ALL ".join(
        f"SELECT b.* EXCLUDE (ingest_timestamp, source_file_path), '{name}' AS missing_dimension FROM bronze_sales b WHERE NOT EXISTS "
        f"(SELECT 1 FROM {name}_current d WHERE d.{key} = b.{key})"
        for name, key in (("stores", "store_id"), ("customers", "customer_id"), ("products", "product_id"))),
        ["bronze_sales", "stores_current", "customers_current", "products_current"]),
    "w4_ntile_orders": ("SELECT o_orderkey, o_totalprice, CAST(ntile(5) OVER (ORDER BY o_totalprice DESC, "
                        "o_orderkey ASC) AS INTEGER) AS price_tile FROM orders", []),
    "d1_d2_amount_tax": (
        f"SELECT transaction_id, product_id, quantity, unit_price, la_ AS line_amount, lt_ AS line_tax, "
        f"la_ = total_amount AS amount_ok, lt_ = tax_amount AS tax_ok FROM ("
        f"SELECT *, CAST(round({money('la_')} * {_TAX_RATE}, 2) AS DOUBLE) AS lt_ FROM ("
        f"SELECT *, CAST(round({money('unit_price')} * quantity, 2) AS DOUBLE) AS la_ FROM feed_sales))",
        ["feed_sales"]),
    "d3_d4_product_attributes": (
        f"SELECT product_id, name, string_split(name, ' ')[1] AS name_color, "
        f"string_split(name, ' ')[-2] AS name_size, {_FAMILY} AS category_family FROM feed_products",
        ["feed_products"]),
    "d5_single_line_address": ("SELECT customer_id, replace(address, chr(10), ', ') AS address "
                               "FROM feed_customers", ["feed_customers"]),
    "s12_existing_customer_keys": ("SELECT DISTINCT customer_id FROM feed_customers "
                                   "WHERE customer_id IS NOT NULL", ["feed_customers"]),
    "s13_next_transaction_id": ("SELECT CAST(coalesce(max(transaction_id), 0) + 1 AS BIGINT) "
                                "AS next_transaction_id FROM feed_sales", ["feed_sales"]),
})


def _closure(deps: list[str]) -> list[str]:
    seen: list[str] = []

    def visit(name: str) -> None:
        if name in seen:
            return
        for d in CTES[name][1]:
            visit(d)
        seen.append(name)

    for d in deps:
        visit(d)
    return seen


def statement(name: str) -> str:
    body, deps = QUERIES[name]
    ctes = _closure(deps)
    if not ctes:
        return body
    return "WITH " + ",\n".join(f"{c} AS ({CTES[c][0]})" for c in ctes) + "\n" + body


def all_statements() -> dict[str, str]:
    return {name: statement(name) for name in QUERIES}
