"""The dashboard queries (Q1-Q19) as SQL text over the registered views.

``dashboard.run_sql`` binds ``:date_range`` and ``:as_of``. The texts give the
rows of the DataFrame functions of the same name: amounts are summed as
decimals and rounded once.
"""

from __future__ import annotations

_MONEY = "CAST({} AS DECIMAL(28,6))"
_SALES = "gold_denormalized_sales_facts WHERE event_time BETWEEN :date_range.min AND :date_range.max"
_DAYS = ("gold_daily_sales_by_store WHERE CAST(sale_date AS TIMESTAMP) BETWEEN :date_range.min AND :date_range.max")


def _amount(column: str) -> str:
    """A sum of money, exact to a millionth and rounded once."""
    return f"CAST(round(sum({_MONEY.format(column)}), 2) AS DOUBLE)"


def _ratio(a: str, b: str) -> str:
    """a / b rounded half-up to hundredths in whole numbers: a decimal division
    would round to the scale that Spark leaves it first."""
    n, d = f"(CAST({a} AS DECIMAL(34,6)) * 100)", f"CAST(nullif({b}, 0) AS DECIMAL(19,0))"
    twice = f"CAST((abs(CAST({n} AS DECIMAL(32,4))) * 2 + abs({d})) * 10000 AS DECIMAL(38,0))"
    hundredths = f"({twice} div CAST(abs({d}) * 20000 AS DECIMAL(38,0)))"
    return f"CAST(CAST(if(({n} < 0) <> ({d} < 0), -1, 1) * {hundredths} AS DECIMAL(19,0)) * 0.01 AS DOUBLE)"


_REVENUE = f"{_amount('total_amount')} AS total_revenue"
_DAY_REVENUE = _amount("total_revenue")

# Result names below and the order of the segments.
_KPIS = f"""SELECT store_name, {_DAY_REVENUE} AS total_revenue, sum(total_transactions) AS total_transactions,
  sum(unique_customers) AS total_unique_customers,
  {_ratio(f"sum({_MONEY.format('total_revenue')})", "sum(total_transactions)")} AS avg_transaction_value,
  {_ratio("CAST(sum(total_items_sold) AS DECIMAL(20,0))", "sum(total_transactions)")} AS items_per_transaction,
  {_ratio("CAST(sum(total_transactions) AS DECIMAL(20,0))", "sum(unique_customers)")} AS transactions_per_customer
FROM {_DAYS} GROUP BY store_name"""

_SEGMENT = """CASE rfm_segment WHEN 'Champions' THEN 1 WHEN 'Loyal Customers' THEN 2 WHEN 'At Risk' THEN 3
  WHEN 'New/Potential' THEN 4 ELSE 5 END"""

TEXTS: dict[str, str] = {
    "q01_total_revenue": f"SELECT {_REVENUE} FROM {_SALES}",
    "q02_total_transactions": f"SELECT count(DISTINCT transaction_id) AS total_transactions FROM {_SALES}",
    "q03_total_customers": f"SELECT count(DISTINCT customer_id) AS total_customers FROM {_SALES}",
    "q04_avg_order_value":
        f"SELECT {_ratio(f'sum({_MONEY.format('total_amount')})', 'count(total_amount)')} AS avg_order_value FROM {_SALES}",
    "q05_daily_revenue":
        f"SELECT sale_date, {_DAY_REVENUE} AS daily_total_revenue FROM {_DAYS} GROUP BY sale_date ORDER BY sale_date",
    "q06_top_stores":
        f"SELECT store_name, {_DAY_REVENUE} AS total_revenue FROM {_DAYS} GROUP BY store_name "
        "ORDER BY total_revenue DESC, store_name LIMIT 5",
    "q07_top_products":
        f"SELECT product_name, product_category, {_REVENUE} FROM {_SALES} GROUP BY ALL "
        "ORDER BY total_revenue DESC, product_name, product_category LIMIT 5",
    "q08_revenue_by_category":
        f"SELECT product_category, {_REVENUE} FROM {_SALES} GROUP BY product_category "
        "ORDER BY total_revenue DESC, product_category",
    "q09_revenue_by_payment":
        f"SELECT payment_method, {_REVENUE} FROM {_SALES} GROUP BY payment_method "
        "ORDER BY total_revenue DESC, payment_method",
    "q10_category_performance":
        f"SELECT product_category, count(DISTINCT product_id) AS product_count, {_REVENUE}, sum(quantity) AS total_quantity, "
        f"{_ratio(f'sum({_MONEY.format('total_amount')})', 'sum(quantity)')} AS avg_price FROM {_SALES} "
        "GROUP BY product_category ORDER BY total_revenue DESC, product_category",
    "q11_top20_products":
        f"SELECT product_name, product_category, {_REVENUE}, sum(quantity) AS total_quantity_sold, "
        f"count(transaction_id) AS total_orders FROM {_SALES} GROUP BY product_name, product_category "
        "ORDER BY total_revenue DESC, product_name, product_category LIMIT 20",
    "q12_store_performance": f"{_KPIS} ORDER BY total_revenue DESC, store_name",
    "q13_bottom_stores":
        f"SELECT store_name, sale_date, {_DAY_REVENUE} AS total_revenue FROM {_DAYS} GROUP BY store_name, sale_date "
        "ORDER BY total_revenue, store_name, sale_date LIMIT 5",
    "q14_active_stores":
        "SELECT if(sold.store_id IS NULL, 'Inactive', 'Active') AS store_status, count(DISTINCT every.store_id) AS store_count "
        f"FROM silver_stores every LEFT JOIN (SELECT DISTINCT store_id FROM {_SALES}) sold ON every.store_id = sold.store_id "
        "GROUP BY store_status",
    "q15_engagement_top10":
        "SELECT *, items_per_transaction * transactions_per_customer AS customer_engagement_Index "
        f"FROM ({_KPIS}) ORDER BY total_revenue DESC, store_name LIMIT 10",
    "q16_rfm_counts":
        "SELECT rfm_segment, count(*) AS customer_count FROM gold_customer_lifetime_value GROUP BY rfm_segment "
        f"ORDER BY {_SEGMENT}",
    "q17_rfm_performance":
        f"SELECT rfm_segment, count(*) AS customer_count, {_amount('total_spend')} AS total_revenue, "
        f"{_ratio(f'sum({_MONEY.format('total_spend')})', 'count(*)')} AS avg_spend, "
        f"{_ratio('CAST(sum(total_orders) AS DECIMAL(20,0))', 'count(*)')} AS avg_orders, "
        f"{_ratio(f'sum({_MONEY.format('avg_order_value')})', 'count(*)')} AS avg_order_value, "
        f"{_ratio('CAST(100 * count(*) AS DECIMAL(20,0))', 'sum(count(*)) OVER ()')} AS percentage "
        f"FROM gold_customer_lifetime_value GROUP BY rfm_segment ORDER BY {_SEGMENT}",
    "q18_acquisition":
        "SELECT first_purchase_date AS acquisition_date, count(*) AS new_customers FROM gold_customer_lifetime_value "
        "WHERE first_purchase_date >= date_sub(:acquired_by, 90) GROUP BY first_purchase_date ORDER BY acquisition_date",
    "q19_top100_customers":
        "SELECT customer_id, customer_name, total_spend, total_orders, avg_order_value, first_purchase_date, "
        "last_purchase_date, rfm_segment FROM gold_customer_lifetime_value ORDER BY total_spend DESC, customer_id LIMIT 100",
}
