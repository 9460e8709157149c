"""Gold tables and dashboard semantics on hand-made rows (FIXTURES.md section 3)."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from shopfloor.config import DEFAULT_PARAMS, Params
from shopfloor.plans import dashboard as D
from shopfloor.plans import gold

FACT_SCHEMA = ("transaction_id int, event_time timestamp, customer_id int, customer_name string, "
               "store_id int, store_name string, quantity int, total_amount double")


def _facts(spark, rows):
    return spark.createDataFrame(rows, FACT_SCHEMA)


def test_rfm_seven_customers_bucket_sizes(spark):
    # customer i: i orders, spend 10*i, last purchase i days before as_of
    rows = []
    for c in range(1, 8):
        for t in range(c):
            rows.append((c * 100 + t, datetime(2001, 12, 31 - c, 12), c, f"c{c}", 1, "s", 1, 10.0))
    clv = gold.customer_lifetime_value(_facts(spark, rows), date(2002, 1, 1))
    got = {r["customer_id"]: (r["r_score"], r["f_score"], r["m_score"]) for r in clv.collect()}
    # recency ascending days (customer 1 most recent), frequency / spend descending
    assert [got[c][0] for c in range(1, 8)] == [1, 1, 2, 2, 3, 4, 5]
    assert [got[c][1] for c in range(7, 0, -1)] == [1, 1, 2, 2, 3, 4, 5]
    assert [got[c][2] for c in range(7, 0, -1)] == [1, 1, 2, 2, 3, 4, 5]
    row = clv.where("customer_id = 7").first()
    assert (row["total_orders"], row["total_spend"], row["avg_order_value"]) == (7, 70.0, 10.0)
    assert row["rfm_score"] == "511"


def test_rfm_best_high_flips(spark):
    rows = [(c, datetime(2001, 12, 1 + c), c, f"c{c}", 1, "s", 1, float(c)) for c in range(1, 6)]
    ref = gold.customer_lifetime_value(_facts(spark, rows), date(2002, 1, 1))
    flip = gold.customer_lifetime_value(_facts(spark, rows), date(2002, 1, 1), "best_high")
    a = {r["customer_id"]: r["m_score"] for r in ref.collect()}
    b = {r["customer_id"]: r["m_score"] for r in flip.collect()}
    assert all(a[c] + b[c] == 6 for c in a)


@pytest.mark.parametrize("scores,segment", [
    ((5, 5, 5), "Champions"), ((3, 3, 3), "Loyal Customers"), ((2, 3, 1), "At Risk"),
    ((4, 2, 5), "New/Potential"), ((2, 2, 2), "Lost"), ((3, 2, 3), "Lost"),
])
def test_segment_truth_table(spark, scores, segment):
    df = spark.createDataFrame([scores], "r int, f int, m int")
    assert df.select(gold.rfm_segment(F.col("r"), F.col("f"), F.col("m"))).first()[0] == segment


def test_future_purchase_and_filters(spark):
    rows = [(1, datetime(2003, 1, 1), 1, "a", 1, "s", 1, 5.0),   # after as_of: excluded
            (2, datetime(2001, 1, 1), 2, None, 1, "s", 1, 5.0)]  # NULL name -> 'Unknown'
    clv = gold.customer_lifetime_value(_facts(spark, rows), date(2002, 1, 1))
    assert [(r["customer_id"], r["customer_name"]) for r in clv.collect()] == [(2, "Unknown")]


def test_daily_window_is_one_utc_day(spark):
    rows = [(1, datetime(2024, 3, 5, 1, 0), 1, "a", 9, "s9", 2, 10.0),
            (2, datetime(2024, 3, 5, 23, 0), 2, "b", 9, "s9", 3, 0.05),
            (2, datetime(2024, 3, 6, 0, 0), 2, "b", 9, "s9", 1, 1.0)]
    daily = gold.daily_by_store(_facts(spark, rows)).orderBy("sale_date").collect()
    assert [(r["sale_date"], r["total_transactions"], r["total_items_sold"], r["unique_customers"],
             r["total_revenue"]) for r in daily] == [
        (date(2024, 3, 5), 2, 5, 2, 10.05), (date(2024, 3, 6), 1, 1, 1, 1.0)]


def test_product_performance(spark):
    sch = "transaction_id int, product_id int, product_name string, product_category string, quantity int, total_amount double"
    df = spark.createDataFrame([(1, 7, "p", "c", 2, 1.10), (1, 7, "p", "c", 1, 2.20), (2, 8, "q", "c", 4, 3.0)], sch)
    got = sorted(tuple(r) for r in gold.product_performance(df).collect())
    assert got == [(7, "p", "c", 3.3, 3, 2), (8, "q", "c", 3.0, 4, 1)]


def test_store_without_sales_inactive_and_not_bottom(spark):
    p = Params(date_min=datetime(2024, 1, 1), date_max=datetime(2024, 12, 31, 23, 59, 59))
    facts = _facts(spark, [(1, datetime(2024, 5, 1, 10), 1, "a", 1, "s1", 1, 5.0),
                           (2, datetime(2024, 5, 2, 10), 1, "a", 2, "s2", 1, 7.0)])
    history = spark.createDataFrame([(1,), (1,), (2,), (3,)], "store_id int")  # SCD2: store 1 twice
    q14 = {r["store_status"]: r["store_count"] for r in D.q14_active_stores(history, facts, p).collect()}
    assert q14 == {"Active": 2, "Inactive": 1}
    q13 = D.q13_bottom_stores(gold.daily_by_store(facts), p).collect()
    assert [r["store_name"] for r in q13] == ["s1", "s2"]


def test_date_range_upper_bound_is_inclusive_timestamp(spark):
    p = Params(date_min=datetime(2024, 1, 1), date_max=datetime(2024, 1, 31, 23, 59, 59))
    facts = _facts(spark, [(1, datetime(2024, 1, 31, 23, 0), 1, "a", 1, "s", 1, 5.0),
                           (2, datetime(2024, 2, 1, 0, 0), 1, "a", 1, "s", 1, 7.0)])
    assert D.q01_total_revenue(facts, p).first()[0] == 5.0


def test_empty_range_sum_null_count_zero(spark):
    p = Params(date_min=datetime(2030, 1, 1), date_max=datetime(2030, 1, 2))
    facts = _facts(spark, [(1, datetime(2024, 1, 1), 1, "a", 1, "s", 1, 5.0)])
    assert D.q01_total_revenue(facts, p).first()[0] is None
    assert D.q02_total_transactions(facts, p).first()[0] == 0
    assert D.q04_avg_order_value(facts, p).first()[0] is None


def test_acquisition_window(spark):
    sch = "customer_id int, first_purchase_date date"
    clv = spark.createDataFrame([(1, date(1995, 7, 1)), (2, date(1995, 7, 2)), (3, date(1995, 7, 2)),
                                 (4, date(1995, 6, 1))], sch)
    got = [tuple(r) for r in D.q18_acquisition(clv, DEFAULT_PARAMS).collect()]
    assert got == [(date(1995, 7, 2), 2)]  # 90 days before 1995-09-30 is 1995-07-02


def test_sql_text_with_date_range_parameter(spark):
    """Dashboard SQL over registered views with a bound :date_range."""
    p = Params(date_min=datetime(2024, 1, 1), date_max=datetime(2024, 1, 31, 23, 59, 59))
    facts = _facts(spark, [(1, datetime(2024, 1, 31, 23, 0), 1, "a", 1, "s1", 1, 5.25),
                           (2, datetime(2024, 1, 3, 0, 0), 2, "b", 2, "s2", 2, 7.5),
                           (3, datetime(2024, 2, 1, 0, 0), 1, "a", 1, "s1", 1, 7.0)])
    facts.createOrReplaceTempView("gold_denormalized_sales_facts")
    text = ("SELECT store_name, COUNT(DISTINCT transaction_id) AS orders, SUM(total_amount) AS revenue "
            "FROM gold_denormalized_sales_facts "
            "WHERE event_time BETWEEN :date_range.min AND :date_range.max GROUP BY store_name")
    got = sorted(tuple(r) for r in D.run_sql(spark, text, p).collect())
    assert got == [("s1", 1, 5.25), ("s2", 1, 7.5)]
    assert D.run_sql(spark, "SELECT :as_of AS d", p).first()[0] == DEFAULT_PARAMS.as_of
