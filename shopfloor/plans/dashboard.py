"""The 19 dashboard queries (Q1-Q19) as DataFrame functions over gold/silver.

Date-range semantics (P16/P17): both bounds inclusive; on ``event_time`` the
bounds are timestamps; on ``sale_date`` a date d is compared as midnight of d,
which is what SQL does when a DATE meets a TIMESTAMP bound. The date bounds
are folded to DATE literals here so the filter stays a plain, pushable (and
partition-prunable) predicate on the date column.

Money is summed in DECIMAL and ratios are rounded half-up in integers
(``functions.money``). Top-k lists add the grouping key as a tie-break.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import RFM_SEGMENTS, Params
from ..functions.money import as_money, cents, mean_round2, money_sum, ratio_round2, round2_double


def _ts(value: datetime) -> Column:
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")


def in_event_range(p: Params) -> Column:
    return F.col("event_time").between(_ts(p.date_min), _ts(p.date_max))


def date_bounds(p: Params) -> tuple[date, date]:
    """Dates d with midnight(d) in [min, max]."""
    lo = p.date_min.date() if p.date_min.time() == datetime.min.time() else p.date_min.date() + timedelta(days=1)
    return lo, p.date_max.date()


def in_date_range(p: Params, col: str = "sale_date") -> Column:
    lo, hi = date_bounds(p)
    return F.col(col).between(F.lit(lo.isoformat()).cast("date"), F.lit(hi.isoformat()).cast("date"))


def _month_bounds(lo: date, hi: date, col: str) -> Column:
    return F.col(col).between(F.lit(lo.replace(day=1).isoformat()).cast("date"),
                              F.lit(hi.replace(day=1).isoformat()).cast("date"))


def _events(facts: DataFrame, p: Params) -> DataFrame:
    """P16; on stored facts also the implied month range, which prunes folders."""
    out = facts.where(in_event_range(p))
    if "event_month" in facts.columns:
        out = out.where(_month_bounds(p.date_min.date(), p.date_max.date(), "event_month"))
    return out


def _days(daily: DataFrame, p: Params) -> DataFrame:
    """P17; on the stored rollup also the implied month range."""
    out = daily.where(in_date_range(p))
    if "sale_month" in daily.columns:
        out = out.where(_month_bounds(*date_bounds(p), "sale_month"))
    return out


# --- executive summary ----------------------------------------------------------
def q01_total_revenue(facts: DataFrame, p: Params) -> DataFrame:
    return _events(facts, p).agg(round2_double(money_sum("total_amount")).alias("total_revenue"))


def q02_total_transactions(facts: DataFrame, p: Params) -> DataFrame:
    return _events(facts, p).agg(F.countDistinct("transaction_id").alias("total_transactions"))


def q03_total_customers(facts: DataFrame, p: Params) -> DataFrame:
    return _events(facts, p).agg(F.countDistinct("customer_id").alias("total_customers"))


def q04_avg_order_value(facts: DataFrame, p: Params) -> DataFrame:
    return (_events(facts, p)
            .agg(money_sum("total_amount").alias("_s"), F.count("total_amount").alias("_n"))
            .select(mean_round2(cents(F.col("_s")), F.col("_n")).alias("avg_order_value")))


def q05_daily_revenue(daily: DataFrame, p: Params) -> DataFrame:
    return (_days(daily, p).groupBy("sale_date")
            .agg(round2_double(money_sum("total_revenue")).alias("daily_total_revenue"))
            .orderBy("sale_date"))


def q06_top_stores(daily: DataFrame, p: Params) -> DataFrame:
    return (_days(daily, p).groupBy("store_name")
            .agg(round2_double(money_sum("total_revenue")).alias("total_revenue"))
            .orderBy(F.col("total_revenue").desc(), F.col("store_name"))
            .limit(5))


def _by_product(facts: DataFrame, p: Params) -> DataFrame:
    return _events(facts, p).groupBy("product_name", "product_category")


def q07_top_products(facts: DataFrame, p: Params) -> DataFrame:
    return (_by_product(facts, p)
            .agg(round2_double(money_sum("total_amount")).alias("total_revenue"))
            .orderBy(F.col("total_revenue").desc(), "product_name", "product_category")
            .limit(5))


def q08_revenue_by_category(facts: DataFrame, p: Params) -> DataFrame:
    return (_events(facts, p).groupBy("product_category")
            .agg(round2_double(money_sum("total_amount")).alias("total_revenue"))
            .orderBy(F.col("total_revenue").desc(), "product_category"))


def q09_revenue_by_payment(facts: DataFrame, p: Params) -> DataFrame:
    return (_events(facts, p).groupBy("payment_method")
            .agg(round2_double(money_sum("total_amount")).alias("total_revenue"))
            .orderBy(F.col("total_revenue").desc(), "payment_method"))


# --- product analytics ----------------------------------------------------------
def q10_category_performance(facts: DataFrame, p: Params) -> DataFrame:
    return (_events(facts, p).groupBy("product_category")
            .agg(F.countDistinct("product_id").alias("product_count"),
                 money_sum("total_amount").alias("_rev"),
                 F.sum("quantity").alias("total_quantity"))
            .select("product_category", "product_count",
                    round2_double(F.col("_rev")).alias("total_revenue"), "total_quantity",
                    ratio_round2(cents(F.col("_rev")), F.col("total_quantity")).alias("avg_price"))
            .orderBy(F.col("total_revenue").desc(), "product_category"))


def q11_top20_products(facts: DataFrame, p: Params) -> DataFrame:
    return (_by_product(facts, p)
            .agg(round2_double(money_sum("total_amount")).alias("total_revenue"),
                 F.sum("quantity").alias("total_quantity_sold"),
                 F.count("transaction_id").alias("total_orders"))
            .orderBy(F.col("total_revenue").desc(), "product_name", "product_category")
            .limit(20))


# --- store performance ----------------------------------------------------------
def _store_kpis(daily: DataFrame, p: Params) -> DataFrame:
    """Re-aggregated daily rows. SUM(unique_customers) over days counts
    a repeat customer once per day, as published."""
    agg = (_days(daily, p).groupBy("store_name")
           .agg(money_sum("total_revenue").alias("_rev"),
                F.sum("total_transactions").alias("total_transactions"),
                F.sum("unique_customers").alias("total_unique_customers"),
                F.sum("total_items_sold").alias("_items")))
    return agg.select(
        "store_name",
        round2_double(F.col("_rev")).alias("total_revenue"),
        "total_transactions", "total_unique_customers",
        ratio_round2(cents(F.col("_rev")), F.col("total_transactions")).alias("avg_transaction_value"),
        ratio_round2(F.col("_items") * 100, F.col("total_transactions")).alias("items_per_transaction"),
        ratio_round2(F.col("total_transactions") * 100, F.col("total_unique_customers"))
        .alias("transactions_per_customer"),
    )


def q12_store_performance(daily: DataFrame, p: Params) -> DataFrame:
    return _store_kpis(daily, p).orderBy(F.col("total_revenue").desc(), "store_name")


def q13_bottom_stores(daily: DataFrame, p: Params) -> DataFrame:
    """Titled stores, computed per store-day as published."""
    return (_days(daily, p).groupBy("store_name", "sale_date")
            .agg(round2_double(money_sum("total_revenue")).alias("total_revenue"))
            .orderBy(F.col("total_revenue").asc(), "store_name", "sale_date")
            .limit(5))


def q14_active_stores(stores_history: DataFrame, facts: DataFrame, p: Params) -> DataFrame:
    """Every store ever seen (SCD2 history, so DISTINCT), flagged by
    whether it sold in the range."""
    active = _events(facts, p).select(F.col("store_id").alias("_sid")).distinct()
    st = stores_history.select("store_id")
    return (st.join(active, st.store_id == active._sid, "left")
            .groupBy(F.when(F.col("_sid").isNotNull(), "Active").otherwise("Inactive").alias("store_status"))
            .agg(F.countDistinct("store_id").alias("store_count")))


def q15_engagement_top10(daily: DataFrame, p: Params) -> DataFrame:
    """The index multiplies the two *rounded* ratios."""
    return (_store_kpis(daily, p)
            .withColumn("customer_engagement_Index",
                        F.col("items_per_transaction") * F.col("transactions_per_customer"))
            .orderBy(F.col("total_revenue").desc(), "store_name")
            .limit(10))


# --- customer analytics ---------------------------------------------------------
def _segment_rank() -> Column:
    rank = F.lit(None)
    for i, name in reversed(list(enumerate(RFM_SEGMENTS, 1))):
        rank = F.when(F.col("rfm_segment") == name, F.lit(i)).otherwise(rank)
    return rank


def q16_rfm_counts(clv: DataFrame, p: Params) -> DataFrame:
    return (clv.groupBy("rfm_segment").agg(F.count(F.lit(1)).alias("customer_count"))
            .orderBy(_segment_rank()))


def q17_rfm_performance(clv: DataFrame, p: Params) -> DataFrame:
    """Share of the grand total over five rows (one task is fine)."""
    agg = (clv.groupBy("rfm_segment")
           .agg(F.count(F.lit(1)).alias("customer_count"),
                money_sum("total_spend").alias("_spend"),
                F.sum("total_orders").alias("_orders"),
                F.sum(as_money("avg_order_value")).alias("_aov")))
    total = F.sum("customer_count").over(Window.partitionBy())
    return (agg.select(
        "rfm_segment", "customer_count",
        round2_double(F.col("_spend")).alias("total_revenue"),
        mean_round2(cents(F.col("_spend")), F.col("customer_count")).alias("avg_spend"),
        mean_round2(F.col("_orders") * 100, F.col("customer_count")).alias("avg_orders"),
        mean_round2(cents(F.col("_aov")), F.col("customer_count")).alias("avg_order_value"),
        ratio_round2(F.col("customer_count") * 10000, total).alias("percentage"))
        .orderBy(_segment_rank()))


def q18_acquisition(clv: DataFrame, p: Params) -> DataFrame:
    since = p.acquisition_as_of - timedelta(days=p.acquisition_days)
    return (clv.where(F.col("first_purchase_date") >= F.lit(since.isoformat()).cast("date"))
            .groupBy(F.to_date("first_purchase_date").alias("acquisition_date"))
            .agg(F.count(F.lit(1)).alias("new_customers"))
            .orderBy("acquisition_date"))


def q19_top100_customers(clv: DataFrame, p: Params) -> DataFrame:
    return (clv.select("customer_id", "customer_name",
                       F.round("total_spend", 2).alias("total_spend"), "total_orders",
                       F.round("avg_order_value", 2).alias("avg_order_value"),
                       "first_purchase_date", "last_purchase_date", "rfm_segment")
            .orderBy(F.col("total_spend").desc(), "customer_id")
            .limit(100))


# --- SQL text over registered views (S15) ---------------------------------------
def _ts_literal(value: datetime) -> Column:
    return F.expr(f"TIMESTAMP '{value.strftime('%Y-%m-%d %H:%M:%S.%f')}'")


def date_range_arg(p: Params) -> Column:
    """The ``:date_range`` widget value: a struct with ``min`` and ``max``
    (SQL arguments must be literals or collection constructors)."""
    return F.named_struct(F.lit("min"), _ts_literal(p.date_min), F.lit("max"), _ts_literal(p.date_max))


def run_sql(spark, text: str, p: Params, **args) -> DataFrame:
    """Run dashboard SQL text with its named parameters bound: ``:date_range``
    (``:date_range.min`` / ``:date_range.max``), ``:as_of`` and
    ``:acquired_by``, plus any extra ``args``. Tables are the views
    ``TableStore.register`` created."""
    bound = {"date_range": date_range_arg(p), "as_of": F.expr(f"DATE '{p.as_of.isoformat()}'"),
             "acquired_by": F.expr(f"DATE '{p.acquisition_as_of.isoformat()}'")}
    bound.update(args)
    used = {k: v for k, v in bound.items() if f":{k}" in text}
    return spark.sql(text, args=used)
