"""Distributed ntile (W4), joins (J1-J8), row rules (D1-D5),
money arithmetic and landing keys (S12, S13)."""

from datetime import datetime
from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from shopfloor.functions import money, rules
from shopfloor.operators import joins
from shopfloor.operators.ranking import global_row_number, ntile
from shopfloor.sources import landing


# --- W4 ---------------------------------------------------------------------------
@pytest.mark.parametrize("n,parts", [(7, 3), (1, 4), (5, 8), (1500, 8), (101, 1)])
def test_ntile_equals_single_window_ntile(spark, n, parts):
    df = spark.range(n).select(F.col("id").cast("int").alias("k"), (F.col("id") * 7919 % 13).alias("m"))
    order = [F.col("m").desc(), F.col("k").asc()]
    ours = ntile(df, 5, order, "t", partitions=parts)
    native = df.withColumn("t", F.ntile(5).over(Window.orderBy(*order)))
    assert sorted(map(tuple, ours.select("k", "t").collect())) == sorted(
        map(tuple, native.select("k", "t").collect()))


def test_ntile_bucket_sizes_seven_rows(spark):
    df = spark.range(7).select(F.col("id").alias("k"))
    sizes = [r["c"] for r in ntile(df, 5, [F.col("k")], "t", 3).groupBy("t").agg(F.count("*").alias("c"))
             .orderBy("t").collect()]
    assert sizes == [2, 2, 1, 1, 1]


def test_ntile_all_ties_follow_key(spark):
    df = spark.range(10).select(F.col("id").alias("k"), F.lit(1).alias("m"))
    got = [r["t"] for r in ntile(df, 5, [F.col("m"), F.col("k")], "t", 4).orderBy("k").collect()]
    assert got == [1, 1, 2, 2, 3, 3, 4, 4, 5, 5]


def test_ntile_keys_ranks_narrow_rows(spark):
    from shopfloor.operators.ranking import ntile_keys
    df = spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 7 % 11).alias("m"), F.lit("wide").alias("w"))
    ours = ntile_keys(df, ["k"], 5, {"t": F.col("m"), "u": -F.col("m")})
    native = df.withColumn("t", F.ntile(5).over(Window.orderBy("m", "k"))).withColumn("u", F.ntile(5).over(Window.orderBy(F.desc("m"), "k")))
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, native.collect()))


@pytest.mark.parametrize("n,sample", [(0, 8), (1, 8), (4, 8), (5, 8), (37, 8), (3000, 40), (20000, 500)])
def test_ntile_cuts_equal_ntile_at_any_sample(spark, n, sample):
    """Cuts found in several rounds: nearly all ties, all different, text, NULL, NaN and signed zero."""
    from shopfloor.operators.ranking import ntile_keys
    i = F.col("id")
    df = spark.range(n).select(
        i.alias("k"), F.concat(F.lit("n"), i % 3).alias("name"),
        F.when(i % 10 != 0, 1).otherwise(i % 4).alias("ties"), (F.xxhash64(i) / 1e6).alias("free"),
        F.when(i % 5 == 0, F.lit(None)).when(i % 7 == 0, F.lit("nan").cast("double")).when(i % 2 == 0, -0.0).otherwise(0.0).alias("odd"),
        F.when(i % 3 == 0, F.lit(None)).otherwise(F.hex(F.xxhash64(i))).alias("text"), F.lit(7).alias("same"))
    metrics = ["ties", "free", "odd", "text", "same"]
    ours = ntile_keys(df, ["k", "name"], 5, {f"t_{m}": F.col(m) for m in metrics}, sample=sample)
    native = df
    for m in metrics:
        native = native.withColumn(f"t_{m}", F.ntile(5).over(Window.orderBy(m, "k", "name")))
    tiles = ["k", *[f"t_{m}" for m in metrics]]
    assert sorted(map(tuple, ours.select(*tiles).collect())) == sorted(map(tuple, native.select(*tiles).collect()))
    assert ours.schema[-1].dataType == native.schema[-1].dataType


def test_ntile_cuts_move_no_rows(spark):
    """The tiles are a projection: no exchange, sort or join in the plan."""
    from shopfloor.operators.ranking import ntile_keys
    plan = ntile_keys(spark.range(5000), ["id"], 5, {"t": F.col("id") % 9}, sample=50)._jdf.queryExecution().toString()
    assert not any(step in plan for step in ("Exchange", "Sort", "Join"))


def test_ntile_cuts_refuse_repeated_keys(spark):
    from shopfloor.operators.ranking import ntile_keys
    same = spark.range(400).select(F.lit(1).alias("k"))
    with pytest.raises(ValueError, match="not unique"):
        ntile_keys(same, ["k"], 2, {"t": F.lit(0)}, sample=10)


def test_global_row_number_dense_and_total(spark):
    df = spark.range(1000).select((F.col("id") * 31 % 1000).alias("v"))
    out = global_row_number(df, [F.col("v")], partitions=6)
    rows = out.orderBy("_rn").collect()
    assert [r["_rn"] for r in rows] == list(range(1, 1001))
    assert [r["v"] for r in rows] == sorted(r["v"] for r in rows)
    assert {r["_n"] for r in rows} == {1000}


# --- joins -------------------------------------------------------------------------
def test_semi_plus_anti_is_input(spark):
    facts = spark.range(200).select(F.col("id").alias("row"), (F.col("id") % 17).alias("k"))
    dim = spark.range(0, 17, 2).select(F.col("id").alias("k"))
    semi, anti = joins.semi_join(facts, dim, ["k"]), joins.orphans(facts, dim, ["k"])
    assert semi.count() + anti.count() == 200
    assert semi.join(anti, "row").count() == 0


def test_joins_carry_no_hint(spark):
    dim = spark.range(100).select(F.col("id").alias("k"))
    plan = joins.semi_join(dim, dim, ["k"])._jdf.queryExecution().analyzed().toString().lower()
    assert "hint" not in plan and "broadcast" not in plan


# --- row rules -----------------------------------------------------------------------
def test_amount_and_tax_boundary(spark):
    df = spark.createDataFrame([(2, 1000.00), (2, 1000.01), (3, 99.99)], "q int, p double")
    out = df.select(rules.line_amount(F.col("q"), F.col("p")).alias("a"), "p")
    out = out.select("a", rules.tax_amount(F.col("a"), F.col("p")).alias("t")).collect()
    assert [(r["a"], r["t"]) for r in out] == [(2000.0, 100.0), (2000.02, 240.0), (299.97, 15.0)]


def test_rounding_half_up(spark):
    df = spark.createDataFrame([("1.005",), ("2.675",), ("0.285",)], "s string")
    got = [r[0] for r in df.select(F.round(F.col("s").cast("decimal(18,3)"), 2).cast("double")).collect()]
    assert got == [1.01, 2.68, 0.29]


def test_name_attributes(spark):
    df = spark.createDataFrame([("Red T-Shirt XL (Men)",), ("Socks",)], "n string")
    got = df.select(rules.name_color(F.col("n")), rules.name_size(F.col("n"))).collect()
    assert [tuple(r) for r in got] == [("Red", "XL"), ("Socks", None)]


def test_category_family_first_match_wins(spark):
    cases = {"T-Shirt": "formal", "Sweatshirt": "formal", "Nehru Jacket": "ethnic", "Tracksuit": "sport",
             "Denim Jacket": "winter", "Gown": "party", "Cap": "accessories", "Loafers": "footwear",
             "Jeans": "default"}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    got = {r[0]: r[1] for r in df.select("t", rules.category_family(F.col("t"))).collect()}
    assert got == cases


def test_single_line_address(spark):
    df = spark.createDataFrame([("1 Main St\nSpringfield\nUS",)], "a string")
    assert df.select(rules.single_line_address(F.col("a"))).first()[0] == "1 Main St, Springfield, US"


# --- money ----------------------------------------------------------------------------
def _half_up(num: int, den: int) -> float:
    return float((Decimal(num) / Decimal(100) / Decimal(den)).quantize(Decimal("0.01"), ROUND_HALF_UP))


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(-10**9, 10**9), st.integers(-500, 500).filter(lambda d: d != 0)),
                min_size=1, max_size=20))
def test_ratio_round2_matches_decimal(spark, pairs):
    df = spark.createDataFrame(pairs, "n long, d long")
    got = [r[0] for r in df.select(money.ratio_round2(F.col("n"), F.col("d"))).collect()]
    assert got == [_half_up(n, d) for n, d in pairs]


def test_ratio_zero_denominator_is_null(spark):
    df = spark.createDataFrame([(100, 0)], "n long, d long")
    assert df.select(money.ratio_round2(F.col("n"), F.col("d"))).first()[0] is None


def test_ratio_is_exact_above_2_53(spark):
    pairs = [(2**53 + i, d) for i in range(1, 40) for d in (1, 2, 3)] + [(-(2**53) - 7, 3)]
    df = spark.createDataFrame(pairs, "n long, d long")
    got = [r[0] for r in df.select(money.ratio_round2(F.col("n"), F.col("d"))).collect()]
    assert got == [_half_up(n, d) for n, d in pairs]


def test_int_div_is_exact_above_2_53(spark):
    pairs = [(2**53 + i, d) for i in range(200) for d in (1, 2, 7)]
    df = spark.createDataFrame(pairs, "a long, b long")
    assert [r[0] for r in df.select(money.int_div(F.col("a"), F.col("b"))).collect()] == [a // b for a, b in pairs]


def test_amounts_below_a_cent_are_summed_before_rounding(spark):
    df = spark.createDataFrame([(0.125,)] * 100, "x double")
    total, mean = df.agg(money.round2_double(money.money_sum("x")),
                         money.mean_round2(money.cents(money.money_sum("x")), F.count("x"))).first()
    assert (total, mean) == (12.5, 0.13)


def test_money_sum_exact(spark):
    df = spark.createDataFrame([(0.1,)] * 10 + [(0.2,)] * 10, "x double")
    assert df.agg(money.round2_double(money.money_sum("x"))).first()[0] == 3.0


# --- landing keys -----------------------------------------------------------------
def test_existing_keys_missing_folder_is_empty(spark, scratch):
    out = landing.existing_keys_at(spark, f"{scratch}/nothing", "customers", "customer_id")
    assert out.count() == 0 and out.columns == ["customer_id"]


def test_next_key_empty_and_filled(spark, scratch):
    empty = spark.createDataFrame([], "transaction_id int")
    assert landing.next_key(empty, "transaction_id").first()[0] == 1
    filled = spark.createDataFrame([(3,), (9,), (None,)], "transaction_id int")
    assert landing.next_key(filled, "transaction_id").first()[0] == 10


def test_landing_reads_int_and_bigint_files(spark, scratch):
    for kind in ("int", "bigint"):
        path = f"{scratch}/{kind}"
        spark.createDataFrame([(7, 2)], f"transaction_id {kind}, quantity {kind}").write.parquet(path)
        row = landing.read_batch(spark, path, "sales").first()
        assert (row["transaction_id"], row["quantity"], row["store_id"]) == (7, 2, None)


def test_bronze_time_is_utc_in_any_zone(spark):
    from datetime import timezone
    from shopfloor.plans import bronze
    zone = spark.conf.get("spark.sql.session.timeZone")
    feed = spark.createDataFrame([(1, 2**40)], "store_id bigint, name bigint").selectExpr(
        "store_id", "cast(name as string) name", "cast(null as string) address", "cast(null as string) manager",
        "cast(null as timestamp) open_date", "cast(null as string) status", "cast(null as string) phone_number",
        "cast(null as timestamp) last_update_time")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
        for ts in (datetime(2024, 1, 1, 12), datetime(2024, 1, 1, 12, tzinfo=timezone.utc)):
            got = bronze.bronze(feed, "stores", ts).selectExpr("unix_seconds(ingest_timestamp) s").first()["s"]
            assert got == 1704110400
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_try_cast_makes_what_does_not_fit_null(spark):
    from shopfloor.plans import bronze
    feed = spark.createDataFrame([(1, 3_000_000_000), (2, 5)], "product_id bigint, stock_quantity bigint")
    assert [r[0] for r in feed.select(*[c for c in bronze.typed("products") if "stock_quantity" in str(c)]).collect()] == [None, 5]


def test_append_and_allocate_keys(spark, scratch):
    path = f"{scratch}/landing/stores"
    t = datetime(2024, 1, 1)
    first = spark.createDataFrame(
        [(1, "a", "x", None, t, "Open", "p1", t), (2, "b", "y", "m", t, "Open", "p2", t)],
        "store_id int, name string, address string, manager string, open_date timestamp, status string, "
        "phone_number string, last_update_time timestamp")
    landing.append(first, path, "stores")
    batch = spark.createDataFrame([("z",), ("x",), ("y",)], "name string")
    landed = landing.read_batch(spark, path, "stores")
    got = landing.allocate_keys(batch, landed, "store_id", [F.col("name")])
    assert sorted((r["name"], r["store_id"]) for r in got.collect()) == [("x", 3), ("y", 4), ("z", 5)]
    assert landed.schema["manager"].dataType.simpleString() == "string"
    assert landing.existing_keys_at(spark, path, "stores", "store_id").count() == 2
