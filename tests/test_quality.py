"""Expectations (E1-E4): hand-made rows of FIXTURES.md section 3."""

import pytest
from pyspark.sql import functions as F

from shopfloor.operators.quality import DROP, FAIL, WARN, Expectation, enforce, observed, report
from shopfloor.plans import silver


def _ids(df, col="id"):
    return sorted(r[col] for r in df.collect())


def test_fail_raises_on_null_key(spark):
    df = spark.createDataFrame([(1,), (None,)], "id int")
    rule = Expectation("valid_id", "id IS NOT NULL", FAIL)
    with pytest.raises(Exception, match="valid_id"):
        enforce(df, [rule]).collect()


def test_fail_survives_column_pruning(spark):
    """Selecting a column the rule does not read must still run the check."""
    df = spark.createDataFrame([(1, "a"), (None, "b")], "id int, v string")
    checked = enforce(df, [Expectation("valid_id", "id IS NOT NULL", FAIL)])
    with pytest.raises(Exception, match="valid_id"):
        checked.select("v").collect()


def test_fail_passes_clean_rows(spark):
    df = spark.createDataFrame([(1,), (2,)], "id int")
    assert _ids(enforce(df, [Expectation("valid_id", "id IS NOT NULL", FAIL)])) == [1, 2]


def test_drop_price_bounds_and_null_category(spark):
    rows = [(1, 98.99, "a"), (2, 99.00, "a"), (3, 9999.99, "a"), (4, 10000.00, "a"), (5, 500.0, None)]
    df = spark.createDataFrame(rows, "id int, price double, category string")
    rules = [r for r in silver.PRODUCT_RULES if r.name in ("valid_product_price", "valid_category")]
    assert _ids(enforce(df, rules)) == [2, 3]


def test_drop_discount_null_is_violation(spark):
    df = spark.createDataFrame([(1, -0.01), (2, 0.0), (3, None)], "id int, discount_applied double")
    rule = Expectation("valid_discount", "discount_applied >= 0", DROP)
    assert _ids(enforce(df, [rule])) == [2]


def test_warn_keeps_rows_and_counts(spark):
    ages = [(1, 15), (2, 16), (3, 100), (4, 101), (5, None)]
    df = spark.createDataFrame(ages, "id int, age int")
    rule = Expectation("realistic_age", "age >= 16 AND age <= 100", WARN)
    obs_df, obs = observed(df, "ages", [rule])
    kept = enforce(obs_df, [rule])
    assert _ids(kept) == [1, 2, 3, 4, 5]
    assert obs.get == {"rows": 5, "realistic_age": 3}


def test_email_rule(spark):
    df = spark.createDataFrame([(1, None), (2, "a@b"), (3, "a@b.c")], "id int, email string")
    rule = next(r for r in silver.CUSTOMER_RULES if r.name == "valid_email")
    rep = {r["rule"]: (r["passed"], r["failed"]) for r in report(df, "c", [rule]).collect()}
    assert rep == {"valid_email": (2, 1)}


def test_report_shape_and_counts(spark):
    df = spark.createDataFrame([(1, 5), (None, -1), (3, None)], "id int, n int")
    rules = [Expectation("id_ok", "id IS NOT NULL", DROP), Expectation("n_pos", "n >= 0", WARN)]
    out = report(df, "t", rules)
    assert out.columns == ["dataset", "rule", "action", "passed", "failed"]
    got = sorted(tuple(r) for r in out.collect())
    assert got == [("t", "id_ok", "drop", 2, 1), ("t", "n_pos", "warn", 1, 2)]


def test_manager_rule_sees_body_output(spark):
    """Predicates see the dataset body: the NULL manager is already 'Unknown'."""
    df = spark.createDataFrame([(1, None, "Open"), (2, "m", "Closed")], "store_id int, manager string, status string")
    body = silver.stores_body(df)
    rep = {r["rule"]: r["failed"] for r in report(body, "stores", silver.STORE_RULES).collect()}
    assert rep == {"valid_store_id": 0, "valid_manager_name": 0, "valid_status": 1}
    assert body.where(F.col("manager") == "Unknown").count() == 1


def test_streaming_fail_raises(spark, scratch):
    """E1 on a stream: a null key stops the query."""
    src = f"{scratch}/in"
    spark.createDataFrame([(1,), (None,)], "id int").write.parquet(src)
    stream = spark.readStream.schema("id int").parquet(src)
    checked = enforce(stream, [Expectation("valid_id", "id IS NOT NULL", FAIL)])
    q = (checked.writeStream.format("parquet").option("path", f"{scratch}/out")
         .option("checkpointLocation", f"{scratch}/ckpt").trigger(availableNow=True).start())
    with pytest.raises(Exception, match="valid_id"):
        q.awaitTermination()
