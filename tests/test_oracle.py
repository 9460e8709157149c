"""Every registered query against its DuckDB oracle SQL on sf0.001: row
count, column names and an order-insensitive hash of the values (the same
comparison the driver runs at sf0.01)."""

import hashlib

import pytest

import __spark_entry__ as E
from shopfloor.plans.catalog import QUERIES

from tests.conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return repr(round(v, 9))
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha1("\n".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    yield con
    con.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


def test_oracle_imports_nothing_from_the_package():
    import oracle.sql
    assert "shopfloor" not in open(oracle.sql.__file__).read()


def test_rules_and_lookups_are_exercised(spark):
    """The derived feeds trigger what the rows above compare."""
    run = lambda name: QUERIES[name](spark, SF_SMALL)
    for name, key in (("h1_scd2_customers", "customer_id"), ("h2_scd2_products", "product_id"), ("h3_scd2_stores", "store_id")):
        assert run(name).where("__END_AT IS NOT NULL").count() > 0, name
    assert run("v1_customers_current").count() == spark.read.parquet(f"{SF_SMALL}/customer.parquet").count()
    assert run("d1_d2_amount_tax").where("NOT tax_ok").count() == 0
    assert run("d3_d4_product_attributes").select("category_family").distinct().count() == 8
    assert run("d5_single_line_address").where("address LIKE '%, floor%'").count() > 0
    assert {r.store_status for r in run("q14_active_stores").collect()} == {"Active", "Inactive"}
    assert {r.missing_dimension for r in run("j8_orphans").select("missing_dimension").distinct().collect()} == {"stores", "customers", "products"}
    assert run("b3_bronze_products").where("stock_quantity IS NULL").count() > 0


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["store_name", "total_revenue"]
    assert len(df.collect()) <= 5


# Type families shared by the two engines' names.
FAMILY = {"int": "i32", "integer": "i32", "bigint": "i64", "double": "f64", "string": "str", "varchar": "str",
          "date": "date", "timestamp": "ts", "timestamp_ntz": "ts", "boolean": "bool"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    rel = duck.sql(E.oracle_sql()[name])
    ocols, otypes = rel.columns, [str(t).lower() for t in rel.types]
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    spark_types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    for col, otype in zip(ocols, otypes):
        assert FAMILY.get(spark_types[col], spark_types[col]) == FAMILY.get(otype, otype), col
    assert len(rows) == len(orows)
    assert _digest(df.columns, rows) == _digest(ocols, orows)
