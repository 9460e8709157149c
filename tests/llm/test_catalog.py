"""Registered queries: SQL equality on sf0.001, and the pipeline stage by stage."""
import os

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shopfloor.llm import catalog, decontam, simhash, substring
from shopfloor.llm.common import read_table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("documents", "benchmark", "conversations", "labels", "embeddings", "pages"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    got = catalog.QUERIES[name](spark, SF)
    want = duck.sql(catalog.ORACLE_SQL[name])
    columns = sorted(got.columns)
    assert sorted(want.columns) == columns
    order = [want.columns.index(c) for c in columns]
    key = lambda row: tuple(map(str, row))
    assert sorted(([r[c] for c in columns] for r in got.collect()), key=key) == sorted(([r[k] for k in order] for r in want.fetchall()), key=key)


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in catalog.QUERIES) == list(range(1, 14))


def test_native_operators_run_no_python(spark):
    for name in ("op3_chat_format", "op8_licenses", "op11_exact_dedup"):
        plan = catalog.QUERIES[name](spark, SF)._jdf.queryExecution().toString()
        assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


def test_pipeline_stages(spark):
    docs = read_table(spark, SF, "documents").withColumn("extra", F.lit("kept"))
    ids = {r.doc_id for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, corpus_pipeline.materialize(stage(spark, docs, SF), "test")
        now = {r.doc_id for r in docs.select("doc_id").collect()}
        assert now and now <= ids and docs.count() == len(now)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == before.columns and docs.dtypes == before.dtypes
        if name == "simhash_near_dedup":
            groups = simhash.near_duplicates(before).select("component_id").distinct()
            assert now == {r.component_id for r in groups.collect()}
        if name == "substring_dedup":
            assert substring.cut_repeats(before).where("n_removed = n_words and n_words > 0").count() == len(ids) - len(now)
        if name == "benchmark_decontamination":
            assert decontam.search(docs, read_table(spark, SF, "benchmark")).where(decontam.contaminated()).count() == 0
        ids = now
    assert docs.columns == ["doc_id", "lang", "source", "n_ids", "ids"]


def test_pipeline_run_equals_stages(spark):
    docs = read_table(spark, SF, "documents")
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, docs, SF), "test")
    key = lambda r: r.doc_id
    assert sorted(corpus_pipeline.run(spark, SF).collect(), key=key) == sorted(docs.collect(), key=key)


def test_pipeline_on_odd_documents(spark, docs_of, prose):
    passage = prose(60, seed=1)
    docs = docs_of([(1, None), (2, ""), (3, prose(300, seed=2) + " " + passage), (4, prose(300, seed=3) + " " + passage), (4, prose(300, seed=3) + " " + passage),
                    (None, prose(100, seed=4)), (6, prose(20_000, seed=5))])
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, docs, SF), "test")
    rows = docs.collect()
    assert len(rows) == len({r.doc_id for r in rows}) and {3, 4, 6} <= {r.doc_id for r in rows}
    empty = docs_of([])
    for _, stage in corpus_pipeline.STAGES:
        empty = corpus_pipeline.materialize(stage(spark, empty, SF), "test")
    assert empty.count() == 0
