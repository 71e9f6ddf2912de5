"""Registered queries against their SQL twins, and the pipeline stage by stage."""

import os

import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from farmledger.llm.catalog import ORACLES, QUERIES
from farmledger.llm.scratch import keep
from tests.llm.common import documents, empty, pairs
from tests.oracle import compare, connect

SF_DIR = os.environ.get("FARMLEDGER_TEST_SF", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_sql_twin(spark, name):
    assert compare(connect(SF_DIR), QUERIES[name](spark, SF_DIR), ORACLES[name]) == ""


def test_all_operators_are_registered():
    names = set(queries())
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names
    assert set(oracle_sql()) >= set(ORACLES)


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, rows = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES:
        out = keep(stage(spark, docs, SF_DIR), "test")
        if name == "packing":
            assert out.select("doc_id").distinct().count() == rows
            assert out.groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).where("`sum(length)` <> `max(doc_tokens)`").count() == 0
            break
        assert out.columns == columns
        kept = out.count()
        assert kept == rows if name == "secrets" else 0 < kept <= rows
        docs, rows = out, kept
    assert corpus_pipeline.run(spark, SF_DIR).select("doc_id").distinct().count() == rows


def test_stages_take_difficult_rows(spark):
    docs = documents(spark)
    for rows in (docs, empty(spark)):
        for name, stage in corpus_pipeline.STAGES:
            out = keep(stage(spark, rows, SF_DIR), "test")
            if name != "packing":
                assert out.columns == docs.columns
                assert {r.doc_id for r in out.select("doc_id").collect()} <= {r.doc_id for r in rows.select("doc_id").collect()}
                rows = out
    texts = [t for _, t in pairs(rows)]
    assert not texts
