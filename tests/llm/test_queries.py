"""Registered queries against DuckDB where SQL expresses them, and the pipeline stage by stage."""

from __future__ import annotations

import pytest

import corpus_pipeline
from drivestats.llm import queries
from drivestats.llm.common import table, written
from tests.oracle_compare import compare, duck

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_sql(spark, name):
    problems, *_ = compare(spark, duck(SMALL), name, queries.registry()[name], queries.oracle_sql()[name], SMALL)
    assert not problems, problems


def test_pipeline(spark):
    docs = table(spark, SMALL, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, written(stage(spark, docs, SMALL), name)
        assert docs.columns == before.columns
        assert docs.count() >= 0.5 * before.count()
        assert docs.select("doc_id").exceptAll(before.select("doc_id")).isEmpty()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert packed.select("doc_id").distinct().count() == docs.count()
    assert packed.groupBy("sequence_id").sum("length").where("`sum(length)` > 1024").isEmpty()
