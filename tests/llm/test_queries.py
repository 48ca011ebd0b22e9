"""The registered queries: SQL twins where there are any, and the whole pipeline."""

import pytest

import corpus_pipeline
from registry.compare import compare, connect
from skygrain.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, sf, name):
    assert compare(QUERIES[name](spark, sf), connect(sf), ORACLES[name]) == ""


def test_pipeline_keeps_columns_and_ends_in_places(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, docs, sf)
        assert left.columns == docs.columns and 0 < left.count() <= docs.count()
        docs = left
    assert {"doc_id", "shard", "bin", "bin_offset"} <= set(corpus_pipeline.STAGES[-1][1](spark, docs, sf).columns)
