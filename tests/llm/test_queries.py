"""Queries next to their SQL, and the pipeline's stages."""

import pytest

from millrace.llm import queries
from tests.conftest import SF_DIR
from tests.oracle import compare, connect


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(spark, name):
    assert compare(queries.QUERIES[name](spark, SF_DIR), connect(SF_DIR), queries.SQL[name]) is None


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = corpus_pipeline.write_through(stage(spark, docs, SF_DIR), f"test-{name}")
        assert sorted(kept.columns) == sorted(docs.columns) and 0 < kept.count() <= docs.count()
        docs = kept
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert {r[0] for r in packed.select("doc_id").distinct().collect()} == {r[0] for r in docs.select("doc_id").collect()}
