"""The registered queries on the smallest tables: twins, and the pipeline's stages."""

from __future__ import annotations

import pytest

import corpus_pipeline
from cartpulse.llm import registry
from tests.conftest import SMALL
from verification.check import difference, duck


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_twin(spark, name):
    got = registry.queries()[name](spark, SMALL).toPandas()
    assert difference(got, duck(SMALL).execute(registry.oracle_sql()[name]).df()) == ""


def test_all_operators_and_the_pipeline_are_registered():
    names = list(registry.queries())
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14))
    assert "pipeline" in names and 4 <= len(corpus_pipeline.STAGES) <= 5


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    packed = corpus_pipeline.run(spark, SMALL).collect()
    kept = {r.doc_id for r in packed}
    # exact copies go, all else stays: near copies are few
    different = docs.select("text").distinct().count()
    assert kept <= ids and 0.9 * different <= len(kept) <= different
