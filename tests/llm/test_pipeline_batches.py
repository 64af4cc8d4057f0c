"""The pipeline's Python stages take whole texts in small Arrow batches; results do not depend on their size."""

import pytest

import corpus_pipeline
from cadastre.llm.common import table
from conftest import rows

PYTHON_STAGES = ["near_duplicates", "personal_data", "mix_sources", "encode"]


@pytest.fixture
def batch(spark):
    before = spark.conf.get(SETTING)
    yield lambda n: spark.conf.set(SETTING, n)
    spark.conf.set(SETTING, before)


SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


@pytest.mark.parametrize("given, used", [(10_000, "1000"), (0, "1000"), (300, "300")])
@pytest.mark.parametrize("name", PYTHON_STAGES)
def test_python_stages_take_small_batches(spark, sf_dir, batch, name, given, used):
    batch(given)
    dict(corpus_pipeline.STAGES)[name](spark, table(spark, sf_dir, "documents").limit(5), sf_dir)
    assert spark.conf.get(SETTING) == used


def test_masked_texts_do_not_depend_on_batches(spark, sf_dir, batch):
    docs = table(spark, sf_dir, "documents")
    found = []
    for n in (7, 1000):
        batch(n)
        found.append(rows(corpus_pipeline.personal_data(spark, docs, sf_dir)))
    assert found[0] == found[1]
