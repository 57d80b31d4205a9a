import pytest

from foreglass.llm.language import Languages, labelled_sample


@pytest.fixture(scope="session")
def languages(spark):
    return Languages.fit(*labelled_sample(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), "doc_id", "text", "lang"))
