import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from (doc_id, text) pairs."""

    def make(rows, schema="doc_id long, text string"):
        return spark.createDataFrame(rows, schema)

    return make
