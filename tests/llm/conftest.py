import pytest

from lendmill.llm.tables import importable


@pytest.fixture(autouse=True)
def workers(spark):
    importable(spark)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
