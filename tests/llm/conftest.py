"""Fixtures for the training-data operators."""

import pytest
from odd_cases import documents, odd_rows


@pytest.fixture(scope="session")
def odd_documents(spark):
    return documents(spark, odd_rows())


@pytest.fixture(scope="session")
def no_documents(spark):
    return documents(spark, [])


@pytest.fixture(scope="session")
def stored(spark, tmp_path_factory):
    """Writes a frame once and reads it back, as stages do."""
    def write(df):
        path = str(tmp_path_factory.mktemp("stored") / "t.parquet")
        df.write.parquet(path)
        return spark.read.parquet(path)
    return write


SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_documents(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")
