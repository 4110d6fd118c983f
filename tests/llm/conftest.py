import pytest
from pyspark.sql import Row
from samples import make, odd_rows


@pytest.fixture(scope="session")
def odd(spark):
    return make(spark, odd_rows())


@pytest.fixture(scope="session")
def empty(spark):
    return make(spark, []).limit(0)


@pytest.fixture(scope="session")
def labels(spark):
    schema = "doc_id long, quality int, toxic int, text string"
    rows = [Row(i, i % 2, (i // 2) % 2, "x") for i in range(1, 12)] + [Row(None, 1, 1, "x"), Row(3, None, None, "x"), Row(4, 7, 9, "x")]
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
