import uuid

import pytest


@pytest.fixture
def stored(spark, tmp_path_factory):
    """Rows as a stored table with extra columns whose names clash with internal ones."""

    def make(rows, schema="doc_id bigint, text string"):
        path = str(tmp_path_factory.mktemp("t") / uuid.uuid4().hex)
        df = spark.createDataFrame(rows, schema)
        df.selectExpr("*", "1 as locator", "2 as n", "3 as fp", "'x' as digest").repartition(3).write.parquet(path)
        return spark.read.parquet(path)

    return make
