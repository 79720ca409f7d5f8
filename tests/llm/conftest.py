import pytest
from sample_rows import DOCS, ROWS


@pytest.fixture(scope="session")
def docs(spark):
    """Those rows, with columns whose names the operators use themselves."""
    frame = spark.createDataFrame(ROWS, DOCS)
    return frame.selectExpr("*", "1 AS row", "2 AS block", "'x' AS keep_id", "3 AS mix", "4 AS score", "5 AS token", "6 AS rank", "7 AS words", "8 AS set_id", "9 AS maybe_repeated", "10 AS class_id")


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.where("false")
