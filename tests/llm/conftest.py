import pytest
from pyspark.sql import functions as F

DOC = "doc_id long, text string, lang string, source string, n_chars long, lang_pred string, score double, node long, pairs string"


@pytest.fixture(scope="session", autouse=True)
def sources(spark):
    from lakeride.llm.ship import to_executors

    to_executors(spark)


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text[, lang[, source]]) with columns whose names clash with internal ones."""

    def build(rows, parts=3):
        full = [(*r, *(None,) * (4 - len(r)), None, "x", 0.5, 1, "y") for r in rows]
        return spark.createDataFrame(full, DOC).repartition(parts)

    return build


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOC).withColumn("extra", F.lit(1))
