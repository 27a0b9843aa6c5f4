import pytest
from pyspark.sql import SparkSession


@pytest.fixture(autouse=True)
def _settings(spark: SparkSession):
    """The settings of the operators."""
    from tally.llm.store import prepare
    prepare(spark)


@pytest.fixture
def documents(spark):
    """Rows (doc_id, text) with a column whose name clashes with outputs of the operators."""
    def make(rows):
        return spark.createDataFrame([(d, t, "x", None, "y") for d, t in rows],
                                     "doc_id long, text string, kept string, lang string, source string")
    return make
