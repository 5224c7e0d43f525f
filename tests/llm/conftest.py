import pytest
from pyspark.sql import types as T

from tidemark.llm import ship

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship.ensure(spark)


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from ``(doc_id, text)`` or ``(doc_id, text, source)``."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, DOCUMENTS)

    return make


@pytest.fixture
def write(spark, tmp_path):
    """A folder with the given tables as parquet files."""

    def to(**tables):
        for name, df in tables.items():
            df.coalesce(2).write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return to
