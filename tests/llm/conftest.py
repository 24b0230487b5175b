import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def docs_frame(spark):
    """Rows (doc_id, text, lang, source) as a documents table; more columns may follow."""
    def make(rows, extra=()):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, r[3] if len(r) > 3 else None,
                 len(r[1] or "")) + tuple(0 for _ in extra) for r in rows]
        schema = T.StructType(DOCS.fields + [T.StructField(c, T.IntegerType()) for c in extra])
        return spark.createDataFrame(full, schema)
    return make


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


ODD = [(None, "a row without an id"), (5, None), (6, ""), (7, "  \t\n"), (7, "  \t\n"),
       (8, "x " * 30_000), (9, "same words in two rows of one id"), (9, "same words in two rows of one id"),
       (10, "Zoë's naïve café, l’été 　日本語 é <|endoftext|> \U0001F600")]


@pytest.fixture(scope="session")
def odd_rows():
    return ODD
