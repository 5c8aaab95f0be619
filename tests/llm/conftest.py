import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table of (doc_id, text) pairs."""

    def make(rows):
        return spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], DOCS)

    return make


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def odd_docs(docs_of):
    """Nulls in ids and texts, empty and very long texts, repeated rows, ties, a column whose name clashes."""
    from pyspark.sql import functions as F

    long = " ".join(f"w{k % 977}x{k % 13}" for k in range(30_000))
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (4, "one"), (5, "one two three"), (None, "some text of no id\nsecond line"), (None, None), (6, long), (7, long), (8, "é ß ñ ΣΑΣ 日本 語"), (8, "another text of id eight")]
    return docs_of(rows).withColumn("size", F.lit("x")).withColumn("block", F.lit(1.5)).withColumn("length", F.lit(None).cast("string"))
