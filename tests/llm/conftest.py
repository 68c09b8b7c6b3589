"""Small edge tables shared by the operator tests."""

import pytest
from pyspark.sql import types as T

LONG = " ".join(f"w{i % 977}x{i}" for i in range(60_000))

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


def doc_rows():
    """Nulls, empties, ties, repeated rows, a very long text, odd bytes."""
    texts = [(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa"), (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa"),
             (2, "alpha beta gamma delta epsilon zeta eta theta iota kappa"), (3, None), (4, ""), (5, " \n\t "), (6, "one"),
             (7, "One"), (None, "one"), (None, None), (8, LONG), (9, LONG + " tail"), (10, "Ünïcode \u00a0 nbsp\u2028sep \x00 nul 😀 emoji"),
             (11, "x" * 50_000), (12, "a a a a a a a a a a"), (-5, "negative id text here")]
    return [(i, t, None, "s", None if t is None else len(t)) for i, t in texts]


@pytest.fixture(scope="session")
def edge_docs(spark):
    return spark.createDataFrame(doc_rows(), DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def sf001(spark):
    from ridgeline.llm.common import read_table

    return lambda name: read_table(spark, "/root/testdata/sf0.001", name)
