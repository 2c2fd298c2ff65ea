import pytest
from pyspark.sql import types as T

LONG = " ".join(f"word{i % 997} tail{i % 1009}" for i in range(60_000))
EDGES = [
    (1, "one two three four five six seven eight nine ten eleven twelve", "en", "src0", 9),
    (2, "one two three four five six seven eight nine ten eleven twelve", "en", "src0", 9),
    (2, "one two three four five six seven eight nine ten eleven twelve", "en", "src0", 9),
    (3, None, None, None, None),
    (4, "", "de", "src1", 0),
    (5, " \t\n\v\f\r ", "de", "src1", 6),
    (None, "a row without an id, but with words enough to be read as a text of its own", "fr", None, 3),
    (None, "a row without an id, but with words enough to be read as a text of its own", "fr", None, 3),
    (6, LONG, "en", "src7", len(LONG)),
    (-7, "​ naïve words ключ 漢字 \U0001f600 x\ty", "xx", "elsewhere", None),
]
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: names that operators use inside
CLASHING = "score kept fp node bucket tag doc anchor unit start n kind order rank tail rest copies domain language y word held_out".split()


@pytest.fixture(scope="session")
def edge_docs(spark):
    return spark.createDataFrame(EDGES, DOCS)


@pytest.fixture(scope="session")
def clashing_docs(edge_docs):
    from pyspark.sql import functions as F

    return edge_docs.select("*", *(F.lit(7).alias(c) for c in CLASHING))


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], T.StructType.fromDDL("doc_id long, quality int, toxic int"))


@pytest.fixture(scope="session")
def small(spark):
    return lambda name: spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")
