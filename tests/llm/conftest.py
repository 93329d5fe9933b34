import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("words", T.StringType()),  # names that operators use for their own columns
        T.StructField("n", T.LongType()),
        T.StructField("score", T.DoubleType()),
    ]
)

WORDS = (
    "river stone cloud garden winter simple answer market yellow window father bridge copper"
    " forest silver planet orange kitchen thunder feather harbor meadow lantern pepper walnut"
).split()


def prose(seed: int, count: int) -> str:
    """Deterministic words, with a sentence mark now and then."""
    out, x = [], seed * 7919 + 17
    for k in range(count):
        x = (x * 1103515245 + 12345) % (1 << 31)
        word = WORDS[(x >> 8) % len(WORDS)] + WORDS[(x >> 16) % len(WORDS)][:3]
        out.append(word.capitalize() + "." if k % 9 == 8 else word)
    return " ".join(out)


@pytest.fixture(scope="session")
def docs(spark):
    """DataFrame of documents from (doc_id, text) or (doc_id, text, lang, source)."""

    def make(*rows):
        full = [(*r, *(None,) * (4 - len(r)), "words", 1, 0.5) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture(scope="session")
def labels(spark):
    def make(*rows):
        return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Null and empty texts, no words, one word, repeated rows, a null id, a very long text."""
    return [
        (1, None),
        (2, ""),
        (3, " \t\n"),
        (4, "word"),
        (5, prose(5, 80)),
        (5, prose(5, 80)),
        (None, prose(6, 80)),
        (None, None),
        (7, prose(7, 30_000)),
        (8, "!!! ### $$$"),
    ]
