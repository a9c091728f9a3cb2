import pytest
from pyspark.sql import types as T

#: Columns whose names the operators use inside.
CLASHING = ["key", "n", "block", "fp", "part", "start", "copies", "score", "label", "node", "g", "size", "copy"]
DOC_SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                           T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
                           *[T.StructField(c, T.StringType()) for c in CLASHING]])

EN = "The quick brown fox jumps over the lazy dog and then it runs away from the old house. "
FR = "Le renard brun saute par dessus le chien paresseux et puis il quitte la vieille maison. "


def doc(i, text, lang=None, source=None):
    return (i, text, lang, source, None if text is None else len(text), *["x"] * len(CLASHING))


def hard_rows():
    """Nulls in every column, empty, blank and long texts, ties and repeated rows."""
    rows = [doc(0, EN * 3, "en", "a"), doc(1, FR * 3, "fr", "b"), doc(2, None, "en", "a"), doc(3, "", "fr", None), doc(4, " \n\t ", None, "b"),
            doc(5, EN * 3, "en", "a"), doc(5, EN * 3, "en", "a"), doc(None, FR * 2, "fr", "b"), doc(None, None, None, None),
            doc(6, "12345 67890 !!! ---", None, "c"), doc(7, (EN + FR) * 400, "en", "a"), doc(8, "one", "en", "c"),
            doc(9, "tab\tand  two spaces\r\nand\x1ca separator \x00", "en", "c"), doc(11, "x" * 5000, None, "c")]
    return rows + [doc(20 + i, (EN if i % 2 else FR) * (1 + i % 4) + f"Number {i}.", "en" if i % 2 else "fr", "abc"[i % 3]) for i in range(40)]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(hard_rows(), DOC_SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)
