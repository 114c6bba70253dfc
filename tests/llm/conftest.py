import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names that operators use for themselves.
CLASHES = ["kept", "piece", "length", "_sha", "_maybe", "block", "key", "sequence_id", "Row", "class_id", "_verdict", "_doc_id", "_text_key"]


@pytest.fixture(scope="session")
def documents(spark):
    """A table of documents from (doc_id, text[, lang[, source]]), with columns whose names clash."""

    def make(rows, clashes=True):
        full = [(r[0], r[1], *(r[2:3] or [None]), *(r[3:4] or [None]), len(r[1]) if r[1] else 0) for r in rows]
        df = spark.createDataFrame(full, SCHEMA)
        return df.withColumns({c: F.lit("x") for c in CLASHES}) if clashes else df

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """NULLs, empty and blank texts, equal rows, other alphabets, control characters, a very long text."""
    long = " ".join(f"word{i % 977} other{i % 31}\n" for i in range(60_000))
    return [(1, None), (2, ""), (3, "   \n\t "), (4, "same text"), (5, "same text"), (5, "same text"), (None, "no id"), (None, None), (6, "漢字 и текст 😀 ﬁ x"), (7, "a\x1cb\x00c"), (8, long), (9, "<|endoftext|> in text"), (10, "z" * 3000)]
