"""Small documents that hold every awkward case once."""

import pytest
from pyspark.sql import Row

from crownlake.llm.common import prepare

FIELDS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def table(spark, rows):
    """``documents`` from (doc_id, text) or (doc_id, text, lang, source) rows."""
    full = [(r + (None, None))[:4] for r in rows]
    return spark.createDataFrame([Row(*r, None if r[1] is None else len(r[1])) for r in full], FIELDS)


@pytest.fixture(scope="session")
def ready(spark):
    prepare(spark)
    return spark


LONG = " ".join(f"word{i % 977}" for i in range(30_000))
AWKWARD = [
    (1, None, None, None),
    (2, "", "en", "a"),
    (3, "   \n\t ", "en", "a"),
    (4, "Hello hello HELLO the end. Ünïcode 𝒳 text, twice", "en", "a"),
    (5, "hello Hello hello the end. Ünïcode 𝒳 text, twice", "en", "b"),
    (5, "a second row with the same id", "en", "b"),
    (None, "a row without an id", None, None),
    (None, "a row without an id", None, None),
    (6, "12345 67890", "de", None),
    (7, LONG, "en", "b"),
    (8, LONG + " tail", "en", "b"),
    (9, "one", "fr", "a"),
    (9, "one", "fr", "a"),
]


@pytest.fixture(scope="session")
def awkward(ready):
    """Nulls in every column, empty and long texts, repeated rows, and other columns with awkward names."""
    from pyspark.sql import functions as F

    return table(ready, AWKWARD).withColumns(
        {c: F.lit(1) for c in ("score", "class", "label", "digest", "tokens", "block", "total", "range", "__text", "gram")}
    )


@pytest.fixture(scope="session")
def empty(ready):
    return table(ready, [])
