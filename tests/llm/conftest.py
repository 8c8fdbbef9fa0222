from __future__ import annotations

import pytest

#: Texts that every operator must take.
ODD = [None, "", "   \n\t ", "one", "Two words", "é ñ ß — 漢字 🙂", "x" * 3000, "a b c " * 2000, "<|endoftext|>", "12 345 !!"]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Odd texts, a repeated row, NULL in any column, and columns whose names operators use."""
    rows = [(i, t, "en", "s1", "x") for i, t in enumerate(ODD)]
    rows += [rows[4], (None, "no id at all", "fr", None, None), (50, "no source", None, None, "y"), (51, None, None, None, None)]
    kind = "doc_id long, text string, lang string, source string, id string"
    docs = spark.createDataFrame(rows, kind)
    from pyspark.sql import functions as F

    extra = ["n", "key", "score", "blob", "spans", "group", "component_id", "n_tokens", "label", "y"]
    return docs.withColumns({c: F.lit("extra") for c in extra})


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
