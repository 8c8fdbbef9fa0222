"""Batches that are replaced whole, and folded."""

from __future__ import annotations

import pytest

from lakeops.llm.batches import BatchFolder
from lakeops.llm.token_counts import TokenTotals
from lakeops.workspace import new_folder


def test_an_attempt_without_commit_is_not_read(spark, rows):
    folder = BatchFolder(spark, new_folder(spark, "batches"), "x int")
    assert folder.read().count() == 0 and folder.names().count() == 0
    folder.write("one", spark.createDataFrame([(1,)], "x int"))
    folder._attempt("one", spark.createDataFrame([(5,)], "x int"))  # stopped before its commit
    folder._attempt("two", spark.createDataFrame([(6,)], "x int"))
    assert rows(folder.read()) == [(1, "one")]
    folder.write("one", spark.createDataFrame([(2,)], "x int"))
    assert rows(folder.read()) == [(2, "one")]
    with pytest.raises(ValueError):
        folder.write("a/b", spark.range(1))


def test_totals_are_folded_once(spark, rows):
    kind = "source string, lang string, tokenizer string, docs long, tokens long"
    totals = TokenTotals(spark, new_folder(spark, "totals"))
    assert totals.totals().count() == 0
    totals.compact()
    one = spark.createDataFrame([("a", None, "t", 1, 10), ("b", "en", "t", 1, 5)], kind)
    totals.commit("one", one)
    totals.commit("two", spark.createDataFrame([("a", None, "t", 1, 7), ("b", "en", "t", -1, -5)], kind))
    totals.compact()
    assert rows(totals.totals()) == [("a", None, "t", 2, 17)]
    totals.commit("one", one)  # counted already
    totals.commit("three", one)
    totals.compact()
    totals.compact()
    assert rows(totals.totals()) == [("a", None, "t", 3, 27), ("b", "en", "t", 1, 5)]
    assert rows(totals.batches.names()) == [("one",), ("three",), ("two",)]
