"""Python workers of an executor: each takes memory and stays for later stages, so a task uses one at a time."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops import workspace
from lakeops.llm import batches, components, learning, ngram_join
from lakeops.workspace import new_folder

STEPS = re.compile("ArrowEvalPython|BatchEvalPython|MapInArrow|FlatMapGroupsInArrow")


def plan(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def steps(df: DataFrame) -> int:
    """The most Python steps of a task: those between two exchanges."""
    return max(len(STEPS.findall(part)) for part in plan(df).split("Exchange"))


@pytest.fixture
def samples(spark):
    texts = ["one two three four five six", "one two three four five six", "", "other words than these", " \n"]
    rows = [(i, t, i % 2) for i, t in enumerate(texts * 2)]
    return workspace.stored(spark.createDataFrame(rows, "id long, text string, y int"), "samples")


def test_copies_are_found_by_one_step(samples):
    once = learning.without_copies(samples)
    assert "ArrowEvalPython" in plan(once) and steps(once) == 1
    assert sorted(r.id for r in once.collect()) == [0, 2, 3]


def test_join_writes_links_before_components(samples, monkeypatch):
    written = {}

    def stored(df, name):
        written.setdefault(name, []).append(steps(df))
        return workspace.stored(df, name)

    for module in (ngram_join, components):
        monkeypatch.setattr(module, "stored", stored)
    found = ngram_join.ngram_join(samples, id_col="id").collect()
    assert {r.doc_id: r.component_id for r in found} == {0: 0, 1: 0, 5: 0, 6: 0, 2: 2, 7: 7, 3: 3, 8: 3, 4: 4, 9: 9}
    assert 1 in written["edges"] + written["links"] and max(max(n) for n in written.values()) == 1


def test_batches_have_no_rows_from_python(spark, samples, monkeypatch):
    folder = batches.BatchFolder(spark, new_folder(spark, "batches"), "id bigint, text string")
    committed, commit = [], folder._commit
    monkeypatch.setattr(folder, "_commit", lambda rows: committed.append(rows) or commit(rows))
    for empty, kind in ((folder.current(), "batch string, attempt string, at bigint, folded boolean"), (folder.read(), "id bigint, text string, batch string")):
        assert "ExistingRDD" not in plan(empty) and empty.count() == 0
        assert [f"{c} {t}" for c, t in empty.dtypes] == kind.split(", ")
    assert folder.write("a", samples.select("id", "text"))
    assert folder.write("a", samples.select("id", "text"))
    assert committed and not any("ExistingRDD" in plan(rows) for rows in committed)
    assert folder.read().filter(F.col("batch") == "a").count() == samples.count() and folder.current().count() == 1
