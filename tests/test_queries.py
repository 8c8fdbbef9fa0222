"""Every registered query against its SQL, and what its plan must not contain."""

from __future__ import annotations

import math
import os
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from lakeops.plans import load_all
from tests.conftest import SF_DIR

QUERIES, ORACLES = load_all().QUERIES, load_all().ORACLES
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()
# A listing of files, which another test compares.
WITHOUT_SQL = {"storage_size"}
SPARK_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def canonical(rows):
    def text(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return "NULL"
        return repr(float(v)) if isinstance(v, float) else str(v)

    return sorted(tuple(map(text, r)) for r in rows)


def test_every_query_has_sql():
    assert set(QUERIES) - set(ORACLES) == WITHOUT_SQL


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    result = duck.execute(ORACLES[name])
    types = {d[0]: str(d[1]) for d in result.description}
    found = result.fetchall()
    assert sorted(df.columns) == sorted(types)
    rows = df.select(list(types)).collect()
    assert canonical(rows) == canonical(found)
    # DuckDB has wider integers for some functions; values are compared above
    integers = {"INTEGER", "BIGINT", "HUGEINT"}
    for column, kind in df.dtypes:
        want = types[column]
        assert SPARK_TYPES[kind] == want or {SPARK_TYPES[kind], want} <= integers, column

    plan = df._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "Pandas", "BatchEvalPython"):
        assert unwanted not in plan
    assert ("ArrowEvalPython" in plan) == (name == "fuzzy_match")


def test_storage_size(spark):
    sizes = {r.table_name: r["bytes"] for r in QUERIES["storage_size"](spark, SF_DIR).collect()}
    assert set(sizes) == set(TABLES) and all(sizes.values())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("without", [["lakeops/llm"], ["lakeops/llm", "corpus_pipeline.py"], ["corpus_pipeline.py"]])
def test_entry_without_training_data_operators(tmp_path, without):
    """A copy without those parts imports, and has the other queries."""
    root = Path(contract.__file__).parent
    copied = [f for f in root.rglob("*.py") if f.relative_to(root).parts[0] in ("lakeops", "corpus_pipeline.py", "__spark_entry__.py")]
    for f in copied:
        name = f.relative_to(root)
        if not any(str(name).startswith(w) for w in without):
            (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
            (tmp_path / name).write_text(f.read_text())
    code = "import __spark_entry__ as e; print(' '.join(e.queries())); assert set(e.oracle_sql()) <= set(e.queries())"
    run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True)
    assert run.returncode == 0, run.stderr
    names = set(run.stdout.split())
    assert set(QUERIES) <= names and "pipeline" not in names
    assert any(n.startswith("op1_") for n in names) == ("lakeops/llm" not in without)


def test_filter_reaches_the_scan(spark):
    plan = QUERIES["high_scorers"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_quantity,30.0)" in plan
    assert "l_extendedprice" not in plan


def test_top_rows_are_not_sorted_in_full(spark):
    for name in ("join_schedule", "join_advanced", "efficient_filter"):
        plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
        assert "TakeOrderedAndProject" in plan
