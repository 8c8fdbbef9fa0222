"""Registry of named queries over the driver's tables, each with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from lakeops.plans.views import VIEW_SQL, Tables
from lakeops.session import prepare

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def with_views(sql: str, views: Sequence[str]) -> str:
    """Prefix ``sql`` with the view definitions it uses, in order of dependency."""
    if not views:
        return sql
    defined = ",\n".join(f"{name} AS ({VIEW_SQL[name]})" for name in VIEW_SQL if name in views)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {defined},\n{body[5:]}"
    return f"WITH {defined}\n{body}"


def query(sql: str | None = None, views: Sequence[str] = ()):
    """Register a function of the tables under its own name."""

    def register(build: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(Tables(prepare(spark), sf_dir))

        name = build.__name__
        run.__name__ = name
        run.__doc__ = build.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_views(sql, views)
        return build

    return register
