from __future__ import annotations

import pytest

from lakeops.plans.views import Tables
from lakeops.session import build_session

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "lakeops-tests",
        master="local[4]",
        settings={
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables(spark):
    return Tables(spark, SF_DIR)


@pytest.fixture
def rows():
    """Rows of a frame as sorted tuples, NULL first."""

    def collect(df, *columns):
        chosen = df.select(*columns) if columns else df
        return sorted(
            (tuple(r) for r in chosen.collect()),
            key=lambda r: [(v is not None, str(v) if isinstance(v, bool) else v) for v in r],
        )

    return collect
