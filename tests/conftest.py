from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from limelight.session import build_session  # noqa: E402

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests", "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.maxMetadataStringLength": "10000",
            "spark.sql.debug.maxToStringFields": "200",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(base / "shared"),
            "spark.sql.warehouse.dir": str(base / "warehouse"),
        },
    )
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Build a DataFrame from a DDL schema and row tuples."""
    def build(schema: str, *data: tuple):
        return spark.createDataFrame(list(data), schema)

    return build


@pytest.fixture(scope="session")
def data_dir():
    if not os.path.isdir(DATA):
        pytest.skip(f"no test data at {DATA}")
    return DATA


def values(df, *columns: str) -> list:
    """Rows as plain tuples (or scalars for one column), sorted by their text."""
    picked = df.select(*columns) if columns else df
    out = [tuple(r) for r in picked.collect()]
    if len(picked.columns) == 1:
        out = [r[0] for r in out]
    return sorted(out, key=str)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
