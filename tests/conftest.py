from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidemart.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "local[8]", "tests", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="6g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def retail(spark):
    from tidemart.testbed.bindings import Retail
    return Retail(spark, SF)


@pytest.fixture
def lake_dir(spark):
    from tidemart.session import scratch_dir
    return scratch_dir(spark, "test")


def rows(df, *order):
    """Rows as tuples, sorted."""
    df = df.select(*order) if order else df
    return sorted((tuple(r) for r in df.collect()), key=repr)
