"""One local session for all tests."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from factgraph.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    os.environ.setdefault("PYSPARK_SUBMIT_ARGS", "--master local[8] --driver-memory 8g pyspark-shell")
    session = build_session(
        "factgraph-tests",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "4",
            # Plans name all pushed filters.
            "spark.sql.maxMetadataStringLength": "4000",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
