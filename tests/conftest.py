from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cedeflow.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, memory="4g")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """A DataFrame from a schema text and rows."""

    def make(schema: str, *rows: tuple):
        return spark.createDataFrame(list(rows), schema)

    return make
