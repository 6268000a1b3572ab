from __future__ import annotations

import os

import pyarrow.parquet as pq
import pytest

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_rows():
    """The small documents table as plain rows."""
    return pq.read_table(f"{SF}/documents.parquet").to_pylist()


@pytest.fixture
def docs(frame):
    """A documents table from ``(doc_id, text)`` pairs, with one source and language."""

    def make(*pairs, schema=DOCS):
        return frame(schema, *[(i, t, "en", "s", len(t or "")) for i, t in pairs])

    return make
