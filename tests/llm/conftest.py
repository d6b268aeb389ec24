from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """A frame of documents from (doc_id, text) or longer rows."""

    def make(rows):
        whole = [(*row, *[None] * (5 - len(row))) for row in rows]
        return spark.createDataFrame(whole, DOCUMENTS)

    return make


@pytest.fixture(scope="session")
def sf_dir():
    path = "/root/testdata/sf0.001"
    if not Path(path).is_dir():
        pytest.skip("no test data")
    return path
