"""Small tables with the cases every operator must bear."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from samples import CLASHES, DOCS, SCHEMA  # noqa: E402


@pytest.fixture(scope="session")
def docs(spark):
    """All cases, with further columns that clash."""
    rows = [(*d, *([None] * len(CLASHES))) for d in DOCS]
    schema = ", ".join([SCHEMA, *[f"{name} {kind}" for name, kind in CLASHES.items()]])
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)
