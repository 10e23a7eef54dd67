from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))
sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from oracle import session

    from martloom.session import tune

    spark = tune(session())
    yield spark
    spark.stop()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="martloom-test-")


@pytest.fixture
def rows():
    """Rows of a DataFrame as a sorted list of tuples."""

    def get(df):
        return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))

    return get
