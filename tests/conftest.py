import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from placeweave.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, **{"spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of tuples (missing first)."""
    def collect(df, *columns):
        chosen = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in chosen.collect()), key=lambda t: tuple((v is not None, str(v)) for v in t))
    return collect


@pytest.fixture
def one(spark):
    """Evaluate column expressions over one literal row."""
    def evaluate(*columns):
        row = spark.range(1).select(*columns).first()
        return row[0] if len(columns) == 1 else tuple(row)
    return evaluate
