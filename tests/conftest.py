import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from keepsake.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "tests",
        master="local[8]",
        conf={"spark.ui.enabled": "false", "spark.driver.memory": "12g"},
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of tuples."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple(map(str, r)))

    return collect


@pytest.fixture
def same():
    """Both frames hold the same rows, copies counted."""

    def check(a, b):
        b = b.select(*a.columns)
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()

    return check
