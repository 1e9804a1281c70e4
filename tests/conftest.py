import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tidewatch.session import local_session

    session = local_session(cpus=4, app="tidewatch-tests", memory="4g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def rows(spark):
    """rows(df, *cols) -> sorted list of tuples."""

    def collect(df, *cols):
        cols = cols or tuple(df.columns)
        return sorted((tuple(r[c] for c in cols) for r in df.select(*cols).collect()), key=repr)

    return collect
