import os
import sys
from contextlib import contextmanager

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from skyloom.operators.match import CELL_CONF
from skyloom.operators.skew import HOT_CONF
from skyloom.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", os.environ.get("BENCH_CPUS", "8"), 4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def hot(spark):
    """Context in which groups above the given size are and cells above the given size are treated as hot."""

    @contextmanager
    def limit(rows: int):
        for conf in (HOT_CONF, CELL_CONF):
            spark.conf.set(conf, str(rows))
        try:
            yield
        finally:
            for conf in (HOT_CONF, CELL_CONF):
                spark.conf.unset(conf)

    return limit
