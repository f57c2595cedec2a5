import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from millrace.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        master="local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "6g", "spark.checkpoint.dir": "/tmp/millrace-tests/checkpoints", "spark.sql.warehouse.dir": "/tmp/millrace-tests/warehouse"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Collect a frame as a sorted list of tuples."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=repr)

    return collect
