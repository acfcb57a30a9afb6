import os
import sys
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tributary.lake import Lake  # noqa: E402
from tributary.session import build_session, shared_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]",
        **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g", "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lake(spark):
    """A lake of its own for every test, in the session's shared folder."""
    return Lake(spark, f"{shared_dir(spark)}/tests/{uuid.uuid4().hex}")


def rows(df):
    """Rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
