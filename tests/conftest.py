import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from tidemark.session import SINGLE_TASK_ROWS_KEY, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(partitions=4, memory="6g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def small_tasks(spark):
    """Force the forms for groups too large for one task."""
    spark.conf.set(SINGLE_TASK_ROWS_KEY, "7")
    yield spark
    spark.conf.unset(SINGLE_TASK_ROWS_KEY)
