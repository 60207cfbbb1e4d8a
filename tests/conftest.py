import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from starmart.session import local_session

    session = local_session(4, partitions=4, memory="4g", shared=str(tmp_path_factory.mktemp("shared")))
    session.conf.set("spark.sql.maxMetadataStringLength", "5000")  # whole PushedFilters in plans
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of tuples (nulls first)."""

    def collect(df):
        return sorted((tuple(r) for r in df.collect()), key=lambda t: [(v is not None, str(v)) for v in t])

    return collect


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def plan():
    return plan_of
