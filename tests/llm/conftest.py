import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tests_llm_data import EDGE  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def plan_of(df) -> str:
    """As in the conftest above: in a run over both folders ``from conftest import`` finds this one."""
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def frame(spark):
    """A documents frame; ``extra`` adds columns whose names operators use themselves."""

    def make(rows, extra=()):
        df = spark.createDataFrame(rows, SCHEMA)
        for name in extra:
            df = df.selectExpr("*", f"'x' AS {name}")
        return df

    return make


@pytest.fixture
def edge(frame):
    return frame(EDGE, ["score", "key", "th", "weight", "slot", "component_id", "spans", "copies"])
