import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tools"))

from gridgale.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "tests", master="local[4]", spark__sql__shuffle__partitions="4", spark__driver__memory="6g",
        spark__sql__maxMetadataStringLength="10000",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def plan_of(df) -> str:
    """The final physical plan as text."""
    return df._jdf.queryExecution().executedPlan().toString()
