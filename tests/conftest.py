import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from starmill.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    work = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="4", spark__default__parallelism="2",
        spark__driver__memory="8g",
        spark__sql__warehouse__dir=str(work / "warehouse"), spark__checkpoint__dir=str(work / "checkpoint"))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
