import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from aforo.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    os.environ.setdefault("PYSPARK_PYTHON", sys.executable)
    scratch = tmp_path_factory.mktemp("spark")
    session = build_session(
        "aforo-tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__driver__memory="4g",
        spark__sql__warehouse__dir=str(scratch / "warehouse"),
        spark__checkpoint__dir=str(scratch / "shared"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
