import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def spark():
    from sazonal.session import build_session

    session = build_session(
        "sazonal-tests",
        spark__master="local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
