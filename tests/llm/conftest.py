import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from conftest_rows import DOCS, ROWS  # noqa: E402


@pytest.fixture(scope="session")
def files(spark, tmp_path_factory):
    """Write rows to Parquet and read them back: the operators take plain reads of files."""
    from sazonal.llm.common import ship

    ship(spark)

    def write(rows, schema):
        path = str(tmp_path_factory.mktemp("rows") / "t.parquet")
        spark.createDataFrame(rows, schema).write.parquet(path)
        return spark.read.parquet(path)

    return write


@pytest.fixture(scope="session")
def docs(files):
    return files(ROWS, DOCS)


@pytest.fixture(scope="session")
def no_docs(files):
    return files([], DOCS)
