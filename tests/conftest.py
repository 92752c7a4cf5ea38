import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from sheetloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(8, "8g", "sheetloom tests")
    if not session.conf.get("spark.checkpoint.dir", None):
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sheet(spark):
    """A sheet from rows of cells, row 1 first; rows keep their place when shuffled."""
    def make(rows):
        width = max(len(r) for r in rows)
        data = [(i + 1, *r, *[None] * (width - len(r))) for i, r in enumerate(rows)]
        schema = "row_idx bigint, " + ", ".join(f"_c{i} string" for i in range(width))
        return spark.createDataFrame(data[::-1], schema).repartition(3)

    return make


@pytest.fixture
def rows():
    def collect(df, *columns):
        df = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in df.collect()), key=repr)

    return collect
