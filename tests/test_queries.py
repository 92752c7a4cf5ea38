"""Every registered query against its SQL, rows compared as a multiset."""

from pathlib import Path

import duckdb
import pyarrow as pa
import pytest

from __spark_entry__ import oracle_sql, queries
from sheetloom.oracles import ORACLES
from sheetloom.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test data")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for file in Path(SF).glob("*.parquet"):
        con.execute(f"create view {file.stem} as from '{file}'")
    return con


def cell(value):
    return repr(round(float(value), 6)) if isinstance(value, (int, float)) and not isinstance(value, bool) else repr(value)


def table(arrow: pa.Table):
    names = sorted(arrow.column_names)
    columns = [[cell(v) for v in arrow.column(n).to_pylist()] for n in names]
    return names, sorted(zip(*columns))


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(oracle_sql()) <= set(queries())


@pytest.mark.filterwarnings("ignore")
@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    names, got = table(QUERIES[name](spark, SF).toArrow())
    expected_names, expected = table(con.execute(ORACLES[name]).to_arrow_table())
    assert names == expected_names
    assert len(got) == len(expected)
    assert got == expected
