"""Every query with a SQL equivalent, against DuckDB over the same files."""

import math
import os
from pathlib import Path

import pytest

import __spark_entry__ as entry_module

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test data")
QUERIES, ORACLES = entry_module.queries(), entry_module.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        con.execute(f"create view {path.stem} as select * from read_parquet('{path}')")
    yield con
    con.close()


def plain(value):
    if value is None:
        return ""
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return str(value)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(plain(r[i]) for i in order) for r in rows)


def test_names():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equal_to_sql(spark, duck, name):
    found = QUERIES[name](spark, SF_DIR)
    wanted = duck.execute(ORACLES[name])
    types = {"boolean": "BOOLEAN", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR"}
    assert {c: types[t] for c, t in found.dtypes} == {d[0]: str(d[1]) for d in wanted.description}
    assert table(found.columns, [tuple(r) for r in found.collect()]) == table(
        [d[0] for d in wanted.description], wanted.fetchall()
    )


def test_every_query_of_the_library_has_one():
    assert {f.__name__ for f in entry_module.QUERIES} <= set(ORACLES)
