"""Every registered query against its DuckDB statement on the smallest driver tables."""

import datetime
import decimal
import math
from pathlib import Path

import pytest
from deedflow.plans import catalog

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="the driver's tables are not here")


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, float, decimal.Decimal)):
        return round(float(value), 6)
    if isinstance(value, (datetime.date, datetime.datetime)):
        return str(value)[:10]
    return value


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for file in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def test_every_query_has_a_statement():
    assert set(catalog.queries()) == set(catalog.oracle_sql())


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_equals_statement(spark, duck, name):
    got = catalog.queries()[name](spark, str(DATA))
    want = duck.execute(catalog.oracle_sql()[name])
    names = [c[0] for c in want.description]
    assert sorted(names) == sorted(got.columns)
    order = sorted(names)
    mine = sorted(([plain(r[c]) for c in order] for r in got.collect()), key=repr)
    theirs = sorted(([plain(dict(zip(names, r))[c]) for c in order] for r in want.fetchall()), key=repr)
    assert mine == theirs
