"""Every registered query against its DuckDB oracle on the smallest tables."""

import decimal
import math

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from tidewater.sources.tables import TABLES, table_path

QUERIES = entry.queries()
ORACLE = entry.oracle_sql()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6))
    if isinstance(v, decimal.Decimal):
        return str(v.normalize())
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return "∅" if v is None else str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF_SMALL, t)}')")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = df.collect()
    if name not in ORACLE:
        return
    cur = con.execute(ORACLE[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _rows(df.columns, rows) == _rows(ocols, cur.fetchall())
