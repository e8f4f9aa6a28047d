"""Every query with SQL, against DuckDB on the smallest tables; and what only Python can say about the rest."""

import datetime as dt
import math
from pathlib import Path

import pytest

from cellpub.plans import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = [p.stem for p in Path(SF).glob("*.parquet")]


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.10g}")
    if isinstance(v, dt.datetime):
        return v.date()
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cursor = duck.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, cursor.fetchall())
