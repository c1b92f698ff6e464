"""Every query of the library with oracle SQL, held against DuckDB on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from spanloom.plans.catalogue import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


def rows(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    fix = lambda x: repr(round(x, 5) + 0.0) if isinstance(x, float) else str(x)
    return sorted(tuple(fix(r[i]) for i in order) for r in data)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows(spark, duck, name):
    got = QUERIES[name](spark, SF)
    want = duck.execute(ORACLE_SQL[name])
    cols = [d[0] for d in want.description]
    assert sorted(cols) == sorted(got.columns)
    a, b = rows(got.columns, [tuple(r) for r in got.collect()]), rows(cols, want.fetchall())
    assert len(a) == len(b)
    assert a == b
    assert a, "no rows"
