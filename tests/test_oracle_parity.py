"""Oracle parity on the smallest scale for the registered queries (the
driver runs the same comparison at sf0.01)."""

import hashlib
import os

import duckdb
import pytest

SF = "/root/testdata/sf0.001"


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    norm = lambda v: "\x00" if v is None else (repr(round(v, 6)) if isinstance(v, float) else str(v))
    lines = sorted("\x1e".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in sorted(f.removesuffix(".parquet") for f in os.listdir(SF)):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


def _names():
    import __spark_entry__ as E
    return list(E.oracle_sql())


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, duck, name):
    import __spark_entry__ as E
    sdf = E.queries()[name](spark, SF)
    scols, srows = sdf.columns, [tuple(r) for r in sdf.collect()]
    res = duck.execute(E.oracle_sql()[name])
    dcols, drows = [d[0] for d in res.description], res.fetchall()
    assert sorted(scols) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _digest(scols, srows) == _digest(dcols, drows)


def test_every_query_has_entry(spark):
    import __spark_entry__ as E
    assert set(E.oracle_sql()) <= set(E.queries())
    assert E.entry(spark).count() >= 0
