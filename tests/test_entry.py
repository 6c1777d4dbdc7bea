import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as E
from ledgerline.sources.tables import DRIVER_TABLES
from conftest import SMALL_SF


def test_entry_smoke(spark):
    df = E.entry(spark)
    out = df.collect()
    assert df.columns == ["company_name", "total_value"]
    assert 0 < len(out) <= 10


def test_every_query_has_oracle_or_is_listed():
    assert set(E.oracle_sql()) <= set(E.queries())


def _norm(v):
    if v is None:
        return "~"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{round(v, 6):.6f}"
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def _digest(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in data)
    return sorted(cols), len(lines), hashlib.sha256("\n".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL_SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SMALL_SF)
    got = _digest(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(E.oracle_sql()[name])
    want = _digest([d[0] for d in cur.description], cur.fetchall())
    assert got == want
