"""Every registered query against its DuckDB twin (the driver's check) on
the smallest supplied data set."""

import hashlib
import os

import duckdb
import pytest

import __spark_entry__ as E
from haltgate.sources.tables import TABLES

SF = "/root/testdata/sf0.001"
# Spark's type of a column and DuckDB's description of its twin.
KINDS = {"bigint": {"BIGINT", "NUMBER"}, "int": {"INTEGER", "NUMBER"}, "double": {"DOUBLE", "NUMBER"},
         "string": {"VARCHAR", "STRING"}, "boolean": {"BOOLEAN", "bool"}, "date": {"DATE", "Date"}}


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    def norm(v):
        if isinstance(v, float):
            return repr(v)
        if isinstance(v, list):
            return ",".join(map(str, v))
        return "∅" if v is None else str(v)
    return hashlib.sha256("\n".join(sorted("|".join(norm(r[i]) for i in order) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF, f"{t}.parquet")
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "cmd_id" in df.columns


def test_every_query_has_an_oracle():
    from haltgate.plans import catalog
    assert set(catalog.oracle_sql()) == set(catalog.queries()) <= set(E.queries())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(rows) == len(drows)
    kinds = dict(zip(dcols, (str(d[1]) for d in res.description)))
    wrong = {c: (t, kinds[c]) for c, t in df.dtypes if t in KINDS and kinds[c] not in KINDS[t]}
    assert not wrong
    assert _digest(df.columns, rows) == _digest(dcols, drows)
