import os
from concurrent.futures import ThreadPoolExecutor

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL

def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert "context_summary" in df.columns


def test_registry_consistency():
    q, s = entry.queries(), entry.oracle_sql()
    assert set(s) <= set(q)
    assert len(q) >= 100


def _norm(v):
    import datetime as dt
    import decimal
    import math
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else repr(round(v, 6))
    if isinstance(v, decimal.Decimal):
        return repr(round(float(v), 6))
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def answers(spark):
    """Every query with an oracle, a few at a time: (columns, rows) or the error."""
    from ledgerline.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    builders = entry.queries()

    def run(name):
        try:
            df = builders[name](spark, SF_SMALL)
            return df.columns, [tuple(r) for r in df.collect()]
        except Exception as e:                       # raised by the query's own test
            return e

    with ThreadPoolExecutor(6) as pool:
        names = sorted(entry.oracle_sql())
        yield dict(zip(names, pool.map(run, names)))


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_against_duckdb(answers, name):
    if isinstance(answers[name], Exception):
        raise answers[name]
    columns, rows = answers[name]
    con = duckdb.connect()
    for t in (x.removesuffix(".parquet") for x in os.listdir(SF_SMALL)):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    cur = con.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(columns) == sorted(ocols)
    assert _rows(columns, rows) == _rows(ocols, cur.fetchall())
