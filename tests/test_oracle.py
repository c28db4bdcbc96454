"""Every registered query equals its DuckDB oracle on the same driver tables."""

import datetime as dt
import decimal

import duckdb
import pytest

import __spark_entry__ as E
from ledgerline.plans.oracle import ORACLE_SQL
from ledgerline.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(repr(_norm(r[i])) for i in order) for r in rows))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE_SQL) <= set(E.oracle_sql())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["periode", "n_orders", "net_revenue"] and df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    s_cols, s_rows = df.columns, df.collect()
    res = con.sql(ORACLE_SQL[name])
    d_cols, d_rows = res.columns, res.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert _rows(s_cols, s_rows) == _rows(d_cols, d_rows)


def test_entry_module_loads_by_path_from_elsewhere(tmp_path):
    """A driver may load the entry file by path from another directory."""
    import os
    import subprocess
    import sys
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = ("import importlib.util; "
            f"s = importlib.util.spec_from_file_location('e', {os.path.join(here, '__spark_entry__.py')!r}); "
            "m = importlib.util.module_from_spec(s); s.loader.exec_module(m); "
            "print(*sorted(set(m.QUERIES) & set(m.queries()) & set(m.oracle_sql())))")
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True,
                         text=True, timeout=120)
    assert out.returncode == 0, out.stderr[-500:]
    assert out.stdout.split() == sorted(QUERIES)
