"""Every registered query against its DuckDB SQL on the smallest driver scale."""

import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as entry
from flightlake.plans.fixtures import DRIVER_TABLES

SF = "/root/testdata/sf0.001"


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(float(v))
    return repr(v)


def _digest(rows):
    return hashlib.sha256("\n".join(sorted("|".join(map(_norm, r)) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in DRIVER_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_sql():
    assert set(entry.queries()) - set(entry.LLM_QUERIES) == set(entry.oracle_sql()) - set(entry.LLM_SQL)
    assert set(entry.LLM_SQL) <= set(entry.LLM_QUERIES)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["Name", "flight_count"] and df.count() > 0


@pytest.mark.parametrize("key", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, con, key):
    sdf = entry.queries()[key](spark, SF)
    cols = sorted(sdf.columns)
    srows = [tuple(r[c] for c in cols) for r in sdf.collect()]
    rel = con.sql(entry.oracle_sql()[key])
    assert sorted(rel.columns) == cols
    drows = [tuple(dict(zip(rel.columns, r))[c] for c in cols) for r in rel.fetchall()]
    assert len(srows) == len(drows)
    assert _digest(srows) == _digest(drows)
