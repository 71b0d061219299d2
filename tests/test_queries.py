"""Every registered query of the library against its SQL in DuckDB, and rows-only checks for the rest."""

import math

import pytest

from curio.plans import registry

duckdb = pytest.importorskip("duckdb")
QUERIES, ORACLES = registry.queries(), registry.oracles()


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    for t in registry.TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return c


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, (list, tuple)):
        return tuple(map(norm, v))
    return v


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    cols = sorted(df.columns)
    got = sorted(repr(tuple(map(norm, r))) for r in df.select(*[f"`{c}`" for c in cols]).collect())
    rel = duck.sql(ORACLES[name])
    assert sorted(rel.columns) == cols
    want = sorted(repr(tuple(map(norm, r))) for r in rel.select(*[f'"{c}"' for c in cols]).fetchall())
    assert got == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


def test_entry_is_guarded():
    import __spark_entry__

    assert set(QUERIES) <= set(__spark_entry__.queries()) and set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
