"""Every registered query with an oracle must match DuckDB on sf0.001."""

import duckdb
import pandas as pd
import pytest

from conftest import SF_SMALL
from panelops.plans.catalog import ORACLE, QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and v != v):
        return None
    if isinstance(v, pd.Timestamp):
        return str(v.date()) if v == v.normalize() else str(v)
    if isinstance(v, float) and v.is_integer():
        return str(int(v))
    return str(v)


def _canon(df):
    df = df[sorted(df.columns)].astype(object).apply(lambda s: s.map(_norm))
    return sorted(map(tuple, df.itertuples(index=False)), key=lambda t: tuple("" if x is None else x for x in t))


def test_every_query_has_a_callable():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle_parity(spark, con, name):
    got = QUERIES[name](spark, SF_SMALL).toPandas()
    want = con.execute(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert _canon(got) == _canon(want)
