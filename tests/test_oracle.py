"""Every registered query against its DuckDB SQL on the sf0.001 tables."""

import datetime as dt
import decimal
import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF001

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v + 0.0
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def test_every_query_has_oracle_sql():
    """The training-data operators have SQL where SQL can express them; sketches are approximate."""
    own = {k for k in E.queries() if not (k == "pipeline" or k.startswith("op"))} - {"supplier_medians_sketched"}
    assert own <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("key", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF001)
    cur = con.execute(E.oracle_sql()[key])
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    idx = [ocols.index(c) for c in df.columns]
    orows = Counter(repr(tuple(_norm(r[i]) for i in idx)) for r in cur.fetchall())
    srows = Counter(repr(tuple(_norm(v) for v in r)) for r in df.collect())
    assert srows == orows


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns[:2] == ["campaign_id", "cpa"]
    assert df.count() >= 0
