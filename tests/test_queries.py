"""Every registered query of the main library against its DuckDB SQL."""

import math

import duckdb
import pandas as pd
import pytest

from gristmill import plans
from gristmill.tables import NAMES


def norm(v):
    if v is None or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(map(norm, v))
    return round(v, 9) if isinstance(v, float) else v


def rows(pdf):
    return sorted(map(repr, [tuple(map(norm, r)) for r in pdf[sorted(pdf.columns)].astype(object).values.tolist()]))


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in NAMES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(plans.queries()))
def test_query(spark, sf, duck, name):
    got = plans.queries()[name](spark, sf).toPandas()
    if name in plans.oracle_sql():
        want = duck.execute(plans.oracle_sql()[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(got) == rows(want)
    else:
        assert len(got)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0 and set(e.oracle_sql()) <= set(e.queries())
