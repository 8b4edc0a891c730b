"""The registered queries that SQL can express against that SQL."""

import duckdb
import pytest

from gristmill.llm import queries
from gristmill.tables import NAMES


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql(spark, sf, name):
    con = duckdb.connect()
    for t in NAMES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    want = con.execute(queries.oracle_sql()[name])
    columns = sorted(d[0] for d in want.description)
    at = [[d[0] for d in want.description].index(c) for c in columns]
    got = queries.queries()[name](spark, sf)
    assert sorted(got.columns) == columns
    assert sorted(map(repr, (tuple(r) for r in got.select(*columns).collect()))) == sorted(map(repr, (tuple(r[i] for i in at) for r in want.fetchall())))
