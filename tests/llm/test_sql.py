"""The registered queries against their SQL."""

import duckdb
import pandas as pd
import pytest

from llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def plain_value(x):
    """A value as text: integers alike, whatever type a column with nulls has."""
    if x is None or x is pd.NA or x != x:
        return "~"
    return str(int(x)) if isinstance(x, float) and x == int(x) else str(x)


@pytest.mark.parametrize("name", ORACLES)
def test_sql(spark, name):
    db = duckdb.connect()
    for table in ("documents", "embeddings"):
        db.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    found, wanted = QUERIES[name](spark, SF).toPandas(), db.sql(ORACLES[name]).df()
    columns = sorted(found.columns)
    assert columns == sorted(wanted.columns)
    a, b = (sorted(tuple(map(plain_value, row)) for row in x[columns].itertuples(index=False)) for x in (found, wanted))
    assert a == b
