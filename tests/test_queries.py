"""Every query of the registry against its SQL in DuckDB, over whole tables."""

import duckdb
import pandas as pd
import pytest

from wonweave.plans import registry

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def rows(df):
    return sorted(str(tuple(None if pd.isna(x) else (round(float(x), 6) if isinstance(x, float) else x) for x in r)) for r in df.astype(object).itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_equals_sql(spark, duck, name):
    assert name in registry.SQL
    ours = registry.QUERIES[name](spark, DATA).toPandas()
    theirs = duck.sql(registry.SQL[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    columns = sorted(ours.columns)
    assert rows(ours[columns]) == rows(theirs[columns])
