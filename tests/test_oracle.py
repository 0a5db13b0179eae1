"""Every query that SQL can say, against DuckDB over the same whole tables."""

from pathlib import Path

import duckdb
import pandas as pd
import pytest

from quire import queries

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in Path(DATA).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return con


def plain(x):
    if x is None or x is pd.NA or x is pd.NaT or isinstance(x, float) and x != x:
        return None
    x = x.item() if hasattr(x, "item") else x
    return float(x) if isinstance(x, (int, float)) and not isinstance(x, bool) else x


def rows(df):
    df = df[sorted(df.columns)]
    return sorted((tuple(map(plain, r)) for r in df.astype(object).itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_the_same_rows(spark, duck, name):
    mine, theirs = queries.QUERIES[name](spark, DATA).toPandas(), duck.execute(queries.ORACLE[name]).df()
    assert sorted(mine.columns) == sorted(theirs.columns)
    assert rows(mine) == rows(theirs)


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLE)))
def test_the_others_run(spark, name):
    assert queries.QUERIES[name](spark, DATA).count() >= 0
