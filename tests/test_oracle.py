"""Every registered query of the engine against its SQL twin."""

from __future__ import annotations

import duckdb
import pandas as pd
import pytest

from terrafold.plans import queries as Q

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def rows(df, columns):
    plain = lambda v: "NULL" if v is None or v is pd.NA or v != v else repr(v.item() if hasattr(v, "item") else v)
    return sorted(tuple(plain(v) for v in r) for r in df[columns].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_same_as_sql(spark, duck, sf_dir, name):
    got = Q.queries()[name](spark, sf_dir).toPandas()
    want = duck.execute(Q.oracle_sql()[name]).fetchdf()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns) and len(got) > 0
    assert rows(got, columns) == rows(want, columns)


def test_every_query_has_a_twin():
    assert set(Q.queries()) == set(Q.oracle_sql())


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0 and set(entry.oracle_sql()) <= set(entry.queries())
