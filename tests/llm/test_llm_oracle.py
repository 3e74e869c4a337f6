from __future__ import annotations

import duckdb
import pytest

from terrafold.llm import queries as Q


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_same_as_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    got = Q.queries()[name](spark, sf_dir).toPandas()
    want = con.execute(Q.oracle_sql()[name]).fetchdf()
    columns = sorted(got.columns)
    plain = lambda df: sorted(tuple(str(v) for v in r) for r in df[columns].itertuples(index=False))
    assert columns == sorted(want.columns) and plain(got) == plain(want)
