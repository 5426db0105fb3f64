from __future__ import annotations

import duckdb
import pytest
from conftest import SMALL

from indexday.llm.book import QUERIES, SQL


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("pages", "embeddings", "documents"):
        con.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    df = QUERIES[name](spark, SMALL)
    columns = sorted(df.columns)
    result = con.execute(SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    theirs = sorted(tuple(str(r[names.index(c)]) for c in columns) for r in result.fetchall())
    assert sorted(tuple(str(r[c]) for c in columns) for r in df.collect()) == theirs
