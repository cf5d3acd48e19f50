import math

import duckdb
import pytest

from ledgerlake.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


def norm(v):
    return (None if math.isnan(v) else round(v, 6)) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = QUERIES[name](spark, SF)
    cols = sorted(got.columns)
    want = con.execute(SQL[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == cols
    left = sorted((tuple(norm(r[c]) for c in cols) for r in got.collect()), key=repr)
    assert left == sorted((tuple(norm(r[names.index(c)]) for c in cols) for r in want.fetchall()), key=repr)


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
