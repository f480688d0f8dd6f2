import math
import os

import duckdb
import pandas as pd
import pytest

from ledgerspark.llm.queries import REGISTRY

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def rows(pdf):
    plain = [tuple(None if pd.isna(v) else v for v in r)
             for r in pdf[sorted(pdf.columns)].itertuples(index=False, name=None)]
    return sorted(plain, key=repr)


def close(a, b):
    return a == b or (isinstance(a, float) and isinstance(b, float) and math.isclose(a, b))


@pytest.mark.parametrize("name", sorted(n for n, (_, sql) in REGISTRY.items() if sql))
def test_query_matches_sql(spark, name):
    run, sql = REGISTRY[name]
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(SF, f"{t}.parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    got, want = run(spark, SF).toPandas(), con.execute(sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    got, want = rows(got), rows(want)
    assert len(got) == len(want)
    assert all(close(x, y) for a, b in zip(got, want) for x, y in zip(a, b))
