import math

import numpy as np

from ledgerspark.llm import topk_search
from pyspark.sql import functions as F


def brute(rows, k, of):
    ok = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, q in ok:
        if of(i):
            s = sorted((-sum(a * b for a, b in zip(q, c)), j) for j, c in ok if j != i)[:k]
            out += [(i, r + 1, j, -x) for r, (x, j) in enumerate(s)]
    return sorted(out)


def result(spark, rows, k=3, mod=5, **limits):
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows],
                               "vec_id long, embedding array<float>, query long, terms int")
    got = topk_search.top_k(df, F.col("vec_id") % mod == 0, k)
    return sorted(tuple(r) for r in got.collect())


def test_equals_brute_force_over_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "QUERY_BLOCK", 7)
    monkeypatch.setattr(topk_search, "CANDIDATE_BLOCK", 13)
    g = np.random.default_rng(1)
    rows = [(i, [float(x) for x in (g.integers(-3, 4, 6) / 4)]) for i in range(90)]
    rows += [(200 + i, rows[3][1]) for i in range(20)]               # ties
    assert result(spark, rows) == brute(rows, 3, lambda i: i % 5 == 0)


def test_void_vectors_take_no_part(spark):
    rows = [(0, [1.0, 2.0]), (5, None), (10, [None, 1.0]), (15, [float("nan"), 1.0]),
            (20, [float("inf"), 1.0]), (None, [1.0, 1.0]), (1, [0.5, 0.0]), (2, [0.0, 0.0])]
    assert result(spark, rows) == brute(rows, 3, lambda i: i % 5 == 0)
    assert {r[0] for r in result(spark, rows)} == {0}


def test_empty_table(spark):
    assert result(spark, []) == []
