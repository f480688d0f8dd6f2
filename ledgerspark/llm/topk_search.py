"""Exact top-k inner-product search by term-at-a-time accumulation (operator 1).

Vectors are taken as sparse integer rows: component x becomes the weight floor(scale * x) of the
term with its index, and zero weights have no posting. Candidates are cut into blocks of bounded
size. For a block the task builds the postings of every term (positions and weights); each query
scatters its weighted postings, term by term, into a dense score array over the block, a partition
step selects the block's best k, and the winners of all blocks are merged by a per-query top-k.

The query set is a stated set against all rows. Queries are cut into blocks as well, and each
(query block, candidate block) pair meets by equality on the pair of block numbers, so that neither
side is broadcast and a task holds two blocks however large the table is. Work is exhaustive: no
candidate is skipped.

Defined results: vectors that are null, or hold null, NaN or infinite components, take no part,
neither as queries nor as candidates; empty vectors have score 0 with everything, and vectors of
different length are compared over the terms both have; rows with the query's own id are not its
candidates; repeated ids are rows of their own, on both sides; ties go to the smaller id; scores
are 64-bit integers. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from . import common

common.by_value(__name__)

QUERY_BLOCK = 1024
CANDIDATE_BLOCK = 8192


def _finite(v: Column) -> Column:
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & ~bad


def _postings(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(term, row, weight) triples in term order, and the terms' first positions."""
    lists = column.combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.chunk(0)
    sizes = np.diff(lists.offsets.to_numpy())
    values = lists.flatten().to_numpy(zero_copy_only=False)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    starts = np.repeat(np.cumsum(sizes) - sizes, sizes)
    terms = np.arange(len(values)) - starts
    keep = values != 0
    terms, rows, values = terms[keep], rows[keep], values[keep]
    order = np.argsort(terms, kind="stable")
    terms, rows, values = terms[order], rows[order], values[order]
    n = int(terms[-1]) + 1 if len(terms) else 0
    return rows, values, np.searchsorted(terms, np.arange(n + 1)), sizes


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to smaller ids."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= least)
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))][:k]


def _score_blocks(k: int):
    def run(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        out = {"query": [], "query_id": [], "vec_id": [], "score": []}
        ids = candidates.column("vec_id").to_numpy()
        if queries.num_rows and len(ids):
            rows, weights, first, _ = _postings(candidates.column("terms"))
            scores = np.empty(len(ids), np.int64)
            for q, qid, terms in zip(queries.column("query").to_pylist(),
                                     queries.column("query_id").to_pylist(),
                                     queries.column("terms")):
                scores[:] = 0
                for t, w in enumerate(terms.as_py()[:len(first) - 1]):
                    if w:                                   # scatter this term's postings
                        lo, hi = first[t], first[t + 1]
                        scores[rows[lo:hi]] += w * weights[lo:hi]
                own = np.flatnonzero(ids != qid) if (ids == qid).any() else None
                at = _best(scores, ids, k) if own is None else own[_best(scores[own], ids[own], k)]
                out["query"] += [q] * len(at)
                out["query_id"] += [qid] * len(at)
                out["vec_id"] += ids[at].tolist()
                out["score"] += scores[at].tolist()
        return pa.table({c: pa.array(v, pa.int64()) for c, v in out.items()})
    return run


def top_k(vectors: DataFrame, queries: Column, k: int = 10, scale: int = 1024,
          id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score for the rows of ``vectors`` that satisfy
    ``queries`` against all rows."""
    own = vectors.where(F.col(id_column).isNotNull()).select(
        F.col(id_column).cast("long").alias("vec_id"),
        F.col(vector_column).cast("array<double>").alias("_v"),
        F.coalesce(queries, F.lit(False)).alias("_is_query"))
    own = own.where(_finite(F.col("_v"))).select(
        "vec_id", F.transform("_v", lambda x: F.floor(x * scale).cast("long")).alias("terms"),
        "_is_query", F.monotonically_increasing_id().alias("_row"))
    own = common.stored(own, "sparse-rows")
    size = own.agg(F.count("*"), F.count_if("_is_query")).first()
    n_c, n_q = max(1, -(-size[0] // CANDIDATE_BLOCK)), max(1, -(-size[1] // QUERY_BLOCK))

    def blocks(n):
        return F.sequence(F.lit(0), F.lit(n - 1))
    q = own.where("_is_query").select(
        F.col("_row").alias("query"), F.col("vec_id").alias("query_id"), "terms",
        F.pmod(F.xxhash64("_row"), F.lit(n_q)).cast("int").alias("qb"),
        F.explode(blocks(n_c)).alias("cb"))
    c = own.select("vec_id", "terms", F.explode(blocks(n_q)).alias("qb2"),
                   F.pmod(F.xxhash64("_row"), F.lit(n_c)).cast("int").alias("cb2"))
    won = q.groupBy("qb", "cb").cogroup(c.groupBy("qb2", "cb2")).applyInArrow(
        _score_blocks(k), "query long, query_id long, vec_id long, score long")
    order = W.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return won.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
