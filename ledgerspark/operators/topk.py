"""Top-k helpers.

``top_k_per_group`` is ``row_number() <= k`` over a window partitioned by the group. Spark
plans it with a *partial* WindowGroupLimit before the shuffle and a final one after it, so
every map task ships at most k rows per group: a hot group holding a third of the rows is cut
to (#tasks x k) rows before any exchange, and no task ever sorts a whole group.
Every ordering must end in unique columns (the caller's tie-breakers) so the result is
deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k_per_group(df: DataFrame, group_cols: list[str], order: list[Column], k: int,
                    rank_col: str | None = None) -> DataFrame:
    w = Window.partitionBy(*group_cols).orderBy(*order)
    out = df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= k)
    if rank_col:
        return out.withColumnRenamed("__rn", rank_col)
    return out.drop("__rn")


def last_n_periods(df: DataFrame, period_col: str, n: int,
                   group_cols: list[str] | None = None) -> DataFrame:
    """Rows of the latest ``n`` distinct periods (per group when given). ``dense_rank`` keeps
    every row of a period; the input is an aggregate, one row per (group, period)."""
    w = (Window.partitionBy(*group_cols) if group_cols else Window.partitionBy()).orderBy(
        F.col(period_col).desc())
    if not group_cols:
        # a global latest-n over an aggregate: rank the distinct periods (bounded by the
        # calendar) and join back, instead of a single-partition window over all rows
        periods = (df.select(period_col).distinct()
                   .orderBy(F.col(period_col).desc()).limit(n))
        return df.join(periods, period_col, "left_semi")
    return (df.withColumn("__rk", F.dense_rank().over(w)).where(F.col("__rk") <= n)
              .drop("__rk"))
