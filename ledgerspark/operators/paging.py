"""Paging (C10).

``paginate`` returns the requested page under a *total* order (the caller's keys plus the
remaining columns as tie-breakers) and a one-row meta frame: ``orderBy().offset().limit()``, by
which each task keeps a heap of offset + perpage rows (TakeOrderedAndProject).

That heap grows with the page number. A caller who walks through a large table uses
``next_page`` instead: the last row of a page is the key of the next one, which is a filter and
a top-k of ``perpage`` rows, at any depth and without staging anything.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PERPAGE_DEFAULT = 50


def validate_pagination(page: int | None = None, perpage: int | None = None,
                        default_perpage: int = PERPAGE_DEFAULT,
                        perpage_max: int | None = None) -> tuple[int, int]:
    """page >= 1 (missing/0 -> 1); perpage >= 1, default 50. A caller who has to bound the page
    size gives ``perpage_max``."""
    p = max(1, page or 1)
    pp = default_perpage if perpage is None else max(1, perpage)
    return p, pp if perpage_max is None else min(perpage_max, pp)


def paginate(df: DataFrame, order_cols: list[str], page: int | None = None,
             perpage: int | None = None, default_perpage: int = PERPAGE_DEFAULT,
             perpage_max: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(page rows, meta) with meta = page, perpage, total, has_next."""
    p, pp = validate_pagination(page, perpage, default_perpage, perpage_max)
    ties = [c for c in df.columns if c not in order_cols]
    rows = df.orderBy(*order_cols, *ties).offset((p - 1) * pp).limit(pp)
    meta = df.agg(F.count(F.lit(1)).alias("total")).select(
        F.lit(p).alias("page"), F.lit(pp).alias("perpage"), "total",
        (F.col("total") > F.lit(p * pp)).alias("has_next"))
    return rows, meta


def next_page(df: DataFrame, order_cols: list[str], after: dict | None = None,
              perpage: int = PERPAGE_DEFAULT) -> DataFrame:
    """The ``perpage`` rows that follow the row ``after`` (a row of ``df`` as a dict, None for
    the first page). ``order_cols`` and the other columns give the total order, NULLs first;
    fully equal rows count as one position, so they must be told apart by a column to be walked
    through singly."""
    order = list(order_cols) + [c for c in df.columns if c not in order_cols]
    if after is not None:
        beyond, same = F.lit(False), F.lit(True)
        for c in order:
            v = F.lit(after[c]).cast(df.schema[c].dataType)
            more = F.col(c).isNotNull() if after[c] is None else F.col(c) > v
            beyond = beyond | (same & F.coalesce(more, F.lit(False)))
            same = same & F.col(c).eqNullSafe(v)
        df = df.where(beyond)
    return df.orderBy(*order).limit(perpage)
