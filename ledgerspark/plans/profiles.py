"""Load summaries and data-quality profiles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import in_years
from ..functions.keys import year_key


def yearly_volume(statements: DataFrame, since: str | None = None) -> DataFrame:
    """Year -> line count, Σ|amount|."""
    s = statements if since is None else statements.where(
        F.col("transaction_date") >= F.lit(since).cast("date"))
    return s.groupBy(year_key("transaction_date").alias("year")).agg(
        F.count(F.lit(1)).alias("transactions"),
        F.sum(F.abs("amount")).alias("total_amount"))


def invoice_status_stats(invoices: DataFrame) -> DataFrame:
    """Status -> count, Σtotal (all invoices, active or not)."""
    return invoices.groupBy("status").agg(F.count(F.lit(1)).alias("count"),
                                          F.sum("total").alias("total_amount"))


def range_volume(statements: DataFrame, date_from: str, date_to: str) -> DataFrame:
    """One row for [from, to]: count, first/last date, Σ|amount|, distinct accounts."""
    s = statements.where(F.col("transaction_date").between(F.lit(date_from).cast("date"),
                                                           F.lit(date_to).cast("date")))
    return s.agg(
        F.count(F.lit(1)).alias("count"),
        F.date_format(F.min("transaction_date"), "yyyy-MM-dd").alias("min_date"),
        F.date_format(F.max("transaction_date"), "yyyy-MM-dd").alias("max_date"),
        F.sum(F.abs("amount")).alias("total_amount"),
        F.countDistinct("account_code").alias("unique_accounts"))


def load_history(load_log: DataFrame) -> DataFrame:
    """Operation type -> number of loads, Σrecords loaded."""
    return load_log.groupBy("operation_type").agg(
        F.count(F.lit(1)).alias("load_count"), F.sum("records_loaded").alias("total_records"))


def date_range(df: DataFrame, date_col: str, by: list[str] | None = None,
               min_year: int | None = None) -> DataFrame:
    """first/last date of a table (blank/NULL ignored), optionally per group and
    restricted to years after ``min_year``."""
    c = F.col(date_col)
    d = df.where(c.isNotNull())
    if min_year is not None:
        d = d.where(in_years(c, min_year + 1))
    agg = [F.date_format(F.min(c), "yyyy-MM-dd").alias("min_date"),
           F.date_format(F.max(c), "yyyy-MM-dd").alias("max_date")]
    return d.groupBy(*by).agg(*agg) if by else d.agg(*agg)


def silver_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) for each given table or view, as one union plan."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)
