"""The persisted gold layer (A11 ``write_gold``): monthly sums of the ledger, kept up to date.

Every by-year view, the monthly trend and all marts need the ledger by month and account only.
``write_gold`` stores these sums once, partitioned by month; ``refresh_gold`` computes the months
anew that a load touched, from the silver rows of these months alone, and replaces their
partitions. So a load costs its months, and a report reads account-months, not statement lines.

A stored row has the columns of a statement line that the views use (``transaction_date`` is the
first day of the month, ``balance`` the largest one) and ``line_count``, the lines it stands for:
E4, E10-E14, E16 (``ledger``) and the marts (``marts.fact_month``) take either. Dates inside a
month are gone, so their ``since`` has to be the first of a month.

Refreshing is idempotent: a month is computed from silver as it is. Rows without a date belong to
the month ``unknown``.
"""

from __future__ import annotations

import calendar
import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import month_key
from ..operators.loading import overwrite_partitions, table_exists
from .ledger import spread

UNKNOWN = "unknown"
SCHEMA = ("account_code string, account_name string, transaction_date date, debit decimal(28,2), "
          "credit decimal(28,2), balance decimal(18,2), line_count long, month string")


def _month() -> Column:
    return F.coalesce(month_key("transaction_date"), F.lit(UNKNOWN))


def monthly_sums(statements: DataFrame) -> DataFrame:
    """Statement lines per (month, account): map-side sums, so a hot account is one row a task
    and month before any shuffle. Lines of large ledgers are dealt over tasks by size first."""
    lines = statements.select("account_code", "account_name", "transaction_date", "debit", "credit",
                              "balance")
    return spread(lines, *lines.columns).groupBy(_month().alias("month"), "account_code", "account_name").agg(
        F.trunc(F.min("transaction_date"), "month").alias("transaction_date"),
        F.sum("debit").cast("decimal(28,2)").alias("debit"),
        F.sum("credit").cast("decimal(28,2)").alias("credit"),
        F.max("balance").cast("decimal(18,2)").alias("balance"),
        F.count(F.lit(1)).alias("line_count")).select(*[f.split()[0] for f in SCHEMA.split(", ")])


def touched_months(rows: DataFrame) -> list[str]:
    """The months of loaded rows: bounded by the calendar."""
    return sorted(r[0] for r in rows.select(_month().alias("m")).distinct().collect())


def in_months(statements: DataFrame, months: list[str]) -> DataFrame:
    """The rows of these months: by the month folders where the table has them, by date bounds
    (one pair a run of consecutive months), which Parquet statistics check, everywhere."""
    if "month" in statements.columns:
        statements = statements.where(F.col("month").isin(months))
    runs: list[list[dt.date]] = []
    for first in sorted(dt.date.fromisoformat(f"{m}-01") for m in months if m != UNKNOWN):
        end = first.replace(day=calendar.monthrange(first.year, first.month)[1])
        if runs and runs[-1][1] + dt.timedelta(days=1) == first:
            runs[-1][1] = end
        else:
            runs.append([first, end])
    wanted = F.col("transaction_date").isNull() if UNKNOWN in months else F.lit(False)
    for low, high in runs:
        wanted = F.col("transaction_date").between(F.lit(low), F.lit(high)) | wanted
    return statements.where(wanted)


def write_gold(statements: DataFrame, path: str) -> None:
    """The monthly sums of the whole ledger."""
    spark = statements.sparkSession
    if table_exists(spark, path):
        raise ValueError(f"{path} exists; refresh_gold keeps it up to date")
    # few files a month; a large one is split over tasks
    monthly_sums(statements).hint("rebalance", "month").write.partitionBy("month").parquet(path)


def refresh_gold(statements: DataFrame, path: str, months: list[str]) -> None:
    """Compute these months anew and replace them; a month without rows is taken out."""
    if months:
        sums = monthly_sums(in_months(statements, months))
        overwrite_partitions(statements.sparkSession, sums, path, "month", months)


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)
