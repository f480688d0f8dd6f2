"""Documented analytical queries (E21-E35), each a parameterised DataFrame function.

Row-level filters are plain comparisons on typed columns, so Catalyst pushes them into the
Parquet scan; every top-n has a unique tie-breaker so results do not depend on task order
(top-n plans compile to TakeOrderedAndProject: a bounded heap per task, no full sort).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.accounting import PL_CLASSES, types_of
from ..functions.dates import in_years
from ..functions.keys import month_key, quarter_key
from ..functions.money import money_avg
from .ledger import (gold_balance_sheet_by_year, gold_income_statement_by_year, gold_monthly_pl,
                     gold_monthly_pl_trend)


def _after(month: str) -> str:
    """The first day after a month."""
    return (dt.date.fromisoformat(f"{month}-28") + dt.timedelta(days=4)).replace(day=1).isoformat()


def _year(year: str) -> tuple[str, str]:
    """First day of a year and of the next one."""
    return f"{year}-01-01", f"{int(year) + 1}-01-01"


def _between(df: DataFrame, col: str, lo: str | None, hi: str | None,
             hi_inclusive: bool = True) -> DataFrame:
    c = F.col(col)
    if lo is not None:
        df = df.where(c >= F.lit(lo).cast("date"))
    if hi is not None:
        hi_c = F.lit(hi).cast("date")
        df = df.where(c <= hi_c if hi_inclusive else c < hi_c)
    return df


def monthly_net_revenue(statements: DataFrame, account_type: str, date_from: str,
                        date_to: str) -> DataFrame:
    """Month -> Σ(credit - debit) for one account type, date_from <= d < date_to."""
    s = _between(statements.where(F.col("account_type") == account_type),
                 "transaction_date", date_from, date_to, hi_inclusive=False)
    return s.groupBy(month_key("transaction_date").alias("month")).agg(
        F.sum(F.col("credit") - F.col("debit")).alias("net_revenue"))


def account_transactions(statements: DataFrame, account_code: str, date_from: str,
                         date_to: str, n: int) -> DataFrame:
    """One account's lines in [from, to], newest first, top n (ties by id)."""
    s = _between(statements.where(F.col("account_code") == account_code),
                 "transaction_date", date_from, date_to)
    return (s.select("id", "transaction_date", "description", "amount", "balance")
             .orderBy(F.col("transaction_date").desc(), F.col("id").asc()).limit(n))


def top_expenses(statements: DataFrame, account_type: str, year: str, n: int) -> DataFrame:
    """Account name -> Σdebit for one type and year, largest n (ties by name)."""
    s = statements.where((F.col("account_type") == account_type)
                         & in_years("transaction_date", year, year))
    return (s.groupBy("account_name").agg(F.sum("debit").alias("total"))
             .orderBy(F.col("total").desc(), F.col("account_name").asc()).limit(n))


def quarterly_revenue(statements: DataFrame, account_type: str, since: str) -> DataFrame:
    """``YYYY-Qn`` -> Σ(credit - debit) (the intent of the documented ``%q``)."""
    s = _between(statements.where(F.col("account_type") == account_type),
                 "transaction_date", since, None)
    return s.groupBy(quarter_key("transaction_date").alias("quarter")).agg(
        F.sum(F.col("credit") - F.col("debit")).alias("revenue"))


def monthly_revenue_trend(monthly_pl: DataFrame, since_month: str) -> DataFrame:
    """Over ``gold_monthly_pl``: month >= since_month -> Σrevenue."""
    return (monthly_pl.where(F.col("month") >= since_month).groupBy("month")
            .agg(F.sum("revenue").alias("total_revenue")))


def monthly_revenue_trend_of(statements: DataFrame, since_month: str) -> DataFrame:
    """E25 over the lines themselves: the month becomes a date bound of the scan."""
    return monthly_revenue_trend(gold_monthly_pl(statements, f"{since_month}-01"), since_month)


def largest_expenses_by_month(statements: DataFrame, account_type: str, since: str,
                              min_expense) -> DataFrame:
    """Month x account name -> Σdebit, kept when above ``min_expense`` (HAVING)."""
    s = _between(statements.where(F.col("account_type") == account_type),
                 "transaction_date", since, None)
    g = s.groupBy(month_key("transaction_date").alias("month"), "account_name").agg(
        F.sum("debit").alias("expense"))
    return g.where(F.col("expense") > F.lit(min_expense))


def expense_categories(monthly_pl: DataFrame, from_month: str, to_month: str) -> DataFrame:
    """Over ``gold_monthly_pl``: subtype -> Σexpenses for months in range."""
    m = monthly_pl.where(F.col("month").between(from_month, to_month))
    return m.groupBy("account_subtype").agg(F.sum("expenses").alias("total"))


def expense_categories_of(statements: DataFrame, from_month: str, to_month: str) -> DataFrame:
    """E27 over the lines themselves, months as date bounds of the scan."""
    return expense_categories(gold_monthly_pl(statements, f"{from_month}-01", _after(to_month)),
                              from_month, to_month)


def account_activity(account_summary: DataFrame, min_count: int) -> DataFrame:
    """Accounts with more than ``min_count`` lines (order: |net| desc)."""
    return account_summary.where(F.col("transaction_count") > min_count).select(
        "account_name", "transaction_count", "total_debit", "total_credit", "net_change")


def account_activity_top(account_summary: DataFrame, n: int = 20) -> DataFrame:
    """E28 (top form): the n accounts with the largest |net change| (ties by key)."""
    return account_summary.orderBy(F.abs("net_change").desc(), F.col("account_code").asc(),
                                   F.col("account_type").asc(),
                                   F.col("account_subtype").asc()).limit(n)


def balance_over_time(statements: DataFrame, account_code: str, since: str) -> DataFrame:
    """One account's (date, balance) series since ``since``."""
    s = _between(statements.where(F.col("account_code") == account_code),
                 "transaction_date", since, None)
    return s.select("transaction_date", "balance")


def daily_cash_flow(statements: DataFrame, account_code: str, date_from: str,
                    date_to: str) -> DataFrame:
    """One account: date -> Σ(credit - debit)."""
    s = _between(statements.where(F.col("account_code") == account_code),
                 "transaction_date", date_from, date_to)
    return s.groupBy("transaction_date").agg(
        F.sum(F.col("credit") - F.col("debit")).alias("daily_net"))


def monthly_cash_position(statements: DataFrame, account_code: str) -> DataFrame:
    """One account: month -> average / max / min balance."""
    s = statements.where(F.col("account_code") == account_code)
    return s.groupBy(month_key("transaction_date").alias("month")).agg(
        money_avg("balance").alias("avg_balance"), F.max("balance").alias("max_balance"),
        F.min("balance").alias("min_balance"))


def monthly_pl_overview(monthly_pl: DataFrame) -> DataFrame:
    """Month -> revenue, expenses, net over ``gold_monthly_pl``."""
    return monthly_pl.groupBy("month").agg(
        F.sum("revenue").alias("revenue"), F.sum("expenses").alias("expenses"),
        F.sum(F.col("revenue") - F.col("expenses")).alias("net"))


def monthly_trend_overview(pl_trend: DataFrame, year: str) -> DataFrame:
    """E32 (trend form): month -> revenue, expenses over ``gold_monthly_pl_trend`` for a year."""
    return pl_trend.where(F.col("year") == year).groupBy("month").agg(
        F.sum("revenue").alias("total_revenue"), F.sum("expenses").alias("total_expenses"))


def monthly_trend_overview_of(statements: DataFrame, accounts: DataFrame, year: str) -> DataFrame:
    """E32 (trend form) over the lines themselves, the year as date bounds of the scan."""
    return monthly_trend_overview(gold_monthly_pl_trend(statements, accounts, *_year(year)), year)


def balance_by_type(balance_sheet: DataFrame) -> DataFrame:
    """Account type -> Σbalance over ``gold_balance_sheet``."""
    return balance_sheet.groupBy("account_type").agg(F.sum("balance").alias("total_balance"))


def annual_report_detail(statement_by_year: DataFrame, account_type: str, year: str,
                         n: int | None = None) -> DataFrame:
    """One type and year of ``gold_income_statement_by_year`` (or the balance-sheet
    twin) by amount desc; top n when given (ties by account code)."""
    s = (statement_by_year.where((F.col("account_type") == account_type)
                                 & (F.col("year") == year))
         .select("year", "account_code", "account_name", "amount"))
    if n is None:
        return s
    return s.orderBy(F.col("amount").desc(), F.col("account_code").asc()).limit(n)


def annual_report_detail_of(statements: DataFrame, accounts: DataFrame, account_type: str,
                            year: str, n: int | None = None) -> DataFrame:
    """E34 over the lines themselves, the year as date bounds of the scan; in order of the amount,
    also without ``n``."""
    view = (gold_income_statement_by_year if account_type in types_of(*PL_CLASSES)
            else gold_balance_sheet_by_year)
    return annual_report_detail(view(statements, accounts, *_year(year)), account_type, year, n).orderBy(
        F.col("amount").desc(), F.col("account_code").asc())


def distinct_account_types(accounts: DataFrame) -> DataFrame:
    """The distinct account types of the chart."""
    return accounts.select("account_type").distinct()
