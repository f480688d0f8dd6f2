"""General-ledger gold views.

Two sign conventions live side by side (see ``functions.accounting``):

* convention A reads the account type off the statement row (``gold_account_summary_v2``,
  ``gold_monthly_pl``, ``gold_balance_sheet``, ``gold_account_detail``);
* convention B (the default) reads it from the chart of accounts (``*_by_year``,
  ``gold_monthly_pl_trend``).

Plan shape of every convention-B view: statements are aggregated per (period, account)
*before* the join with the chart of accounts (eager aggregation). The partial aggregate runs
map-side, so a hot account with a third of all rows collapses to one row per task before any
shuffle, and the join sees (#periods x #accounts) rows instead of the fact table. Because all
measures are sums and counts, re-aggregating after the join gives exactly the join-then-
aggregate result, also when the chart has duplicate account numbers. The views E4, E10-E14 and E16
also take the persisted monthly sums of ``gold_store`` in place of statement lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.accounting import (BS_CLASSES, PL_CLASSES, account_class, balance_a, balance_b,
                                    types_of)
from ..functions.keys import month_key, year_key
from ..sources.sinks import UNKNOWN_BYTES, planned_bytes

DEFAULT_SINCE = "2022-01-01"

#: Bytes of the files behind a task of ``spread`` (some 200,000 statement lines), and the bounds of
#: the number of tasks.
TASK_BYTES, LEAST_TASKS, MOST_TASKS = 4 << 20, 8, 10_000


def is_monthly(statements: DataFrame) -> bool:
    """Whether rows are monthly sums (``gold_store``) in place of statement lines."""
    return "line_count" in statements.columns


def line_count(statements: DataFrame) -> Column:
    """Aggregate: the number of statement lines, also where a row stands for many."""
    return F.sum("line_count") if is_monthly(statements) else F.count(F.lit(1))


def spread(rows: DataFrame, *by: str) -> DataFrame:
    """``rows`` dealt by the columns ``by`` over as many tasks as the files they come from need
    (``TASK_BYTES`` each), so that the hash maps of a task stay as large however large the ledger
    is: Parquet packs millions of lines into one split, and AQE joins shuffle blocks by their
    packed size too. Small inputs, and those of unknown size, stay as they are."""
    size = planned_bytes(rows)
    tasks = min(size // TASK_BYTES, MOST_TASKS)
    return rows if tasks < LEAST_TASKS or size >= UNKNOWN_BYTES else rows.repartition(tasks, *by)


def _since(statements: DataFrame, since: str | None, before: str | None = None) -> DataFrame:
    """Rows from ``since`` on and before ``before``: plain date bounds, which reach the scan."""
    for day in (since, before):
        if day and is_monthly(statements) and not day.endswith("-01"):
            raise ValueError(f"monthly sums begin with a month, not on {day}")
    if before is not None:
        statements = statements.where(F.col("transaction_date") < F.lit(before).cast("date"))
    if since is None:
        return statements
    return statements.where(F.col("transaction_date") >= F.lit(since).cast("date"))


def _date_str(c):
    return F.date_format(c, "yyyy-MM-dd")


# ---------------------------------------------------------------- convention-free summaries

def gold_account_summary_v1(statements: DataFrame) -> DataFrame:
    """Per account: count, debit, credit, MAX(balance) (named latest_balance as in the
    source, though it is the maximum), first/last date. No date cut."""
    return statements.groupBy("account_code", "account_name").agg(
        F.count("id").alias("transaction_count"),
        F.sum("debit").alias("total_debit"),
        F.sum("credit").alias("total_credit"),
        F.max("balance").alias("latest_balance"),
        _date_str(F.min("transaction_date")).alias("first_transaction"),
        _date_str(F.max("transaction_date")).alias("last_transaction"),
    )


def gold_monthly_balances(statements: DataFrame) -> DataFrame:
    """Per account and month: debit, credit, net (credit - debit), MAX(balance)."""
    return statements.groupBy("account_code", "account_name",
                              month_key("transaction_date").alias("month")).agg(
        F.sum("debit").alias("monthly_debit"),
        F.sum("credit").alias("monthly_credit"),
        F.sum(F.col("credit") - F.col("debit")).alias("net_change"),
        F.max("balance").alias("month_end_balance"),
    )


def gold_daily_transactions(statements: DataFrame) -> DataFrame:
    """E5: per day: count, debit, credit, net flow."""
    return statements.groupBy(_date_str(F.col("transaction_date")).alias("transaction_date")).agg(
        F.count(F.lit(1)).alias("transaction_count"),
        F.sum("debit").alias("daily_debit"),
        F.sum("credit").alias("daily_credit"),
        F.sum(F.col("credit") - F.col("debit")).alias("net_flow"),
    )


# ---------------------------------------------------------------- convention A (row types)

def gold_account_summary_v2(statements: DataFrame, since: str | None = DEFAULT_SINCE) -> DataFrame:
    """Per (code, name, type, subtype) since ``since``: count, debit, credit, net
    (credit - debit), first/last date."""
    return _since(statements, since).groupBy(
        "account_code", "account_name", "account_type", "account_subtype").agg(
        F.count("id").alias("transaction_count"),
        F.sum("debit").alias("total_debit"),
        F.sum("credit").alias("total_credit"),
        F.sum(F.col("credit") - F.col("debit")).alias("net_change"),
        _date_str(F.min("transaction_date")).alias("first_transaction"),
        _date_str(F.max("transaction_date")).alias("last_transaction"),
    )


def gold_monthly_pl(statements: DataFrame, since: str | None = DEFAULT_SINCE,
                    before: str | None = None) -> DataFrame:
    """Month x type x subtype: revenue = credit - debit, expenses = debit - credit
    (convention A), row count."""
    s = _since(statements, since, before).withColumn("__cls", account_class("account_type"))
    return s.groupBy(month_key("transaction_date").alias("month"), "account_type",
                     "account_subtype").agg(
        F.sum(F.when(F.col("__cls") == "revenue", F.col("credit") - F.col("debit"))
              .otherwise(F.lit(0))).alias("revenue"),
        F.sum(F.when(F.col("__cls") == "expense", F.col("debit") - F.col("credit"))
              .otherwise(F.lit(0))).alias("expenses"),
        F.count(F.lit(1)).alias("transaction_count"),
    )


def gold_balance_sheet(statements: DataFrame, since: str | None = DEFAULT_SINCE) -> DataFrame:
    """Per account: debit, credit, balance (asset debit-normal, liability/equity
    credit-normal, others 0 — convention A)."""
    s = _since(statements, since).withColumn("__cls", account_class("account_type"))
    return s.groupBy("account_type", "account_subtype", "account_code", "account_name").agg(
        F.sum("debit").alias("total_debit"),
        F.sum("credit").alias("total_credit"),
        F.sum(balance_a("__cls", "debit", "credit")).alias("balance"),
    )


def gold_account_detail(accounts: DataFrame, statements: DataFrame,
                        since: str | None = DEFAULT_SINCE) -> DataFrame:
    """Every account with its E6 activity (NULL -> 0). The summary has four keys, so an
    account whose rows carry several types appears once per type (as in the source)."""
    summ = gold_account_summary_v2(statements, since)
    a = accounts.select("account_id", "account_number", "account_name", "account_type",
                        "account_subtype", "is_active")
    sm = summ.select(F.col("account_code").alias("__code"), "transaction_count",
                     "total_debit", "total_credit", "net_change")
    j = a.join(sm, a["account_number"] == sm["__code"], "left")
    return j.select(
        "account_id", "account_number", "account_name", "account_type", "account_subtype",
        "is_active",
        F.coalesce("transaction_count", F.lit(0).cast("bigint")).alias("transaction_count"),
        F.coalesce("total_debit", F.lit(0)).alias("total_debit"),
        F.coalesce("total_credit", F.lit(0)).alias("total_credit"),
        F.coalesce("net_change", F.lit(0)).alias("net_change"),
    )


# ---------------------------------------------------------------- convention B (dim types)

def facts_with_account(statements: DataFrame, accounts: DataFrame) -> DataFrame:
    """Statement rows with the chart's type/subtype; inner join on account number, so
    statements of unknown accounts are dropped. (Row-level form; the views below use the
    pre-aggregated form instead.)"""
    a = accounts.select(F.col("account_number").alias("__acct"),
                        F.col("account_type").alias("dim_account_type"),
                        F.col("account_subtype").alias("dim_account_subtype"))
    return statements.join(a, statements["account_code"] == a["__acct"], "inner").drop("__acct")


def _dim_types(accounts: DataFrame, classes=None) -> DataFrame:
    a = accounts.select(F.col("account_number").alias("__acct"), "account_type", "account_subtype")
    if classes:
        a = a.where(F.col("account_type").isin(*types_of(*classes)))
    return a


def gold_account_summary_by_year(statements: DataFrame, accounts: DataFrame,
                                 since: str | None = DEFAULT_SINCE,
                                 before: str | None = None) -> DataFrame:
    """Year x account (type from the chart): count, debit, credit, balance (convention B)."""
    pre = _since(statements, since, before).groupBy(
        year_key("transaction_date").alias("year"), "account_code", "account_name").agg(
        line_count(statements).alias("__n"), F.sum("debit").alias("__d"),
        F.sum("credit").alias("__c"))
    j = pre.join(_dim_types(accounts), pre["account_code"] == F.col("__acct"), "inner")
    g = j.groupBy("year", "account_code", "account_name", "account_type", "account_subtype").agg(
        F.sum("__n").alias("transaction_count"),
        F.sum("__d").alias("total_debit"),
        F.sum("__c").alias("total_credit"))
    return g.withColumn("balance", balance_b(account_class("account_type"), "total_debit",
                                             "total_credit"))


def _by_year_subset(statements, accounts, since, classes, before=None) -> DataFrame:
    s = gold_account_summary_by_year(statements, accounts, since, before)
    return s.where(F.col("account_type").isin(*types_of(*classes))).select(
        "year", "account_code", "account_name", "account_type", "account_subtype",
        F.col("balance").alias("amount"))


def gold_income_statement_by_year(statements: DataFrame, accounts: DataFrame,
                                  since: str | None = DEFAULT_SINCE,
                                  before: str | None = None) -> DataFrame:
    """E10 restricted to revenue and expense accounts; balance -> amount."""
    return _by_year_subset(statements, accounts, since, PL_CLASSES, before)


def gold_balance_sheet_by_year(statements: DataFrame, accounts: DataFrame,
                               since: str | None = DEFAULT_SINCE,
                               before: str | None = None) -> DataFrame:
    """E10 restricted to balance-sheet accounts. Per-year movement, not cumulative,
    exactly as the source view (despite its title)."""
    return _by_year_subset(statements, accounts, since, BS_CLASSES, before)


def gold_income_summary_by_year(statements: DataFrame, accounts: DataFrame,
                                since: str | None = DEFAULT_SINCE) -> DataFrame:
    """Year -> total revenue, total expenses, net income (two-level aggregation)."""
    s = gold_account_summary_by_year(statements, accounts, since)
    s = s.where(F.col("account_type").isin(*types_of(*PL_CLASSES))).withColumn(
        "__cls", account_class("account_type"))
    rev = F.sum(F.when(F.col("__cls") == "revenue", F.col("balance")).otherwise(F.lit(0)))
    exp = F.sum(F.when(F.col("__cls") == "expense", F.col("balance")).otherwise(F.lit(0)))
    return s.groupBy("year").agg(rev.alias("total_revenue"), exp.alias("total_expenses"),
                                 (rev - exp).alias("net_income"))


def gold_balance_summary_by_year(statements: DataFrame, accounts: DataFrame,
                                 since: str | None = DEFAULT_SINCE) -> DataFrame:
    """Year -> total assets, liabilities, equity."""
    s = gold_account_summary_by_year(statements, accounts, since)
    s = s.where(F.col("account_type").isin(*types_of(*BS_CLASSES))).withColumn(
        "__cls", account_class("account_type"))

    def part(cls):
        return F.sum(F.when(F.col("__cls") == cls, F.col("balance")).otherwise(F.lit(0)))
    return s.groupBy("year").agg(part("asset").alias("total_assets"),
                                 part("liability").alias("total_liabilities"),
                                 part("equity").alias("total_equity"))


def gold_chart_of_accounts(accounts: DataFrame) -> DataFrame:
    """Active accounts."""
    return accounts.where(F.col("is_active") == 1).select(
        F.col("account_number").alias("account_code"), "account_name", "account_type",
        "account_subtype", "is_active")


def gold_monthly_pl_trend(statements: DataFrame, accounts: DataFrame,
                          since: str | None = DEFAULT_SINCE,
                          before: str | None = None) -> DataFrame:
    """Month x type x subtype: revenue = debit - credit, expenses = credit - debit
    (convention B), revenue and expense accounts only. ``year`` is derived from the grouped
    month (Spark rejects the ungrouped column SQLite accepts)."""
    pre = _since(statements, since, before).groupBy(
        month_key("transaction_date").alias("month"), "account_code").agg(
        F.sum("debit").alias("__d"), F.sum("credit").alias("__c"))
    j = pre.join(_dim_types(accounts, PL_CLASSES), pre["account_code"] == F.col("__acct"), "inner")
    j = j.withColumn("__cls", account_class("account_type"))
    g = j.groupBy("month", "account_type", "account_subtype").agg(
        F.sum(F.when(F.col("__cls") == "revenue", F.col("__d") - F.col("__c"))
              .otherwise(F.lit(0))).alias("revenue"),
        F.sum(F.when(F.col("__cls") == "expense", F.col("__c") - F.col("__d"))
              .otherwise(F.lit(0))).alias("expenses"))
    return g.select("month", F.substring("month", 1, 4).alias("year"), "account_type",
                    "account_subtype", "revenue", "expenses")
