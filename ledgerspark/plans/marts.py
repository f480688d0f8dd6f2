"""Documented monthly marts (E61-E65). Only names and columns are documented; the formulas
here are ours and stated in each docstring.

``fact_txn`` is statement lines with their account's reporting group (D10) and
``report_amount = sign x (debit - credit)`` (debit-normal amounts flipped by the group sign,
so revenue and expenses both read positive with the usual signs: revenue -1, expenses +1).

The marts read ``fact_month`` instead: the same facts pre-aggregated per (month, account)
*before* the join with the account master (eager aggregation: partial aggregation runs
map-side, so a hot account never skews the join, which sees one row per account-month).
All mart measures are sums and counts, so the result equals aggregating fact_txn. The only
window (closing balance-sheet positions) runs over monthly aggregates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.accounting import account_class
from ..functions.keys import month_key
from ..operators.matching import account_groups_join
from .ledger import is_monthly, line_count, spread

# --- fixed values: report groups that feed the KPI lines -------------------------------------
KPI_GROUPS = {
    "revenue": ("Revenue",),
    "cogs": ("COGS",),
    "opex": ("OPEX", "Operating expenses"),
    "depreciation": ("Depreciation",),
    "finance": ("Finance",),
    "tax": ("Tax",),
}
# -----------------------------------------------------------------------------------------------


def dim_account(accounts: DataFrame, groups: DataFrame) -> DataFrame:
    """Account master with reporting classification."""
    return account_groups_join(accounts, groups)


def fact_txn(statements: DataFrame, accounts: DataFrame, groups: DataFrame) -> DataFrame:
    """Statement lines x account (type/subtype from the chart) x reporting group.
    Lines of unknown accounts are dropped (inner join), as in the by-year views."""
    a = dim_account(accounts, groups).select(
        F.col("account_number").alias("__acct"), F.col("account_type").alias("acct_type"),
        F.col("account_subtype").alias("acct_subtype"), "report_group", "report_subgroup",
        "statement", "sign", "is_active")
    j = statements.join(a, statements["account_code"] == F.col("__acct"), "inner").drop("__acct")
    return (j.withColumn("month", month_key("transaction_date"))
             .withColumn("report_amount",
                         F.coalesce(F.col("sign"), F.lit(1)) * (F.col("debit") - F.col("credit"))))


def fact_month(statements: DataFrame, accounts: DataFrame, groups: DataFrame,
               names: bool = True) -> DataFrame:
    """fact_txn pre-aggregated per (month, account): transaction_count, debit, credit,
    report_amount. ``statements`` may be the monthly sums of ``gold_store``. Marts that do not show account names leave them out of the key
    (``names=False``), which makes far fewer groups.

    Where nearly every line is a group of its own, the sums are as many as the lines: lines are
    dealt over tasks by size before the map-side sums (by their whole content, so that a hot account
    is spread), and sums by their account before the join."""
    lines = statements.select("transaction_date", "account_code", *["account_name"] * names,
                              "debit", "credit", *["line_count"] * is_monthly(statements))
    pre = spread(lines, *lines.columns).groupBy(month_key("transaction_date").alias("month"), "account_code",
                             *["account_name"] * names).agg(
        line_count(statements).alias("transaction_count"),
        F.sum("debit").alias("debit"), F.sum("credit").alias("credit"))
    pre = spread(pre, "account_code")
    a = dim_account(accounts, groups).select(
        F.col("account_number").alias("__acct"), F.col("account_type").alias("acct_type"),
        F.col("account_subtype").alias("acct_subtype"), "report_group", "report_subgroup",
        "statement", "sign", "is_active")
    j = pre.join(a, pre["account_code"] == F.col("__acct"), "inner").drop("__acct")
    return j.withColumn("report_amount",
                        F.coalesce(F.col("sign"), F.lit(1)) * (F.col("debit") - F.col("credit")))


def v_account_detail(fact: DataFrame) -> DataFrame:
    """E65 (over ``fact_month``): per account: group, counts, Σdebit, Σcredit, P&L total and BS total."""
    return fact.groupBy("account_code", "account_name", "acct_type", "acct_subtype",
                        "report_group", "statement", "is_active").agg(
        F.sum("transaction_count").alias("transaction_count"),
        F.sum("debit").alias("total_debit"), F.sum("credit").alias("total_credit"),
        F.sum(F.when(F.col("statement") == "PL", F.col("report_amount")).otherwise(F.lit(0)))
        .alias("pl_total"),
        F.sum(F.when(F.col("statement") == "BS", F.col("report_amount")).otherwise(F.lit(0)))
        .alias("bs_total"))


def v_pl_month(fact: DataFrame) -> DataFrame:
    """Month x report group x subgroup -> Σreport_amount of P&L lines."""
    return (fact.where(F.col("statement") == "PL")
            .groupBy("month", "report_group", "report_subgroup")
            .agg(F.sum("report_amount").alias("amount"),
                 F.sum("transaction_count").alias("transaction_count")))


def v_bs_month(fact: DataFrame) -> DataFrame:
    """Month x report group -> movement of balance-sheet lines and the closing position
    (running sum of the monthly movements; the window runs over monthly aggregates)."""
    m = (fact.where(F.col("statement") == "BS").groupBy("month", "report_group")
         .agg(F.sum("report_amount").alias("movement")))
    w = Window.partitionBy("report_group").orderBy("month").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return m.withColumn("position", F.sum("movement").over(w))


def v_trial_balance_month(fact: DataFrame) -> DataFrame:
    """Month x account -> Σdebit, Σcredit, net (debit - credit)."""
    return fact.groupBy("month", "account_code", "account_name", "acct_type").agg(
        F.sum("debit").alias("total_debit"), F.sum("credit").alias("total_credit"),
        F.sum(F.col("debit") - F.col("credit")).alias("net"))


def v_kpi_month(fact: DataFrame, kpi_groups: dict | None = None) -> DataFrame:
    """Month -> revenue, gross_profit (revenue - COGS), ebitda (- OPEX), ebit
    (- depreciation), net_income (- finance - tax), gross and EBITDA margins in percent
    (NULL when revenue is 0)."""
    g = kpi_groups or KPI_GROUPS

    def part(key):
        return F.sum(F.when(F.col("report_group").isin(*g[key]), F.col("report_amount"))
                     .otherwise(F.lit(0)))
    m = fact.where(F.col("statement") == "PL").groupBy("month").agg(
        *[part(k).alias(k) for k in ("revenue", "cogs", "opex", "depreciation", "finance", "tax")])
    gp = F.col("revenue") - F.col("cogs")
    ebitda = gp - F.col("opex")
    ebit = ebitda - F.col("depreciation")
    rev = F.col("revenue")
    return m.select(
        "month", "revenue", gp.alias("gross_profit"), ebitda.alias("ebitda"), ebit.alias("ebit"),
        (ebit - F.col("finance") - F.col("tax")).alias("net_income"),
        F.when(rev != 0, gp.cast("double") / rev.cast("double") * 100.0).alias("gross_margin_pct"),
        F.when(rev != 0, ebitda.cast("double") / rev.cast("double") * 100.0)
        .alias("ebitda_margin_pct"))


def v_monthly_summary(fact: DataFrame) -> DataFrame:
    """Month -> total revenue, total expenses, total assets, total liabilities (each
    the Σreport_amount of the account class), active accounts, transactions.

    Two plain aggregations instead of a DISTINCT aggregate: first per (month, account), then
    per month, where ``active_accounts`` is the row count (no Expand of the input rows)."""
    cls = account_class("acct_type")

    def part(c):
        return F.sum(F.when(cls == c, F.col("report_amount")).otherwise(F.lit(0)))
    per_acct = fact.groupBy("month", "account_code").agg(
        part("revenue").alias("r"), part("expense").alias("e"), part("asset").alias("a"),
        part("liability").alias("l"), F.sum("transaction_count").alias("n"))
    return per_acct.groupBy("month").agg(
        F.sum("r").alias("total_revenue"), F.sum("e").alias("total_expenses"),
        F.sum("a").alias("total_assets"), F.sum("l").alias("total_liabilities"),
        F.count(F.lit(1)).alias("active_accounts"),
        F.sum("n").alias("total_transactions"))
