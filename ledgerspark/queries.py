"""Registered queries: every operator run over the provided tables through the stand-ins.

Each entry pairs the Spark plan (``fn(spark, sf_dir) -> DataFrame``) with its DuckDB oracle
SQL (``None`` where no SQL equivalent exists; a brute-force test covers those). All queries
read the whole tables; parameters are ordinary report parameters, never row caps.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import standins as S
from .oracle_sql import D, _avg_money, with_standins
from .plans import bank, invoice, ledger

# Report parameters used by the registered queries. SINCE precedes all stand-in data, so the
# date-cut views cover the whole tables; AS_OF splits SENT invoices into overdue and due.
SINCE = "1995-01-01"
AS_OF = "1998-08-01"

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        REGISTRY[name] = (fn, with_standins(sql) if sql else None)
        return fn
    return deco


def present(df: DataFrame) -> DataFrame:
    """Presentation types for comparison: money DECIMAL -> DOUBLE, DATE -> ISO text,
    timestamps -> ``yyyy-MM-dd HH:mm:ss`` text."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _stm(spark, d, typed=False):
    return S.silver_account_statements(spark, d, typed=typed)


def _acc(spark, d):
    return S.dim_accounts(spark, d)


# ------------------------------------------------------------------ E-I gold views: bank

@register("gold_bank_monthly", f"""
SELECT branch, ledger, account_no, strftime(booking_date, '%Y-%m') AS month,
       {D("SUM(CASE WHEN amount > 0 THEN amount ELSE 0 END)")} AS inflow,
       {D("SUM(CASE WHEN amount < 0 THEN -amount ELSE 0 END)")} AS outflow,
       {D("SUM(amount)")} AS net, COUNT(*) AS tx_count
FROM silver_bank_transactions GROUP BY 1, 2, 3, 4""")
def q_gold_bank_monthly(spark, d):
    return bank.gold_bank_monthly(S.silver_bank_transactions(spark, d))


@register("gold_card_monthly", f"""
SELECT card_id, strftime(date, '%Y-%m') AS month,
       {D("SUM(CASE WHEN amount > 0 THEN amount ELSE 0 END)")} AS deposits,
       {D("SUM(CASE WHEN amount < 0 THEN -amount ELSE 0 END)")} AS withdrawals,
       {D("SUM(amount)")} AS net, COUNT(*) AS tx_count
FROM silver_card_transactions GROUP BY 1, 2""")
def q_gold_card_monthly(spark, d):
    return bank.gold_card_monthly(S.silver_card_transactions(spark, d))


# ------------------------------------------------------------------ E-I gold views: ledger

@register("gold_account_summary_v1", f"""
SELECT account_code, account_name, COUNT(id) AS transaction_count,
       {D("SUM(debit)")} AS total_debit, {D("SUM(credit)")} AS total_credit,
       {D("MAX(balance)")} AS latest_balance,
       CAST(MIN(transaction_date) AS VARCHAR) AS first_transaction,
       CAST(MAX(transaction_date) AS VARCHAR) AS last_transaction
FROM silver_account_statements GROUP BY account_code, account_name""")
def q_gold_account_summary_v1(spark, d):
    return ledger.gold_account_summary_v1(_stm(spark, d))


@register("gold_monthly_balances", f"""
SELECT account_code, account_name, strftime(transaction_date, '%Y-%m') AS month,
       {D("SUM(debit)")} AS monthly_debit, {D("SUM(credit)")} AS monthly_credit,
       {D("SUM(credit - debit)")} AS net_change, {D("MAX(balance)")} AS month_end_balance
FROM silver_account_statements GROUP BY 1, 2, 3""")
def q_gold_monthly_balances(spark, d):
    return ledger.gold_monthly_balances(_stm(spark, d))


@register("gold_daily_transactions", f"""
SELECT CAST(transaction_date AS VARCHAR) AS transaction_date, COUNT(*) AS transaction_count,
       {D("SUM(debit)")} AS daily_debit, {D("SUM(credit)")} AS daily_credit,
       {D("SUM(credit - debit)")} AS net_flow
FROM silver_account_statements GROUP BY transaction_date""")
def q_gold_daily_transactions(spark, d):
    return ledger.gold_daily_transactions(_stm(spark, d))


@register("gold_account_summary_v2", f"""
SELECT account_code, account_name, account_type, account_subtype,
       COUNT(id) AS transaction_count, {D("SUM(debit)")} AS total_debit,
       {D("SUM(credit)")} AS total_credit, {D("SUM(credit - debit)")} AS net_change,
       CAST(MIN(transaction_date) AS VARCHAR) AS first_transaction,
       CAST(MAX(transaction_date) AS VARCHAR) AS last_transaction
FROM silver_account_statements_typed WHERE transaction_date >= DATE '{SINCE}'
GROUP BY 1, 2, 3, 4""")
def q_gold_account_summary_v2(spark, d):
    return ledger.gold_account_summary_v2(_stm(spark, d, typed=True), SINCE)


@register("gold_monthly_pl", f"""
SELECT strftime(transaction_date, '%Y-%m') AS month, account_type, account_subtype,
       {D("SUM(CASE WHEN account_type = 'Tekjur' THEN credit - debit ELSE 0 END)")} AS revenue,
       {D("SUM(CASE WHEN account_type = 'Gjöld' THEN debit - credit ELSE 0 END)")} AS expenses,
       COUNT(*) AS transaction_count
FROM silver_account_statements_typed WHERE transaction_date >= DATE '{SINCE}'
GROUP BY 1, 2, 3""")
def q_gold_monthly_pl(spark, d):
    return ledger.gold_monthly_pl(_stm(spark, d, typed=True), SINCE)


@register("gold_balance_sheet", f"""
SELECT account_type, account_subtype, account_code, account_name,
       {D("SUM(debit)")} AS total_debit, {D("SUM(credit)")} AS total_credit,
       {D('''SUM(CASE WHEN account_type IN ('Eignir') THEN debit - credit
                      WHEN account_type IN ('Skuldir', 'Eigið fé') THEN credit - debit
                      ELSE 0 END)''')} AS balance
FROM silver_account_statements_typed WHERE transaction_date >= DATE '{SINCE}'
GROUP BY 1, 2, 3, 4""")
def q_gold_balance_sheet(spark, d):
    return ledger.gold_balance_sheet(_stm(spark, d, typed=True), SINCE)


@register("gold_account_detail", f"""
WITH s AS (
  SELECT account_code, account_name, account_type, account_subtype,
         COUNT(id) AS transaction_count, SUM(debit) AS total_debit,
         SUM(credit) AS total_credit, SUM(credit - debit) AS net_change
  FROM silver_account_statements_typed WHERE transaction_date >= DATE '{SINCE}'
  GROUP BY 1, 2, 3, 4)
SELECT a.account_id, a.account_number, a.account_name, a.account_type, a.account_subtype,
       a.is_active, COALESCE(s.transaction_count, 0) AS transaction_count,
       {D("COALESCE(s.total_debit, 0)")} AS total_debit,
       {D("COALESCE(s.total_credit, 0)")} AS total_credit,
       {D("COALESCE(s.net_change, 0)")} AS net_change
FROM dim_accounts a LEFT JOIN s ON a.account_number = s.account_code""")
def q_gold_account_detail(spark, d):
    return ledger.gold_account_detail(_acc(spark, d), _stm(spark, d, typed=True), SINCE)


# Balances by year: revenue and assets count debit - credit, every other class credit - debit.
_BY_YEAR = f"""
SELECT CAST(year(line.transaction_date) AS VARCHAR) AS year, line.account_code, line.account_name,
       acc.account_type, acc.account_subtype, COUNT(*) AS transaction_count,
       SUM(line.debit) AS total_debit, SUM(line.credit) AS total_credit,
       SUM(COALESCE(class.factor, -1) * (line.debit - line.credit)) AS balance
FROM silver_account_statements line
JOIN dim_accounts acc ON acc.account_number = line.account_code
LEFT JOIN (VALUES ('Tekjur', 1), ('Eignir', 1)) class(name, factor) ON class.name = acc.account_type
WHERE line.transaction_date >= DATE '{SINCE}' GROUP BY ALL"""


@register("gold_account_summary_by_year", f"""
SELECT year, account_code, account_name, account_type, account_subtype, transaction_count,
       {D("total_debit")} AS total_debit, {D("total_credit")} AS total_credit,
       {D("balance")} AS balance
FROM ({_BY_YEAR}) v""")
def q_gold_account_summary_by_year(spark, d):
    return ledger.gold_account_summary_by_year(_stm(spark, d), _acc(spark, d), SINCE)


@register("gold_income_statement_by_year", f"""
SELECT year, account_code, account_name, account_type, account_subtype, {D("balance")} AS amount
FROM ({_BY_YEAR}) v WHERE account_type IN ('Tekjur', 'Gjöld')""")
def q_gold_income_statement_by_year(spark, d):
    return ledger.gold_income_statement_by_year(_stm(spark, d), _acc(spark, d), SINCE)


@register("gold_balance_sheet_by_year", f"""
SELECT year, account_code, account_name, account_type, account_subtype, {D("balance")} AS amount
FROM ({_BY_YEAR}) v WHERE account_type IN ('Eignir', 'Skuldir', 'Eigið fé')""")
def q_gold_balance_sheet_by_year(spark, d):
    return ledger.gold_balance_sheet_by_year(_stm(spark, d), _acc(spark, d), SINCE)


@register("gold_income_summary_by_year", f"""
SELECT year,
       {D("SUM(CASE WHEN account_type = 'Tekjur' THEN balance ELSE 0 END)")} AS total_revenue,
       {D("SUM(CASE WHEN account_type = 'Gjöld' THEN balance ELSE 0 END)")} AS total_expenses,
       {D('''SUM(CASE WHEN account_type = 'Tekjur' THEN balance ELSE 0 END) -
             SUM(CASE WHEN account_type = 'Gjöld' THEN balance ELSE 0 END)''')} AS net_income
FROM ({_BY_YEAR}) v WHERE account_type IN ('Tekjur', 'Gjöld') GROUP BY year""")
def q_gold_income_summary_by_year(spark, d):
    return ledger.gold_income_summary_by_year(_stm(spark, d), _acc(spark, d), SINCE)


@register("gold_balance_summary_by_year", f"""
SELECT year,
       {D("SUM(CASE WHEN account_type = 'Eignir' THEN balance ELSE 0 END)")} AS total_assets,
       {D("SUM(CASE WHEN account_type = 'Skuldir' THEN balance ELSE 0 END)")} AS total_liabilities,
       {D("SUM(CASE WHEN account_type = 'Eigið fé' THEN balance ELSE 0 END)")} AS total_equity
FROM ({_BY_YEAR}) v WHERE account_type IN ('Eignir', 'Skuldir', 'Eigið fé') GROUP BY year""")
def q_gold_balance_summary_by_year(spark, d):
    return ledger.gold_balance_summary_by_year(_stm(spark, d), _acc(spark, d), SINCE)


@register("gold_chart_of_accounts", """
SELECT account_number AS account_code, account_name, account_type, account_subtype, is_active
FROM dim_accounts WHERE is_active = 1""")
def q_gold_chart_of_accounts(spark, d):
    return ledger.gold_chart_of_accounts(_acc(spark, d))


@register("gold_monthly_pl_trend", f"""
SELECT strftime(s.transaction_date, '%Y-%m') AS month,
       strftime(s.transaction_date, '%Y') AS year, a.account_type, a.account_subtype,
       {D("SUM(CASE WHEN a.account_type = 'Tekjur' THEN s.debit - s.credit ELSE 0 END)")} AS revenue,
       {D("SUM(CASE WHEN a.account_type = 'Gjöld' THEN s.credit - s.debit ELSE 0 END)")} AS expenses
FROM silver_account_statements s JOIN dim_accounts a ON s.account_code = a.account_number
WHERE s.transaction_date >= DATE '{SINCE}' AND a.account_type IN ('Tekjur', 'Gjöld')
GROUP BY 1, 2, 3, 4""")
def q_gold_monthly_pl_trend(spark, d):
    return ledger.gold_monthly_pl_trend(_stm(spark, d), _acc(spark, d), SINCE)


# ------------------------------------------------------------------ E-I gold views: invoices

@register("gold_invoice_summary", f"""
SELECT invoice_id, invoice_number, customer_id, status, currency, {D("subtotal")} AS subtotal,
       {D("vat_amount")} AS vat_amount, {D("total")} AS total,
       CAST(invoice_date AS VARCHAR) AS invoice_date, CAST(due_date AS VARCHAR) AS due_date,
       CAST(final_due_date AS VARCHAR) AS final_due_date, paid_date, payment_type,
       description, reference,
       CASE WHEN status = 'PAID' THEN 'Paid' WHEN status = 'SENT' THEN 'Unpaid'
            WHEN status = 'DRAFT' THEN 'Draft' WHEN status = 'CANCELLED' THEN 'Cancelled'
            WHEN status = 'CREDIT' THEN 'Credit Note' ELSE status END AS status_display,
       CASE WHEN status = 'SENT' AND due_date < DATE '{AS_OF}' THEN 'Overdue'
            WHEN status = 'SENT' AND due_date >= DATE '{AS_OF}' THEN 'Due' END AS payment_status,
       '{AS_OF}' AS created_at
FROM dim_invoices WHERE is_active = 1""")
def q_gold_invoice_summary(spark, d):
    return invoice.gold_invoice_summary(S.dim_invoices(spark, d), AS_OF)


@register("gold_invoice_lines", f"""
SELECT l.id AS line_id, l.invoice_id, i.invoice_number, i.customer_id, i.status AS invoice_status,
       CAST(i.invoice_date AS VARCHAR) AS invoice_date, {D("i.total")} AS invoice_total,
       l.line_number, l.description AS line_description, {D("l.quantity")} AS quantity,
       {D("l.unit_price")} AS unit_price, {D("l.discount_percent")} AS discount_percent,
       {D("l.vat_percent")} AS vat_percent, {D("l.vat_amount")} AS line_vat_amount,
       {D("l.line_total")} AS line_total, l.account_id, l.account_code, '{AS_OF}' AS created_at
FROM dim_invoice_lines l JOIN dim_invoices i ON l.invoice_id = i.invoice_id
WHERE i.is_active = 1""")
def q_gold_invoice_lines(spark, d):
    return invoice.gold_invoice_lines(S.dim_invoice_lines(spark, d), S.dim_invoices(spark, d), AS_OF)


@register("gold_invoice_monthly", f"""
SELECT strftime(invoice_date, '%Y-%m') AS month, strftime(invoice_date, '%Y') AS year,
       COUNT(*) AS invoice_count,
       COUNT(*) FILTER (WHERE status = 'PAID') AS paid_count,
       COUNT(*) FILTER (WHERE status = 'SENT') AS unpaid_count,
       COUNT(*) FILTER (WHERE status = 'CANCELLED') AS cancelled_count,
       {D("SUM(total)")} AS total_amount,
       {D("COALESCE(SUM(total) FILTER (WHERE status = 'PAID'), 0)")} AS paid_amount,
       {D("COALESCE(SUM(total) FILTER (WHERE status = 'SENT'), 0)")} AS unpaid_amount,
       {_avg_money("total")} AS avg_invoice_amount, currency
FROM dim_invoices WHERE is_active = 1 AND invoice_date IS NOT NULL
GROUP BY 1, 2, currency""")
def q_gold_invoice_monthly(spark, d):
    return invoice.gold_invoice_monthly(S.dim_invoices(spark, d))


@register("gold_customer_invoices", f"""
SELECT customer_id, COUNT(*) AS invoice_count,
       COUNT(*) FILTER (WHERE status = 'PAID') AS paid_count,
       COUNT(*) FILTER (WHERE status = 'SENT') AS unpaid_count,
       {D("SUM(total)")} AS total_amount,
       {D("COALESCE(SUM(total) FILTER (WHERE status = 'PAID'), 0)")} AS paid_amount,
       {D("COALESCE(SUM(total) FILTER (WHERE status = 'SENT'), 0)")} AS unpaid_amount,
       {_avg_money("total")} AS avg_invoice_amount,
       CAST(MIN(invoice_date) AS VARCHAR) AS first_invoice,
       CAST(MAX(invoice_date) AS VARCHAR) AS last_invoice, currency
FROM dim_invoices WHERE is_active = 1 GROUP BY customer_id, currency""")
def q_gold_customer_invoices(spark, d):
    return invoice.gold_customer_invoices(S.dim_invoices(spark, d))


# ------------------------------------------------------------------ E-II documented analytics

from .plans import analytics as A  # noqa: E402
from .plans import profiles as P  # noqa: E402

T_REV, T_EXP = "Tekjur", "Gjöld"
DATE_FROM, DATE_TO = "1995-01-01", "2002-01-01"
ACCOUNT = "42"
YEAR = "1997"


@register("monthly_net_revenue", f"""
SELECT strftime(transaction_date, '%Y-%m') AS month, {D("SUM(credit - debit)")} AS net_revenue
FROM silver_account_statements_typed
WHERE transaction_date >= DATE '{DATE_FROM}' AND transaction_date < DATE '{DATE_TO}'
  AND account_type = '{T_REV}'
GROUP BY 1""")
def q_monthly_net_revenue(spark, d):
    return A.monthly_net_revenue(_stm(spark, d, typed=True), T_REV, DATE_FROM, DATE_TO)


@register("account_transactions", f"""
SELECT id, CAST(transaction_date AS VARCHAR) AS transaction_date, description,
       {D("amount")} AS amount, {D("balance")} AS balance
FROM silver_account_statements
WHERE account_code = '{ACCOUNT}' AND transaction_date BETWEEN DATE '{DATE_FROM}' AND DATE '{DATE_TO}'
ORDER BY transaction_date DESC, id ASC LIMIT 50""")
def q_account_transactions(spark, d):
    return A.account_transactions(_stm(spark, d), ACCOUNT, DATE_FROM, DATE_TO, 50)


@register("top_expenses", f"""
SELECT account_name, {D("SUM(debit)")} AS total
FROM silver_account_statements_typed
WHERE account_type = '{T_EXP}' AND strftime(transaction_date, '%Y') = '{YEAR}'
GROUP BY account_name ORDER BY SUM(debit) DESC, account_name ASC LIMIT 10""")
def q_top_expenses(spark, d):
    return A.top_expenses(_stm(spark, d, typed=True), T_EXP, YEAR, 10)


@register("quarterly_revenue", f"""
SELECT strftime(transaction_date, '%Y') || '-Q' || CAST(quarter(transaction_date) AS VARCHAR) AS quarter,
       {D("SUM(credit - debit)")} AS revenue
FROM silver_account_statements_typed
WHERE account_type = '{T_REV}' AND transaction_date >= DATE '{DATE_FROM}'
GROUP BY 1""")
def q_quarterly_revenue(spark, d):
    return A.quarterly_revenue(_stm(spark, d, typed=True), T_REV, DATE_FROM)


_MONTHLY_PL = f"""
SELECT strftime(transaction_date, '%Y-%m') AS month, account_type, account_subtype,
       SUM(CASE WHEN account_type = 'Tekjur' THEN credit - debit ELSE 0 END) AS revenue,
       SUM(CASE WHEN account_type = 'Gjöld' THEN debit - credit ELSE 0 END) AS expenses,
       COUNT(*) AS transaction_count
FROM silver_account_statements_typed WHERE transaction_date >= DATE '{SINCE}'
GROUP BY 1, 2, 3"""


def _monthly_pl(spark, d):
    return ledger.gold_monthly_pl(_stm(spark, d, typed=True), SINCE)


@register("monthly_revenue_trend", f"""
SELECT month, {D("SUM(revenue)")} AS total_revenue FROM ({_MONTHLY_PL}) m
WHERE month >= '1996-01' GROUP BY month""")
def q_monthly_revenue_trend(spark, d):
    return A.monthly_revenue_trend_of(_stm(spark, d, typed=True), "1996-01")


@register("largest_expenses_by_month", f"""
SELECT strftime(transaction_date, '%Y-%m') AS month, account_name, {D("SUM(debit)")} AS expense
FROM silver_account_statements_typed
WHERE account_type = '{T_EXP}' AND transaction_date >= DATE '{DATE_FROM}'
GROUP BY 1, 2 HAVING SUM(debit) > 20000""")
def q_largest_expenses_by_month(spark, d):
    return A.largest_expenses_by_month(_stm(spark, d, typed=True), T_EXP, DATE_FROM, 20000)


@register("expense_categories", f"""
SELECT account_subtype, {D("SUM(expenses)")} AS total FROM ({_MONTHLY_PL}) m
WHERE month BETWEEN '1996-01' AND '1999-12' GROUP BY account_subtype""")
def q_expense_categories(spark, d):
    return A.expense_categories_of(_stm(spark, d, typed=True), "1996-01", "1999-12")


_SUMMARY_V2 = f"""
SELECT account_code, account_name, account_type, account_subtype,
       COUNT(id) AS transaction_count, SUM(debit) AS total_debit, SUM(credit) AS total_credit,
       SUM(credit - debit) AS net_change,
       CAST(MIN(transaction_date) AS VARCHAR) AS first_transaction,
       CAST(MAX(transaction_date) AS VARCHAR) AS last_transaction
FROM silver_account_statements_typed WHERE transaction_date >= DATE '{SINCE}'
GROUP BY 1, 2, 3, 4"""


def _summary_v2(spark, d):
    return ledger.gold_account_summary_v2(_stm(spark, d, typed=True), SINCE)


@register("account_activity", f"""
SELECT account_name, transaction_count, {D("total_debit")} AS total_debit,
       {D("total_credit")} AS total_credit, {D("net_change")} AS net_change
FROM ({_SUMMARY_V2}) s WHERE transaction_count > 30""")
def q_account_activity(spark, d):
    return A.account_activity(_summary_v2(spark, d), 30)


@register("account_activity_top", f"""
SELECT account_code, account_name, account_type, account_subtype, transaction_count,
       {D("total_debit")} AS total_debit, {D("total_credit")} AS total_credit,
       {D("net_change")} AS net_change, first_transaction, last_transaction
FROM ({_SUMMARY_V2}) s
ORDER BY abs(net_change) DESC, account_code, account_type, account_subtype LIMIT 20""")
def q_account_activity_top(spark, d):
    return A.account_activity_top(_summary_v2(spark, d), 20)


@register("balance_over_time", f"""
SELECT CAST(transaction_date AS VARCHAR) AS transaction_date, {D("balance")} AS balance
FROM silver_account_statements
WHERE account_code = '{ACCOUNT}' AND transaction_date >= DATE '{DATE_FROM}'""")
def q_balance_over_time(spark, d):
    return A.balance_over_time(_stm(spark, d), ACCOUNT, DATE_FROM)


@register("daily_cash_flow", f"""
SELECT CAST(transaction_date AS VARCHAR) AS transaction_date, {D("SUM(credit - debit)")} AS daily_net
FROM silver_account_statements
WHERE account_code = '{ACCOUNT}' AND transaction_date BETWEEN DATE '{DATE_FROM}' AND DATE '{DATE_TO}'
GROUP BY transaction_date""")
def q_daily_cash_flow(spark, d):
    return A.daily_cash_flow(_stm(spark, d), ACCOUNT, DATE_FROM, DATE_TO)


@register("monthly_cash_position", f"""
SELECT strftime(transaction_date, '%Y-%m') AS month, {_avg_money("balance")} AS avg_balance,
       {D("MAX(balance)")} AS max_balance, {D("MIN(balance)")} AS min_balance
FROM silver_account_statements WHERE account_code = '{ACCOUNT}' GROUP BY 1""")
def q_monthly_cash_position(spark, d):
    return A.monthly_cash_position(_stm(spark, d), ACCOUNT)


@register("monthly_pl_overview", f"""
SELECT month, {D("SUM(revenue)")} AS revenue, {D("SUM(expenses)")} AS expenses,
       {D("SUM(revenue - expenses)")} AS net
FROM ({_MONTHLY_PL}) m GROUP BY month""")
def q_monthly_pl_overview(spark, d):
    return A.monthly_pl_overview(_monthly_pl(spark, d))


@register("monthly_trend_overview", f"""
SELECT strftime(s.transaction_date, '%Y-%m') AS month,
       {D("SUM(CASE WHEN a.account_type = 'Tekjur' THEN s.debit - s.credit ELSE 0 END)")} AS total_revenue,
       {D("SUM(CASE WHEN a.account_type = 'Gjöld' THEN s.credit - s.debit ELSE 0 END)")} AS total_expenses
FROM silver_account_statements s JOIN dim_accounts a ON s.account_code = a.account_number
WHERE s.transaction_date >= DATE '{SINCE}' AND a.account_type IN ('Tekjur', 'Gjöld')
  AND strftime(s.transaction_date, '%Y') = '{YEAR}'
GROUP BY 1""")
def q_monthly_trend_overview(spark, d):
    return A.monthly_trend_overview_of(_stm(spark, d), _acc(spark, d), YEAR)


@register("balance_by_type", f"""
SELECT account_type,
       {D('''SUM(CASE WHEN account_type IN ('Eignir') THEN debit - credit
                      WHEN account_type IN ('Skuldir', 'Eigið fé') THEN credit - debit
                      ELSE 0 END)''')} AS total_balance
FROM silver_account_statements_typed WHERE transaction_date >= DATE '{SINCE}'
GROUP BY account_type""")
def q_balance_by_type(spark, d):
    return A.balance_by_type(ledger.gold_balance_sheet(_stm(spark, d, typed=True), SINCE))


@register("annual_report_detail", f"""
SELECT year, account_code, account_name, {D("balance")} AS amount
FROM ({_BY_YEAR}) v WHERE account_type = '{T_EXP}' AND year = '{YEAR}'
ORDER BY balance DESC, account_code LIMIT 10""")
def q_annual_report_detail(spark, d):
    return A.annual_report_detail_of(_stm(spark, d), _acc(spark, d), T_EXP, YEAR, 10)


@register("distinct_account_types", "SELECT DISTINCT account_type FROM dim_accounts")
def q_distinct_account_types(spark, d):
    return A.distinct_account_types(_acc(spark, d))


# ------------------------------------------------------------------ E-III load profiles

@register("yearly_volume", f"""
SELECT strftime(transaction_date, '%Y') AS year, COUNT(*) AS transactions,
       {D("SUM(abs(amount))")} AS total_amount
FROM silver_account_statements WHERE transaction_date >= DATE '{SINCE}' GROUP BY 1""")
def q_yearly_volume(spark, d):
    return P.yearly_volume(_stm(spark, d), SINCE)


@register("invoice_status_stats", f"""
SELECT status, COUNT(*) AS count, {D("SUM(total)")} AS total_amount
FROM dim_invoices GROUP BY status""")
def q_invoice_status_stats(spark, d):
    return P.invoice_status_stats(S.dim_invoices(spark, d))


@register("range_volume", f"""
SELECT COUNT(*) AS count, CAST(MIN(transaction_date) AS VARCHAR) AS min_date,
       CAST(MAX(transaction_date) AS VARCHAR) AS max_date,
       {D("SUM(abs(amount))")} AS total_amount, COUNT(DISTINCT account_code) AS unique_accounts
FROM silver_account_statements
WHERE transaction_date BETWEEN DATE '{DATE_FROM}' AND DATE '{DATE_TO}'""")
def q_range_volume(spark, d):
    return P.range_volume(_stm(spark, d), DATE_FROM, DATE_TO)


@register("date_range_invoices", """
SELECT CAST(MIN(invoice_date) AS VARCHAR) AS min_date, CAST(MAX(invoice_date) AS VARCHAR) AS max_date
FROM dim_invoices WHERE invoice_date IS NOT NULL""")
def q_date_range_invoices(spark, d):
    return P.date_range(S.dim_invoices(spark, d), "invoice_date")


@register("date_range_by_account", """
SELECT branch, ledger, account_no, CAST(MIN(booking_date) AS VARCHAR) AS min_date,
       CAST(MAX(booking_date) AS VARCHAR) AS max_date
FROM silver_bank_transactions WHERE booking_date IS NOT NULL AND year(booking_date) > 2020
GROUP BY 1, 2, 3""")
def q_date_range_by_account(spark, d):
    return P.date_range(S.silver_bank_transactions(spark, d), "booking_date",
                        by=["branch", "ledger", "account_no"], min_year=2020)


@register("silver_row_counts", """
SELECT 'silver_account_statements' AS table_name, COUNT(*) AS row_count FROM silver_account_statements
UNION ALL SELECT 'dim_accounts', COUNT(*) FROM dim_accounts
UNION ALL SELECT 'dim_invoices', COUNT(*) FROM dim_invoices
UNION ALL SELECT 'dim_invoice_lines', COUNT(*) FROM dim_invoice_lines
UNION ALL SELECT 'silver_bank_transactions', COUNT(*) FROM silver_bank_transactions
UNION ALL SELECT 'silver_creditcard_transactions', COUNT(*) FROM silver_card_transactions
UNION ALL SELECT 'gold_invoice_summary', COUNT(*) FROM dim_invoices WHERE is_active = 1""")
def q_silver_row_counts(spark, d):
    return P.silver_row_counts({
        "silver_account_statements": _stm(spark, d),
        "dim_accounts": _acc(spark, d),
        "dim_invoices": S.dim_invoices(spark, d),
        "dim_invoice_lines": S.dim_invoice_lines(spark, d),
        "silver_bank_transactions": S.silver_bank_transactions(spark, d),
        "silver_creditcard_transactions": S.silver_card_transactions(spark, d),
        "gold_invoice_summary": invoice.gold_invoice_summary(S.dim_invoices(spark, d), AS_OF),
    })


# ------------------------------------------------------------------ C search, paging, SQL

from .config import config_table  # noqa: E402
from .functions.currency import fx_rates  # noqa: E402
from .operators import paging, reports as R, search  # noqa: E402
from .operators.sql_guard import guarded_sql  # noqa: E402

BANK_FROM, BANK_TO = "2024-01-05", "2024-01-25"

_C1_SQL = f"""
WITH b AS (
  SELECT 'bank' AS account_type, branch || '-' || ledger || '-' || account_no AS account_number,
         value_date AS date, description, amount, balance, reference AS reference_number,
         currency, type_code AS transaction_type, CAST(NULL AS VARCHAR) AS merchant_name,
         CAST(NULL AS VARCHAR) AS card_number_masked, 0 AS src, id AS tie
  FROM silver_bank_transactions
  WHERE value_date >= DATE '{BANK_FROM}' AND value_date <= DATE '{BANK_TO}'),
c AS (
  SELECT 'card' AS account_type, card_id AS account_number, date, description, amount,
         CAST(NULL AS DECIMAL(18,2)) AS balance, CAST(NULL AS VARCHAR) AS reference_number,
         currency, 'CARD_TRANSACTION' AS transaction_type, merchant_name,
         CAST(NULL AS VARCHAR) AS card_number_masked, 1 AS src, entry_id AS tie
  FROM silver_card_transactions
  WHERE date >= DATE '{BANK_FROM}' AND date <= DATE '{BANK_TO}'),
tx AS (SELECT * FROM b UNION ALL SELECT * FROM c)"""


def _c1(spark, d, limit=None):
    return search.bank_transactions(S.silver_bank_transactions(spark, d),
                                    S.silver_card_transactions(spark, d), BANK_FROM, BANK_TO,
                                    None, "all", limit)


@register("bank_transactions", _C1_SQL + f"""
SELECT account_type, account_number, CAST(date AS VARCHAR) AS date, description,
       {D("amount")} AS amount, {D("balance")} AS balance, reference_number, currency,
       transaction_type, merchant_name, card_number_masked FROM tx
ORDER BY tx.date DESC, src, tx.account_number, tie LIMIT 100""")
def q_bank_transactions(spark, d):
    return _c1(spark, d, 100)


_C1_WHOLE_SQL = _C1_SQL.replace(
    f"WHERE value_date >= DATE '{BANK_FROM}' AND value_date <= DATE '{BANK_TO}'", "").replace(
    f"WHERE date >= DATE '{BANK_FROM}' AND date <= DATE '{BANK_TO}'", "")


def _c1_whole(spark, d):
    return search.bank_transactions(S.silver_bank_transactions(spark, d),
                                    S.silver_card_transactions(spark, d))


@register("bank_summary", _C1_WHOLE_SQL + f"""
SELECT COUNT(*) AS total_transactions, {D("COALESCE(SUM(amount), 0)")} AS total_amount,
       'all' AS date_from, 'all' AS date_to FROM tx""")
def q_bank_summary(spark, d):
    return R.bank_summary(_c1_whole(spark, d))[0]


@register("bank_summary_accounts", _C1_WHOLE_SQL + f"""
, newest AS (
  SELECT *, row_number() OVER (PARTITION BY account_number
                               ORDER BY date DESC, account_type, currency) AS k FROM tx)
SELECT account_number, MIN(account_type) FILTER (WHERE k = 1) AS account_type,
       COUNT(*) AS transaction_count, {D("SUM(amount)")} AS total_amount,
       MIN(currency) FILTER (WHERE k = 1) AS currency
FROM newest GROUP BY account_number""")
def q_bank_summary_accounts(spark, d):
    return R.bank_summary(_c1_whole(spark, d))[1]


_INV_COLS = ("invoice_id, invoice_number, customer_id, status, currency, {0}, "
             "CAST(invoice_date AS VARCHAR) AS invoice_date, CAST(due_date AS VARCHAR) AS due_date, "
             "CAST(final_due_date AS VARCHAR) AS final_due_date, paid_date, payment_type, "
             "description, reference, is_active, created_at, updated_at").format(
    ", ".join(f"{D(c)} AS {c}" for c in ("subtotal", "vat_amount", "total")))


@register("invoice_search", f"""
SELECT {_INV_COLS} FROM dim_invoices
WHERE invoice_date >= DATE '1996-01-01' AND invoice_date <= DATE '1996-12-31'
  AND (status NOT IN ('DRAFT', 'CANCELLED') OR status IS NULL)
  AND (lower(invoice_number) LIKE '%99%' OR lower(description) LIKE '%99%'
       OR lower(reference) LIKE '%99%')""")
def q_invoice_search(spark, d):
    return search.invoice_search(S.dim_invoices(spark, d), date_from="1996-01-01",
                                 date_to="1996-12-31", exclude_status="DRAFT,CANCELLED",
                                 query="99", order_by="total", order="desc")


def _nullable_ints_as_double(df):
    # invoices without lines give NULL line numbers: presented as DOUBLE on both sides
    return df.withColumn("line_line_number", F.col("line_line_number").cast("double"))


@register("invoice_search_lines", f"""
SELECT i.*, l.id AS line_id, CAST(l.line_number AS DOUBLE) AS line_line_number,
       l.description AS line_description, {D("l.quantity")} AS line_quantity,
       {D("l.unit_price")} AS line_unit_price, {D("l.discount_percent")} AS line_discount_percent,
       {D("l.vat_percent")} AS line_vat_percent, {D("l.vat_amount")} AS line_vat_amount,
       {D("l.line_total")} AS line_line_total, l.account_id AS line_account_id,
       l.account_code AS line_account_code, l.created_at AS line_created_at
FROM (SELECT {_INV_COLS} FROM dim_invoices
      WHERE customer_id = '7' AND due_date >= DATE '1995-06-01') i
LEFT JOIN dim_invoice_lines l ON i.invoice_id = l.invoice_id""")
def q_invoice_search_lines(spark, d):
    return _nullable_ints_as_double(search.invoice_search(
        S.dim_invoices(spark, d), S.dim_invoice_lines(spark, d), customer_id="7",
        due_from="1995-06-01", include_lines=True))


@register("invoice_lookup", f"SELECT {_INV_COLS} FROM dim_invoices WHERE invoice_number = '4242'")
def q_invoice_lookup(spark, d):
    return search.invoice_lookup(S.dim_invoices(spark, d), "4242")


@register("customer_search", f"""
SELECT customer_id, name, segment, country, {D("balance")} AS balance FROM customers
WHERE lower(name) LIKE '%customer#0000001%' OR lower(customer_id) LIKE '%customer#0000001%'""")
def q_customer_search(spark, d):
    return search.customer_search(S.customers(spark, d), "Customer#0000001")


@register("customer_get", f"""
SELECT customer_id, name, segment, country, {D("balance")} AS balance FROM customers
WHERE customer_id = '42'""")
def q_customer_get(spark, d):
    return search.customer_get(S.customers(spark, d), "42")


@register("expense_search", f"""
SELECT expense_id, creditor_id, CAST(date AS VARCHAR) AS date, {D("amount")} AS amount,
       description, account_code FROM expenses
WHERE date >= DATE '1997-01-01' AND date <= DATE '1997-06-30'
  AND (lower(description) LIKE '%part 1%' OR lower(creditor_id) LIKE '%part 1%')""")
def q_expense_search(spark, d):
    return search.expense_search(S.expenses(spark, d), "1997-01-01", "1997-06-30", "Part 1")


@register("payment_search", f"""
SELECT payment_id, invoice_id, customer_id, CAST(date AS VARCHAR) AS date, {D("amount")} AS amount,
       currency, payment_type FROM payments
WHERE date >= DATE '1996-01-01' AND date <= DATE '1996-12-31'""")
def q_payment_search(spark, d):
    return search.payment_search(S.payments(spark, d), "1996-01-01", "1996-12-31")


@register("account_statement", f"""
SELECT id, account_code, account_id, account_name, account_type, account_subtype,
       CAST(transaction_date AS VARCHAR) AS transaction_date,
       CAST(journal_date AS VARCHAR) AS journal_date, description, reference,
       {D("amount")} AS amount, {D("debit")} AS debit, {D("credit")} AS credit,
       {D("balance")} AS balance, currency, journal_id, journal_number, line_number,
       record_type, created_at
FROM silver_account_statements_typed
WHERE journal_date >= DATE '1996-01-01' AND journal_date <= DATE '1996-03-31'
  AND account_type = 'Eignir'""")
def q_account_statement(spark, d):
    return search.account_statement(_stm(spark, d, typed=True), "1996-01-01", "1996-03-31",
                                    account_type="Eignir")


@register("journal_entries", f"""
SELECT journal_id, journal_number, CAST(MIN(journal_date) AS VARCHAR) AS journal_date,
       COUNT(*) AS line_count, {D("SUM(debit)")} AS total_debit, {D("SUM(credit)")} AS total_credit
FROM silver_account_statements GROUP BY journal_id, journal_number""")
def q_journal_entries(spark, d):
    return search.journal_entries(_stm(spark, d))


@register("expense_accounts", """
SELECT * FROM dim_accounts WHERE account_type IN ('Gjöld', 'Expense', 'Cost')""")
def q_expense_accounts(spark, d):
    return search.expense_accounts(_acc(spark, d))


@register("paginate_accounts", """
SELECT * FROM dim_accounts
ORDER BY account_number, account_id, account_name, account_type, account_subtype,
         parent_account_id, is_active, created_at, updated_at
LIMIT 50 OFFSET 100""")
def q_paginate_accounts(spark, d):
    return paging.paginate(_acc(spark, d), ["account_number"], page=3, perpage=50)[0]


@register("paginate_accounts_meta", """
SELECT 3 AS page, 50 AS perpage, COUNT(*) AS total, COUNT(*) > 150 AS has_next FROM dim_accounts""")
def q_paginate_accounts_meta(spark, d):
    return paging.paginate(_acc(spark, d), ["account_number"], page=3, perpage=50)[1]


def register_views(spark, d) -> None:
    """Temp views over the stand-ins, for guarded SQL."""
    _stm(spark, d, typed=True).createOrReplaceTempView("silver_account_statements")
    _acc(spark, d).createOrReplaceTempView("dim_accounts")
    S.dim_invoices(spark, d).createOrReplaceTempView("dim_invoices")


@register("guarded_sql_monthly_revenue", f"""
SELECT strftime(transaction_date, '%Y-%m') AS month, {D("SUM(credit - debit)")} AS net_revenue
FROM silver_account_statements_typed
WHERE transaction_date >= DATE '1996-01-01' AND transaction_date < DATE '1998-01-01'
  AND account_type = 'Tekjur'
GROUP BY 1""")
def q_guarded_sql_monthly_revenue(spark, d):
    register_views(spark, d)
    return guarded_sql(spark, """
        -- monthly net revenue for one account type
        SELECT date_format(transaction_date, 'yyyy-MM') AS month,
               SUM(credit - debit) AS net_revenue
        FROM silver_account_statements
        WHERE transaction_date >= ? AND transaction_date < ? AND account_type = ?
        GROUP BY month ORDER BY month;""", ["1996-01-01", "1998-01-01", "Tekjur"])


@register("guarded_sql_top_expenses", f"""
SELECT account_name, {D("SUM(debit)")} AS total
FROM silver_account_statements_typed
WHERE account_type = 'Gjöld' AND CAST(transaction_date AS VARCHAR) LIKE '1997%'
GROUP BY account_name ORDER BY SUM(debit) DESC, account_name LIMIT 10""")
def q_guarded_sql_top_expenses(spark, d):
    register_views(spark, d)
    return guarded_sql(spark, """
        SELECT account_name, SUM(debit) AS total FROM silver_account_statements
        WHERE account_type = ? AND CAST(transaction_date AS STRING) LIKE ?
        GROUP BY account_name ORDER BY total DESC, account_name LIMIT ?""", ["Gjöld", "1997%", 10])


# ------------------------------------------------------------------ E42-E59 report operators

_LINES = """lines AS (
  SELECT branch || '-' || ledger || '-' || account_no AS account, 'Account ' || account_no AS account_name,
         currency, booking_date AS date, description, amount, balance,
         CAST(reference AS BIGINT) AS row_no
  FROM silver_bank_transactions)"""
_RATES = "rates AS (SELECT * FROM (VALUES ('EUR', 150.0), ('GBP', 175.0)) r(currency, rate_to_isk))"
_MONTHLY = """monthly AS (
  SELECT account, currency, strftime(date, '%Y-%m') AS month,
         SUM(CASE WHEN amount > 0 THEN amount ELSE 0 END) AS credits,
         SUM(CASE WHEN amount < 0 THEN -amount ELSE 0 END) AS debits, COUNT(*) AS count
  FROM lines WHERE amount <> 0 GROUP BY 1, 2, 3)"""
_MONTHLY_FX = """monthly_fx AS (
  SELECT m.month, SUM(CAST(m.net AS DECIMAL(38,2)) * CAST(COALESCE(r.rate_to_isk, 1) AS DECIMAL(18,6))) AS net_flow_isk
  FROM (SELECT currency, month, SUM(credits - debits) AS net FROM monthly GROUP BY 1, 2) m
  LEFT JOIN rates r ON m.currency = r.currency GROUP BY m.month)"""
_PROFILE = """profile AS (
  SELECT account, account_name, currency,
         COUNT(CASE WHEN amount <> 0 THEN 1 END) AS transactions,
         COALESCE(SUM(CASE WHEN amount > 0 THEN amount END), 0) AS total_credits,
         COALESCE(SUM(CASE WHEN amount < 0 THEN -amount END), 0) AS total_debits,
         COALESCE(MAX(CASE WHEN amount > 0 THEN amount END), 0) AS largest_inflow,
         COALESCE(MAX(CASE WHEN amount < 0 THEN -amount END), 0) AS largest_outflow,
         COALESCE(arg_max(balance, (date, row_no)) FILTER (WHERE balance <> 0), 0) AS ending_balance
  FROM lines GROUP BY 1, 2, 3)"""


def _lines(spark, d):
    return R.account_lines_from_bank(S.silver_bank_transactions(spark, d))


@register("account_profile", f"""WITH {_LINES}, {_PROFILE}
SELECT account, account_name, currency, transactions, {D("total_credits")} AS total_credits,
       {D("total_debits")} AS total_debits, {D("largest_inflow")} AS largest_inflow,
       {D("largest_outflow")} AS largest_outflow, {D("ending_balance")} AS ending_balance,
       CASE WHEN transactions > 0 THEN CAST(total_credits - total_debits AS DOUBLE) / transactions
            ELSE 0.0 END AS average_transaction
FROM profile""")
def q_account_profile(spark, d):
    return R.account_profile(_lines(spark, d))


@register("account_monthly_activity", f"""WITH {_LINES}, {_MONTHLY}
SELECT account, month, {D("credits")} AS credits, {D("debits")} AS debits, count
FROM (SELECT *, dense_rank() OVER (PARTITION BY account ORDER BY month DESC) AS rk FROM monthly) t
WHERE rk <= 6""")
def q_account_monthly_activity(spark, d):
    return R.account_monthly_activity(_lines(spark, d), 6)


@register("frequent_descriptions", f"""WITH {_LINES}
SELECT account, description_prefix, count, CAST(rank AS INTEGER) AS rank FROM (
  SELECT account, description_prefix, count,
         row_number() OVER (PARTITION BY account ORDER BY count DESC, description_prefix) AS rank
  FROM (SELECT account, COALESCE(description, '') AS description_prefix, COUNT(*) AS count
        FROM lines WHERE amount <> 0 AND COALESCE(description, '') <> '' GROUP BY 1, 2) g) t
WHERE rank <= 5""")
def q_frequent_descriptions(spark, d):
    return R.frequent_descriptions(_lines(spark, d), 5)


@register("company_totals", f"""WITH {_LINES}, {_RATES},
per_cur AS (SELECT currency, SUM(CASE WHEN amount > 0 THEN amount ELSE 0 END) AS c,
                   SUM(CASE WHEN amount < 0 THEN -amount ELSE 0 END) AS d FROM lines GROUP BY 1),
j AS (SELECT CAST(c AS DECIMAL(38,2)) * CAST(COALESCE(r.rate_to_isk, 1) AS DECIMAL(18,6)) AS ci,
             CAST(d AS DECIMAL(38,2)) * CAST(COALESCE(r.rate_to_isk, 1) AS DECIMAL(18,6)) AS di
      FROM per_cur p LEFT JOIN rates r ON p.currency = r.currency)
SELECT {D("SUM(ci)")} AS total_inflows_isk, {D("SUM(di)")} AS total_outflows_isk,
       {D("SUM(ci) - SUM(di)")} AS net_position_isk FROM j""")
def q_company_totals(spark, d):
    return R.company_totals(_lines(spark, d), fx_rates(spark))


@register("company_cash_flow", f"""WITH {_LINES}, {_RATES}, {_MONTHLY}, {_MONTHLY_FX}
SELECT month, {D("net_flow_isk")} AS net_flow_isk FROM monthly_fx
WHERE month IN (SELECT month FROM monthly_fx ORDER BY month DESC LIMIT 12)""")
def q_company_cash_flow(spark, d):
    return R.company_cash_flow(_lines(spark, d), fx_rates(spark), 12)


@register("quarterly_performance", f"""WITH {_LINES}, {_RATES}, {_MONTHLY}, {_MONTHLY_FX},
q AS (SELECT substr(month, 1, 4) || '-Q' || CAST(CAST(ceil(CAST(substr(month, 6, 2) AS INTEGER) / 3) AS BIGINT) AS VARCHAR) AS quarter,
             SUM(net_flow_isk) AS total_isk FROM monthly_fx GROUP BY 1)
SELECT quarter, {D("total_isk")} AS total_isk FROM q
WHERE quarter IN (SELECT quarter FROM q ORDER BY quarter DESC LIMIT 8)""")
def q_quarterly_performance(spark, d):
    return R.quarterly_performance(_lines(spark, d), fx_rates(spark), 8)


@register("account_usage", f"""WITH {_LINES}, {_MONTHLY}, {_PROFILE},
months AS (SELECT account, COUNT(*) AS active_months FROM monthly GROUP BY account)
SELECT p.account, account_name, currency, transactions,
       transactions / greatest(1, COALESCE(active_months, 0)) AS avg_monthly_transactions,
       currency <> 'ISK' AS is_foreign, {D("ending_balance")} AS ending_balance
FROM profile p LEFT JOIN months m ON p.account = m.account""")
def q_account_usage(spark, d):
    return R.account_usage(_lines(spark, d))


_CV = """cv AS (
  SELECT account, counterparty, count, total, rank FROM (
    SELECT account, counterparty, count, total,
           row_number() OVER (PARTITION BY account ORDER BY abs(total) DESC, counterparty) AS rank
    FROM (SELECT account, trim(COALESCE(description, '')) AS counterparty,
                 COUNT(*) AS count, SUM(amount) AS total
          FROM lines WHERE amount <> 0 AND trim(COALESCE(description, '')) <> ''
          GROUP BY 1, 2) g) t
  WHERE rank <= 5)"""


@register("counterparty_volume", f"""WITH {_LINES}, {_CV}
SELECT account, counterparty, count, {D("total")} AS total, CAST(rank AS INTEGER) AS rank FROM cv""")
def q_counterparty_volume(spark, d):
    return R.counterparty_volume(_lines(spark, d), 5)


_NAMES = """names AS (
  SELECT trim(COALESCE(description, '')) AS counterparty, COUNT(*) AS transactions
  FROM lines WHERE amount <> 0 AND trim(COALESCE(description, '')) <> '' GROUP BY 1)"""


@register("recurring_counterparties", f"""WITH {_LINES}, {_NAMES}
SELECT counterparty, transactions FROM names WHERE transactions >= 3
ORDER BY transactions DESC, counterparty LIMIT 10""")
def q_recurring_counterparties(spark, d):
    return R.recurring_counterparties(_lines(spark, d), 10)


@register("counterparty_stats", f"""WITH {_LINES}, {_NAMES}
SELECT COUNT(*) AS unique_counterparties,
       COUNT(*) FILTER (WHERE transactions >= 3) AS recurring_counterparties FROM names""")
def q_counterparty_stats(spark, d):
    return R.counterparty_stats(_lines(spark, d))


@register("largest_transactions", f"""WITH {_LINES},
ins AS (SELECT 'inflow' AS kind, account, date, amount, description, row_no
        FROM lines WHERE currency = 'ISK' AND amount > 0 ORDER BY amount DESC, account, row_no LIMIT 5),
outs AS (SELECT 'outflow' AS kind, account, date, amount, description, row_no
         FROM lines WHERE currency = 'ISK' AND amount < 0 ORDER BY amount ASC, account, row_no LIMIT 5)
SELECT kind, account, CAST(date AS VARCHAR) AS date, {D("amount")} AS amount, description, row_no
FROM (SELECT * FROM ins UNION ALL SELECT * FROM outs) u WHERE year(date) > 2020""")
def q_largest_transactions(spark, d):
    return R.largest_transactions(_lines(spark, d), 5, 2020)


@register("isk_monthly_trend", f"""WITH {_LINES}, {_MONTHLY}
SELECT month, {D("SUM(credits)")} AS revenue, {D("SUM(debits)")} AS expenses,
       {D("SUM(credits) - SUM(debits)")} AS net
FROM monthly WHERE currency = 'ISK' AND CAST(substr(month, 1, 4) AS INTEGER) >= 2024 GROUP BY month""")
def q_isk_monthly_trend(spark, d):
    return R.isk_monthly_trend(_lines(spark, d), 2024)


@register("invoice_summary", """
WITH st AS (
  SELECT COALESCE(status, 'unknown') AS status, COUNT(*) AS n, SUM(COALESCE(total, 0)) AS tv,
         arg_max(invoice_number, (COALESCE(created_at, ''), invoice_id)) AS rec_number,
         arg_max(created_at, (COALESCE(created_at, ''), invoice_id)) AS rec_created,
         max((COALESCE(created_at, ''), invoice_id)) AS reck
  FROM dim_invoices GROUP BY 1),
tot AS (
  SELECT SUM(n) AS total_items, SUM(tv) AS total_value,
         string_agg(CAST(n AS VARCHAR) || ' ' || status, ', ' ORDER BY CAST(n AS VARCHAR) || ' ' || status) AS status_breakdown,
         SUM(CASE WHEN status = 'OVERDUE' THEN n ELSE 0 END) AS overdue_count,
         SUM(CASE WHEN status = 'SENT' THEN n ELSE 0 END) AS awaiting_count,
         arg_max(rec_number, reck) AS most_recent_number, arg_max(rec_created, reck) AS most_recent_created
  FROM st)
SELECT CAST(total_items AS BIGINT) AS total_items, CAST(total_value AS DOUBLE) AS total_value,
       CAST((CAST(total_value * 100 AS BIGINT) * 2 + total_items * 100) // (total_items * 200) AS BIGINT) AS average_value,
       status_breakdown, most_recent_number, most_recent_created,
       CAST(overdue_count AS BIGINT) AS overdue_count, CAST(awaiting_count AS BIGINT) AS awaiting_count,
       CAST(total_value AS DOUBLE) / total_items > 1000.0 AS high_average
FROM tot""")
def q_invoice_summary(spark, d):
    return R.invoice_summary(S.dim_invoices(spark, d))


_BAL = """bal AS (
  SELECT a.account_number AS code, a.account_name AS name, a.account_type AS type,
         COALESCE(NULLIF(a.account_subtype, ''), 'Other') AS sub_type,
         COALESCE(t.s, 0) AS balance,
         CASE WHEN a.account_type IN ('Tekjur', 'Income', 'Revenue') THEN 'revenue'
              WHEN a.account_type IN ('Gjöld', 'Expense', 'Cost') THEN 'expense'
              WHEN a.account_type IN ('Eignir', 'Asset') THEN 'asset'
              WHEN a.account_type IN ('Skuldir', 'Liability') THEN 'liability'
              WHEN a.account_type IN ('Eigið fé', 'Equity') THEN 'equity' ELSE 'other' END AS class
  FROM dim_accounts a LEFT JOIN (
    SELECT account_code, SUM(amount) AS s FROM silver_account_statements
    WHERE year(transaction_date) = {y} GROUP BY account_code) t ON a.account_number = t.account_code)"""


@register("income_statement_lines", f"""WITH {_BAL.format(y=YEAR)}
SELECT class AS section, code, name, {D("abs(balance)")} AS amount FROM bal
WHERE class IN ('revenue', 'expense') AND abs(balance) > 0""")
def q_income_statement_lines(spark, d):
    return R.income_statement(_acc(spark, d), _stm(spark, d), YEAR)[0]


@register("income_statement_totals", f"""WITH {_BAL.format(y=YEAR)}
SELECT {D("COALESCE(SUM(CASE WHEN class = 'revenue' THEN abs(balance) ELSE 0 END), 0)")} AS total_revenue,
       {D("COALESCE(SUM(CASE WHEN class = 'expense' THEN abs(balance) ELSE 0 END), 0)")} AS total_expenses,
       {D('''COALESCE(SUM(CASE WHEN class = 'revenue' THEN abs(balance) ELSE 0 END), 0)
             - COALESCE(SUM(CASE WHEN class = 'expense' THEN abs(balance) ELSE 0 END), 0)''')} AS net_income
FROM bal WHERE class IN ('revenue', 'expense')""")
def q_income_statement_totals(spark, d):
    return R.income_statement(_acc(spark, d), _stm(spark, d), YEAR)[1]


@register("balance_sheet_lines", f"""WITH {_BAL.format(y=YEAR)}
SELECT class AS section, sub_type, code, name, {D("abs(balance)")} AS amount FROM bal
WHERE class IN ('asset', 'liability', 'equity') AND abs(balance) > 0""")
def q_balance_sheet_lines(spark, d):
    return R.balance_sheet(_acc(spark, d), _stm(spark, d), YEAR)[0]


@register("balance_sheet_totals", f"""WITH {_BAL.format(y=YEAR)},
l AS (SELECT class, abs(balance) AS amount FROM bal
      WHERE class IN ('asset', 'liability', 'equity') AND abs(balance) > 0)
SELECT {D("COALESCE(SUM(CASE WHEN class = 'asset' THEN amount END), 0)")} AS total_assets,
       {D("COALESCE(SUM(CASE WHEN class = 'liability' THEN amount END), 0)")} AS total_liabilities,
       {D("COALESCE(SUM(CASE WHEN class = 'equity' THEN amount END), 0)")} AS total_equity,
       {D('''COALESCE(SUM(CASE WHEN class = 'liability' THEN amount END), 0)
             + COALESCE(SUM(CASE WHEN class = 'equity' THEN amount END), 0)''')} AS total_liabilities_and_equity
FROM l""")
def q_balance_sheet_totals(spark, d):
    return R.balance_sheet(_acc(spark, d), _stm(spark, d), YEAR)[1]


def _metrics_sql(y: str) -> str:
    return f"""(SELECT metric, value FROM (
  SELECT COALESCE(SUM(CASE WHEN class = 'revenue' THEN abs(balance) END), 0) AS r,
         COALESCE(SUM(CASE WHEN class = 'expense' THEN abs(balance) END), 0) AS e,
         COALESCE(SUM(CASE WHEN class = 'asset' THEN abs(balance) END), 0) AS a,
         COALESCE(SUM(CASE WHEN class = 'liability' THEN abs(balance) END), 0) AS l
  FROM ({_BAL.format(y=y).split(' AS (', 1)[1][:-1]}) b) w,
  LATERAL (VALUES ('Total Revenue', r), ('Total Expenses', e), ('Net Income', r - e),
                  ('Total Assets', a), ('Total Liabilities', l)) v(metric, value))"""


@register("key_metrics", f"SELECT metric, {D('value')} AS value FROM {_metrics_sql(YEAR)} m")
def q_key_metrics(spark, d):
    return R.key_metrics(_acc(spark, d), _stm(spark, d), YEAR)


@register("year_over_year", f"""
SELECT m1.metric, {D("m1.value")} AS value_1, {D("m2.value")} AS value_2,
       {D("m2.value - m1.value")} AS change,
       CASE WHEN CAST(m1.value AS DOUBLE) <> 0
            THEN (CAST(m2.value AS DOUBLE) - CAST(m1.value AS DOUBLE)) / CAST(m1.value AS DOUBLE) * 100.0
            ELSE 0.0 END AS pct_change
FROM {_metrics_sql("1996")} m1 JOIN {_metrics_sql(YEAR)} m2 ON m1.metric = m2.metric""")
def q_year_over_year(spark, d):
    return R.year_over_year(_acc(spark, d), _stm(spark, d), "1996", YEAR)


@register("accounts_of_type", """
SELECT account_type, COALESCE(NULLIF(account_subtype, ''), 'Other') AS sub_type, account_number,
       account_name FROM dim_accounts""")
def q_accounts_of_type(spark, d):
    return R.accounts_of_type(_acc(spark, d))


@register("accounts_by_type", """
SELECT account_type, COALESCE(NULLIF(account_subtype, ''), 'Other') AS sub_type,
       COUNT(*) AS account_count FROM dim_accounts GROUP BY 1, 2""")
def q_accounts_by_type(spark, d):
    return R.accounts_by_type(_acc(spark, d))


# ------------------------------------------------------------------ J loaders, D matching, L, E61-E65

from .operators import loading as LD, matching as M, writeback as WB  # noqa: E402
from .plans import marts as MT  # noqa: E402
from .sources import dims as DM  # noqa: E402

_STM_KEYED = """
  SELECT *, substr(sha1(COALESCE(id, '')), 1, 16) || '-' || CAST(row_number() OVER (
              PARTITION BY account_code, transaction_date, journal_id, journal_number, amount,
                           description, COALESCE(id, '') ORDER BY id) AS VARCHAR) AS occurrence_no
  FROM silver_account_statements WHERE {cond}"""
_LINE_KEY = ("sha1(concat_ws('|', COALESCE(account_code, ''), COALESCE(CAST(transaction_date AS VARCHAR), ''), "
             "COALESCE(journal_id, ''), COALESCE(journal_number, ''), COALESCE(CAST(amount AS VARCHAR), ''), "
             "COALESCE(description, ''), occurrence_no))")


NEW_LINES_SQL = f"""
WITH t AS ({_STM_KEYED.format(cond="transaction_date < DATE '1998-01-01'")}),
b AS ({_STM_KEYED.format(cond="transaction_date >= DATE '1997-07-01'")})
SELECT id, account_code, account_id, account_name, account_type, account_subtype,
       CAST(transaction_date AS VARCHAR) AS transaction_date, CAST(journal_date AS VARCHAR) AS journal_date,
       description, reference, {D("amount")} AS amount, {D("debit")} AS debit, {D("credit")} AS credit,
       {D("balance")} AS balance, currency, journal_id, journal_number, line_number, record_type,
       created_at, occurrence_no, {_LINE_KEY} AS line_key
FROM b WHERE NOT EXISTS (
  SELECT 1 FROM t WHERE t.account_code = b.account_code AND t.transaction_date = b.transaction_date
    AND t.journal_id = b.journal_id AND t.journal_number = b.journal_number
    AND t.amount = b.amount AND t.description = b.description AND t.occurrence_no = b.occurrence_no)"""


@register("insert_or_ignore_statements", NEW_LINES_SQL)
def q_insert_or_ignore_statements(spark, d):
    s = _stm(spark, d)
    target = s.where(F.col("transaction_date") < F.lit("1998-01-01").cast("date"))
    batch = s.where(F.col("transaction_date") >= F.lit("1997-07-01").cast("date"))
    return LD.load_range(target, batch, "1997-07-01", "2099-12-31")


def _load_log(spark, d):
    s = _stm(spark, d)
    log1 = LD.monthly_load_log(s, "incremental")
    rerun = LD.monthly_load_log(s.where(F.year("transaction_date") == 1998), "incremental",
                                at="2001-06-01 00:00:00")
    manual = LD.monthly_load_log(s.where(F.year("transaction_date") == 1999), "manual",
                                 at="2001-07-01 00:00:00")
    log = LD.insert_or_replace(log1, rerun, ["operation_type", "date_from", "date_to"],
                               ["load_timestamp"])
    return LD.insert_or_replace(log, manual, ["operation_type", "date_from", "date_to"],
                                ["load_timestamp"])


@register("load_history", """
SELECT operation_type, COUNT(*) AS load_count, CAST(SUM(records_loaded) AS BIGINT) AS total_records
FROM (SELECT 'incremental' AS operation_type, date_trunc('month', transaction_date) AS m, COUNT(*) AS records_loaded
      FROM silver_account_statements GROUP BY 2
      UNION ALL
      SELECT 'manual', date_trunc('month', transaction_date), COUNT(*)
      FROM silver_account_statements WHERE year(transaction_date) = 1999 GROUP BY 2) l
GROUP BY operation_type""")
def q_load_history(spark, d):
    return P.load_history(_load_log(spark, d))


@register("next_load_window", """
WITH last AS (SELECT strftime(last_day(MAX(transaction_date)), '%Y-%m-%d') AS last_to FROM silver_account_statements)
SELECT last_to AS date_from, '2002-01-15' AS date_to, last_to = '2002-01-15' AS skip FROM last""")
def q_next_load_window(spark, d):
    return LD.next_load_window(_load_log(spark, d), _stm(spark, d), "2002-01-15")


# --- fixed values: the configuration tables of the registered matching queries ---------------
PAYMENT_TYPES = [("pt-main", "Main account", "Checking", "2020-01-01", None),
                 ("pt-save", "Savings", "Savings", "2020-01-01", "ISK"),
                 ("pt-gbp", "GBP account", "Foreign", "2020-01-01", "GBP"),
                 ("pt-eur", "EUR account", "Foreign", "2020-01-01", "EUR")]
MATCH_RULES = [(1, "0100-26-000000", None, "pt-main"), (2, "0101-26-000001", None, "pt-save"),
               (3, None, "GBP", "pt-gbp"), (4, None, "EUR", "pt-eur")]
EXTRA_GROUPS = [("Gjöld", "Brand#13", "COGS", "Materials", "PL", 1),
                ("Gjöld", "Brand#22", "Depreciation", None, "PL", 1),
                ("Gjöld", "Brand#5", "Finance", None, "PL", 1)]
# -----------------------------------------------------------------------------------------------


def _sql_values(rows, cols):
    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return str(v)
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) v({', '.join(cols)})"


def _bank_accounts(spark, d):
    b = S.silver_bank_transactions(spark, d)
    return b.select(F.concat_ws("-", "branch", "ledger", "account_no").alias("account_number"),
                    "currency").distinct()


_BANK_ACCOUNTS_SQL = ("SELECT DISTINCT branch || '-' || ledger || '-' || account_no AS account_number, "
                      "currency FROM silver_bank_transactions")
_PT_SQL = _sql_values(PAYMENT_TYPES, ["id", "title", "description", "created", "currency"])
_RULES_SQL = _sql_values(MATCH_RULES, ["priority", "account_number", "currency", "payment_type_id"])


def _pt(spark):
    return config_table(spark, PAYMENT_TYPES, "id string, title string, description string, "
                                              "created string, currency string")


@register("match_accounts_by_rule", f"""
WITH acc AS ({_BANK_ACCOUNTS_SQL}), pt AS ({_PT_SQL}), rules AS ({_RULES_SQL}),
bn AS (SELECT account_number, arg_min(payment_type_id, priority) AS p FROM rules
       WHERE account_number IS NOT NULL GROUP BY 1),
bc AS (SELECT currency, arg_min(payment_type_id, priority) AS p FROM rules
       WHERE account_number IS NULL AND currency IS NOT NULL GROUP BY 1)
SELECT COALESCE(bn.p, bc.p) AS payment_type_id, acc.currency, acc.account_number,
       pt.title AS payment_type_title, pt.title IS NOT NULL AS matched
FROM acc LEFT JOIN bn ON acc.account_number = bn.account_number
LEFT JOIN bc ON acc.currency = bc.currency LEFT JOIN pt ON COALESCE(bn.p, bc.p) = pt.id""")
def q_match_accounts_by_rule(spark, d):
    rules = config_table(spark, MATCH_RULES, "priority int, account_number string, currency string, "
                                             "payment_type_id string")
    return M.match_accounts_by_rule(_bank_accounts(spark, d), rules, _pt(spark))


@register("match_accounts_by_currency", f"""
WITH acc AS ({_BANK_ACCOUNTS_SQL}), pt AS ({_PT_SQL})
SELECT acc.account_number, acc.currency, pt.id AS payment_type_id, pt.title AS payment_type_title
FROM acc LEFT JOIN pt ON acc.currency = COALESCE(pt.currency, 'ISK')""")
def q_match_accounts_by_currency(spark, d):
    return M.match_accounts_by_currency(_bank_accounts(spark, d), _pt(spark))


@register("orphan_lines", f"""
SELECT id, invoice_id, line_number, description, {D("quantity")} AS quantity,
       {D("unit_price")} AS unit_price, {D("discount_percent")} AS discount_percent,
       {D("vat_percent")} AS vat_percent, {D("vat_amount")} AS vat_amount,
       {D("line_total")} AS line_total, account_id, account_code, created_at
FROM dim_invoice_lines l
WHERE NOT EXISTS (SELECT 1 FROM dim_invoices i WHERE i.invoice_id = l.invoice_id AND i.is_active = 1)""")
def q_orphan_lines(spark, d):
    # FK check against the *active* invoices: lines of deactivated invoices are orphans here
    active = S.dim_invoices(spark, d).where(F.col("is_active") == 1)
    return M.orphan_lines(S.dim_invoice_lines(spark, d), active)


@register("orphan_statements", f"""
SELECT id, account_code, CAST(transaction_date AS VARCHAR) AS transaction_date, {D("amount")} AS amount
FROM silver_account_statements s
WHERE NOT EXISTS (SELECT 1 FROM dim_accounts a WHERE a.account_number = s.account_code AND a.is_active = 1)""")
def q_orphan_statements(spark, d):
    active = _acc(spark, d).where(F.col("is_active") == 1)
    return M.orphan_statements(_stm(spark, d), active).select(
        "id", "account_code", "transaction_date", "amount")


def _groups_rows():
    return M.default_account_group_rows() + EXTRA_GROUPS


def _groups(spark):
    return config_table(spark, _groups_rows(), M.GROUPS_SCHEMA)


# Typed by hand from the documented convention (revenue -1, expenses +1; balance-sheet classes
# positive on their normal side), so that it does not share the library's table.
_GROUPS_SQL = """SELECT * FROM (VALUES
  ('Tekjur', NULL, 'Revenue', NULL, 'PL', -1), ('Income', NULL, 'Revenue', NULL, 'PL', -1),
  ('Revenue', NULL, 'Revenue', NULL, 'PL', -1),
  ('Gjöld', NULL, 'Operating expenses', NULL, 'PL', 1),
  ('Expense', NULL, 'Operating expenses', NULL, 'PL', 1),
  ('Expenses', NULL, 'Operating expenses', NULL, 'PL', 1),
  ('Eignir', NULL, 'Assets', NULL, 'BS', 1), ('Asset', NULL, 'Assets', NULL, 'BS', 1),
  ('Assets', NULL, 'Assets', NULL, 'BS', 1),
  ('Skuldir', NULL, 'Liabilities', NULL, 'BS', -1),
  ('Liability', NULL, 'Liabilities', NULL, 'BS', -1),
  ('Liabilities', NULL, 'Liabilities', NULL, 'BS', -1),
  ('Eigið fé', NULL, 'Equity', NULL, 'BS', -1), ('Equity', NULL, 'Equity', NULL, 'BS', -1),
  ('Gjöld', 'Brand#13', 'COGS', 'Materials', 'PL', 1),
  ('Gjöld', 'Brand#22', 'Depreciation', NULL, 'PL', 1),
  ('Gjöld', 'Brand#5', 'Finance', NULL, 'PL', 1))
  v(acct_type, acct_subtype, report_group, report_subgroup, statement, sign)"""
_DIM_ACCOUNT_SQL = f"""grp AS ({_GROUPS_SQL}),
dim_account AS (
  SELECT a.*, COALESCE(e.report_group, t.report_group) AS report_group,
         COALESCE(e.report_subgroup, t.report_subgroup) AS report_subgroup,
         COALESCE(e.statement, t.statement) AS statement, COALESCE(e.sign, t.sign) AS sign
  FROM dim_accounts a
  LEFT JOIN (SELECT * FROM grp WHERE acct_subtype IS NOT NULL) e
    ON a.account_type = e.acct_type AND a.account_subtype = e.acct_subtype
  LEFT JOIN (SELECT * FROM grp WHERE acct_subtype IS NULL) t ON a.account_type = t.acct_type)"""
_FM_SQL = f"""{_DIM_ACCOUNT_SQL},
fm AS (
  SELECT strftime(s.transaction_date, '%Y-%m') AS month, s.account_code, s.account_name,
         d.account_type AS acct_type, d.account_subtype AS acct_subtype, d.report_group,
         d.report_subgroup, d.statement, d.sign, d.is_active, COUNT(*) AS transaction_count,
         SUM(s.debit) AS debit, SUM(s.credit) AS credit,
         COALESCE(d.sign, 1) * (SUM(s.debit) - SUM(s.credit)) AS report_amount
  FROM silver_account_statements s JOIN dim_account d ON s.account_code = d.account_number
  GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9, 10)"""


def _fm(spark, d, names=False):
    return MT.fact_month(_stm(spark, d), _acc(spark, d), _groups(spark), names)


@register("dim_account", f"""WITH {_DIM_ACCOUNT_SQL}
SELECT * REPLACE (CAST(sign AS DOUBLE) AS sign) FROM dim_account""")
def q_dim_account(spark, d):
    # sign is NULL for ungrouped accounts: presented as DOUBLE so NULLs compare alike
    return MT.dim_account(_acc(spark, d), _groups(spark)).withColumn(
        "sign", F.col("sign").cast("double"))


@register("v_account_detail", f"""WITH {_FM_SQL}
SELECT account_code, account_name, acct_type, acct_subtype, report_group, statement, is_active,
       CAST(SUM(transaction_count) AS BIGINT) AS transaction_count, {D("SUM(debit)")} AS total_debit,
       {D("SUM(credit)")} AS total_credit,
       {D("SUM(CASE WHEN statement = 'PL' THEN report_amount ELSE 0 END)")} AS pl_total,
       {D("SUM(CASE WHEN statement = 'BS' THEN report_amount ELSE 0 END)")} AS bs_total
FROM fm GROUP BY 1, 2, 3, 4, 5, 6, 7""")
def q_v_account_detail(spark, d):
    return MT.v_account_detail(_fm(spark, d, names=True))


@register("v_pl_month", f"""WITH {_FM_SQL}
SELECT month, report_group, report_subgroup, {D("SUM(report_amount)")} AS amount,
       CAST(SUM(transaction_count) AS BIGINT) AS transaction_count
FROM fm WHERE statement = 'PL' GROUP BY 1, 2, 3""")
def q_v_pl_month(spark, d):
    return MT.v_pl_month(_fm(spark, d))


@register("v_bs_month", f"""WITH {_FM_SQL},
m AS (SELECT month, report_group, SUM(report_amount) AS movement FROM fm WHERE statement = 'BS' GROUP BY 1, 2)
SELECT month, report_group, {D("movement")} AS movement,
       {D("SUM(movement) OVER (PARTITION BY report_group ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")} AS position
FROM m""")
def q_v_bs_month(spark, d):
    return MT.v_bs_month(_fm(spark, d))


@register("v_trial_balance_month", f"""WITH {_FM_SQL}
SELECT month, account_code, account_name, acct_type, {D("SUM(debit)")} AS total_debit,
       {D("SUM(credit)")} AS total_credit, {D("SUM(debit - credit)")} AS net
FROM fm GROUP BY 1, 2, 3, 4""")
def q_v_trial_balance_month(spark, d):
    return MT.v_trial_balance_month(_fm(spark, d, names=True))


def _kpi_sum(groups):
    names = ", ".join(f"'{g}'" for g in groups)
    return f"SUM(CASE WHEN report_group IN ({names}) THEN report_amount ELSE 0 END)"


@register("v_kpi_month", f"""WITH {_FM_SQL},
k AS (SELECT month, {_kpi_sum(MT.KPI_GROUPS["revenue"])} AS revenue, {_kpi_sum(MT.KPI_GROUPS["cogs"])} AS cogs,
             {_kpi_sum(MT.KPI_GROUPS["opex"])} AS opex, {_kpi_sum(MT.KPI_GROUPS["depreciation"])} AS depreciation,
             {_kpi_sum(MT.KPI_GROUPS["finance"])} AS finance, {_kpi_sum(MT.KPI_GROUPS["tax"])} AS tax
      FROM fm WHERE statement = 'PL' GROUP BY month)
SELECT month, {D("revenue")} AS revenue, {D("revenue - cogs")} AS gross_profit,
       {D("revenue - cogs - opex")} AS ebitda, {D("revenue - cogs - opex - depreciation")} AS ebit,
       {D("revenue - cogs - opex - depreciation - finance - tax")} AS net_income,
       CASE WHEN revenue <> 0 THEN CAST(revenue - cogs AS DOUBLE) / CAST(revenue AS DOUBLE) * 100.0 END AS gross_margin_pct,
       CASE WHEN revenue <> 0 THEN CAST(revenue - cogs - opex AS DOUBLE) / CAST(revenue AS DOUBLE) * 100.0 END AS ebitda_margin_pct
FROM k""")
def q_v_kpi_month(spark, d):
    return MT.v_kpi_month(_fm(spark, d))


_CLASS_SQL = """CASE WHEN acct_type IN ('Tekjur', 'Income', 'Revenue') THEN 'revenue'
              WHEN acct_type IN ('Gjöld', 'Expense', 'Cost') THEN 'expense'
              WHEN acct_type IN ('Eignir', 'Asset') THEN 'asset'
              WHEN acct_type IN ('Skuldir', 'Liability') THEN 'liability'
              WHEN acct_type IN ('Eigið fé', 'Equity') THEN 'equity' ELSE 'other' END"""


@register("v_monthly_summary", f"""WITH {_FM_SQL}
SELECT month,
       {D(f"SUM(CASE WHEN {_CLASS_SQL} = 'revenue' THEN report_amount ELSE 0 END)")} AS total_revenue,
       {D(f"SUM(CASE WHEN {_CLASS_SQL} = 'expense' THEN report_amount ELSE 0 END)")} AS total_expenses,
       {D(f"SUM(CASE WHEN {_CLASS_SQL} = 'asset' THEN report_amount ELSE 0 END)")} AS total_assets,
       {D(f"SUM(CASE WHEN {_CLASS_SQL} = 'liability' THEN report_amount ELSE 0 END)")} AS total_liabilities,
       COUNT(DISTINCT account_code) AS active_accounts,
       CAST(SUM(transaction_count) AS BIGINT) AS total_transactions
FROM fm GROUP BY month""")
def q_v_monthly_summary(spark, d):
    return MT.v_monthly_summary(_fm(spark, d))


def _reconcile_sql(tolerance: int) -> str:
    """Row by row: each pass ranks what is left on both sides and joins equal ranks."""
    ctes = ["b0 AS MATERIALIZED (SELECT payment_id AS id, amount, date FROM payments)",
            "d0 AS MATERIALIZED (SELECT invoice_id AS id, total AS amount, due_date AS date "
            "FROM dim_invoices)"]
    offsets = [0] + [s * k for k in range(1, tolerance + 1) for s in (1, -1)]
    for k, off in enumerate(offsets):
        rank = "row_number() OVER (PARTITION BY amount, date ORDER BY id) AS r"
        ctes += [f"""m{k} AS MATERIALIZED (
  SELECT x.id AS bank_id, y.id AS document_id, x.amount, x.date AS bank_date,
         y.date AS document_date, {abs(off)} AS days_apart
  FROM (SELECT *, {rank} FROM b{k}) x JOIN (SELECT *, {rank} FROM d{k}) y
    ON x.amount = y.amount AND y.date = x.date + {off} AND x.r = y.r)""",
                 f"b{k + 1} AS MATERIALIZED (SELECT * FROM b{k} ANTI JOIN m{k} ON b{k}.id = bank_id)",
                 f"d{k + 1} AS MATERIALIZED (SELECT * FROM d{k} ANTI JOIN m{k} ON d{k}.id = document_id)"]
    body = " UNION ALL ".join(f"SELECT * FROM m{k}" for k in range(len(offsets)))
    return f"""WITH {", ".join(ctes)}
SELECT bank_id, document_id, CAST(amount AS DOUBLE) AS amount, CAST(bank_date AS VARCHAR) AS bank_date,
       CAST(document_date AS VARCHAR) AS document_date, CAST(days_apart AS INTEGER) AS days_apart
FROM ({body}) m"""


@register("reconcile_payments", _reconcile_sql(15))
def q_reconcile_payments(spark, d):
    pay = S.payments(spark, d).select(F.col("payment_id").alias("id"), "amount", "date")
    inv = S.dim_invoices(spark, d).select(F.col("invoice_id").alias("id"),
                                          F.col("total").alias("amount"),
                                          F.col("due_date").alias("date"))
    return M.reconcile_bank(pay, inv, 15)


LATER = 1_000_000_000               # added to the sequence number of later updates


def _updates(spark, d):
    i = S.dim_invoices(spark, d)
    mode = (F.when(F.col("status") == "SENT", F.lit("mark_as_paid"))
            .when(F.col("status") == "DRAFT", F.lit("update_draft"))
            .when(F.col("status") == "CREDIT", F.lit("resend_email"))
            .when(F.col("status") == "CANCELLED", F.lit("mark_as_paid")))
    return i.where(F.col("status").isin("SENT", "DRAFT", "CREDIT", "CANCELLED")).select(
        F.col("invoice_number").cast("bigint").alias("seq"),
        F.col("invoice_number").alias("invoice_ref"), mode.alias("mode"),
        F.lit(None).cast("string").alias("status"),
        F.when(F.col("status") == "SENT", F.date_format("due_date", "yyyy-MM-dd")).alias("paid_date"),
        F.when(F.col("status") == "SENT", F.lit("transfer")).alias("payment_type"),
        F.lit(None).cast("map<string,string>").alias("draft_data")).unionByName(
        # a second update of the same invoices, one by its UUID, and references without invoice
        i.where(F.col("status").isin("SENT", "DRAFT")).select(
            (F.col("invoice_number").cast("bigint") + LATER).alias("seq"),
            F.when(F.col("status") == "DRAFT", F.concat(F.lit("missing-"), "invoice_number"))
            .otherwise(F.col("invoice_number")).alias("invoice_ref"),
            F.lit("cancel_claim").alias("mode"), F.lit(None).cast("string").alias("status"),
            F.lit(None).cast("string").alias("paid_date"),
            F.lit(None).cast("string").alias("payment_type"),
            F.lit(None).cast("map<string,string>").alias("draft_data"))).unionByName(
        i.where("status = 'DRAFT'").select(
            (F.col("invoice_number").cast("bigint") + 2 * LATER).alias("seq"),
            F.col("invoice_number").alias("invoice_ref"), F.lit("update_draft").alias("mode"),
            F.lit(None).cast("string").alias("status"),
            F.lit(None).cast("string").alias("paid_date"),
            F.lit(None).cast("string").alias("payment_type"),
            F.create_map(F.lit("reference"), F.concat(F.lit("amended "), "invoice_number"))
            .alias("draft_data")))


_UPD_SQL = """upd AS (
  SELECT CAST(invoice_number AS BIGINT) AS seq, invoice_number AS invoice_ref, invoice_id,
         CASE status WHEN 'SENT' THEN 'mark_as_paid' WHEN 'DRAFT' THEN 'update_draft'
                     WHEN 'CREDIT' THEN 'resend_email' WHEN 'CANCELLED' THEN 'mark_as_paid' END AS mode,
         CASE WHEN status = 'SENT' THEN CAST(due_date AS VARCHAR) END AS paid_date,
         CASE WHEN status = 'SENT' THEN 'transfer' END AS payment_type,
         CAST(NULL AS VARCHAR) AS amended
  FROM dim_invoices WHERE status IN ('SENT', 'DRAFT', 'CREDIT', 'CANCELLED')
  UNION ALL
  SELECT CAST(invoice_number AS BIGINT) + 1000000000,
         CASE WHEN status = 'DRAFT' THEN 'missing-' || invoice_number ELSE invoice_number END,
         CASE WHEN status = 'SENT' THEN invoice_id END, 'cancel_claim', NULL, NULL, NULL
  FROM dim_invoices WHERE status IN ('SENT', 'DRAFT')
  UNION ALL
  SELECT CAST(invoice_number AS BIGINT) + 2000000000, invoice_number, invoice_id, 'update_draft',
         NULL, NULL, 'amended ' || invoice_number
  FROM dim_invoices WHERE status = 'DRAFT'),
res AS (
  SELECT *, CASE WHEN invoice_id IS NULL THEN 'NOT_FOUND'
                 WHEN mode = 'mark_as_paid' AND COALESCE(payment_type, '') = ''
                   THEN 'VALIDATION_ERROR: mark_as_paid needs a payment type'
                 WHEN mode = 'update_draft' AND amended IS NULL THEN 'VALIDATION_ERROR: update_draft needs draft data'
            END AS error FROM upd)"""


@register("apply_invoice_updates_results", f"""WITH {_UPD_SQL}
SELECT seq, invoice_ref, invoice_id, mode,
       CASE WHEN error IS NULL THEN 'OK' ELSE split_part(error, ':', 1) END AS outcome,
       error AS message FROM res""")
def q_apply_invoice_updates_results(spark, d):
    return WB.apply_invoice_updates(S.dim_invoices(spark, d), _updates(spark, d),
                                    "2002-01-01T00:00:00Z")[1]


@register("apply_invoice_updates", f"""WITH {_UPD_SQL},
ok AS (SELECT invoice_id, MAX(CASE mode WHEN 'mark_as_paid' THEN 'PAID' WHEN 'resend_email' THEN 'SENT' END) AS new_status,
              MAX(CASE WHEN mode = 'mark_as_paid' THEN
                CASE WHEN paid_date IS NULL OR trim(paid_date) = '' THEN '2002-01-01T00:00:00Z'
                     WHEN regexp_matches(paid_date, '^\\d{{4}}-\\d{{2}}-\\d{{2}}$') THEN paid_date || 'T12:00:00Z'
                     ELSE paid_date END END) AS new_paid, MAX(payment_type) AS new_ptype,
              MAX(amended) AS amended, bool_or(mode = 'cancel_claim') AS claim
       FROM res WHERE error IS NULL GROUP BY invoice_id)
SELECT i.invoice_id, invoice_number, customer_id, COALESCE(new_status, status) AS status, currency,
       {D("subtotal")} AS subtotal, {D("vat_amount")} AS vat_amount, {D("total")} AS total,
       CAST(invoice_date AS VARCHAR) AS invoice_date, CAST(due_date AS VARCHAR) AS due_date,
       CAST(final_due_date AS VARCHAR) AS final_due_date, COALESCE(new_paid, paid_date) AS paid_date,
       COALESCE(new_ptype, payment_type) AS payment_type, description,
       COALESCE(amended, reference) AS reference, is_active,
       created_at, updated_at, COALESCE(claim, false) AS claim_cancelled, false AS payment_extended
FROM dim_invoices i LEFT JOIN ok ON i.invoice_id = ok.invoice_id""")
def q_apply_invoice_updates(spark, d):
    return WB.apply_invoice_updates(S.dim_invoices(spark, d), _updates(spark, d),
                                    "2002-01-01T00:00:00Z")[0]


@register("dim_date", """
WITH b AS (SELECT MIN(transaction_date) AS lo, MAX(transaction_date) AS hi FROM silver_account_statements),
days AS (SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d FROM b)
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS VARCHAR) AS date,
       CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
       CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name,
       CAST(weekofyear(d) AS INTEGER) AS week, CAST(day(d) AS INTEGER) AS day_of_month,
       CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, dayname(d) AS day_name,
       CASE WHEN dayofweek(d) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
       CAST(NULL AS DOUBLE) AS is_holiday
FROM days""")
def q_dim_date(spark, d):
    # is_holiday is always NULL (no holiday calendar): presented as DOUBLE like the oracle
    return DM.dim_date_for(_stm(spark, d), "transaction_date").withColumn(
        "is_holiday", F.col("is_holiday").cast("double"))


@register("sales_orders", f"""
SELECT i.*, l.id AS line_id, CAST(l.line_number AS DOUBLE) AS line_line_number,
       l.description AS line_description, {D("l.quantity")} AS line_quantity,
       {D("l.unit_price")} AS line_unit_price, {D("l.discount_percent")} AS line_discount_percent,
       {D("l.vat_percent")} AS line_vat_percent, {D("l.vat_amount")} AS line_vat_amount,
       {D("l.line_total")} AS line_line_total, l.account_id AS line_account_id,
       l.account_code AS line_account_code, l.created_at AS line_created_at
FROM (SELECT {_INV_COLS} FROM dim_invoices) i
LEFT JOIN dim_invoice_lines l ON i.invoice_id = l.invoice_id""")
def q_sales_orders(spark, d):
    return _nullable_ints_as_double(
        search.sales_orders(S.dim_invoices(spark, d), S.dim_invoice_lines(spark, d), True))


_STM_COLS_SQL = ("s.id, s.account_code, s.account_name, CAST(s.transaction_date AS VARCHAR) AS transaction_date, "
                 "s.description, {a} AS amount, {d} AS debit, {c} AS credit").format(
    a=D("s.amount"), d=D("s.debit"), c=D("s.credit"))


@register("facts_with_account", f"""
SELECT {_STM_COLS_SQL}, a.account_type AS dim_account_type, a.account_subtype AS dim_account_subtype
FROM silver_account_statements s JOIN dim_accounts a ON s.account_code = a.account_number""")
def q_facts_with_account(spark, d):
    f = ledger.facts_with_account(_stm(spark, d), _acc(spark, d))
    return f.select("id", "account_code", "account_name", "transaction_date", "description", "amount",
                    "debit", "credit", "dim_account_type", "dim_account_subtype")


@register("fact_txn", f"""WITH {_DIM_ACCOUNT_SQL}
SELECT {_STM_COLS_SQL}, d.account_type AS acct_type, d.report_group, d.statement,
       CAST(d.sign AS DOUBLE) AS sign, strftime(s.transaction_date, '%Y-%m') AS month,
       {D("COALESCE(d.sign, 1) * (s.debit - s.credit)")} AS report_amount
FROM silver_account_statements s JOIN dim_account d ON s.account_code = d.account_number""")
def q_fact_txn(spark, d):
    f = MT.fact_txn(_stm(spark, d), _acc(spark, d), _groups(spark))
    return f.select("id", "account_code", "account_name", "transaction_date", "description", "amount",
                    "debit", "credit", "acct_type", "report_group", "statement",
                    F.col("sign").cast("double").alias("sign"), "month", "report_amount")


from . import queries_loads, queries_sources  # noqa: E402,F401  (they register more queries)
