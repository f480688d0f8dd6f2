"""Gold views: hand-computed sign conventions and properties."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from conftest import SF
from ledgerspark import standins as S
from ledgerspark.plans import bank, invoice, ledger, marts
from ledgerspark.operators import matching as M

D = dt.date(2024, 3, 5)


def _stm(spark, rows):
    return spark.createDataFrame(
        [(f"s{i}", code, name, typ, "", D, Decimal(debit), Decimal(credit), Decimal(credit) - Decimal(debit),
          Decimal("0"))
         for i, (code, name, typ, debit, credit) in enumerate(rows)],
        "id string, account_code string, account_name string, account_type string, account_subtype string, "
        "transaction_date date, debit decimal(18,2), credit decimal(18,2), amount decimal(18,2), "
        "balance decimal(18,2)")


def _acc(spark, rows):
    return spark.createDataFrame([(c, c, n, t, "sub", None, 1, None, None) for c, n, t in rows],
                                 "account_id string, account_number string, account_name string, "
                                 "account_type string, account_subtype string, parent_account_id string, "
                                 "is_active int, created_at string, updated_at string")


def test_conventions_a_and_b(spark):
    stm = _stm(spark, [("1", "Sala", "Tekjur", "0", "100"), ("2", "Rent", "Gjöld", "40", "0"),
                       ("3", "Bank", "Eignir", "70", "10"), ("4", "Loan", "Skuldir", "0", "30"),
                       ("9", "Unknown", "", "5", "0")])
    acc = _acc(spark, [("1", "Sala", "Tekjur"), ("2", "Rent", "Gjöld"), ("3", "Bank", "Eignir"),
                       ("4", "Loan", "Skuldir")])
    a = {r.account_type: (r.revenue, r.expenses) for r in ledger.gold_monthly_pl(stm, "2024-01-01").collect()}
    assert a["Tekjur"] == (Decimal("100.00"), Decimal("0.00"))        # A: credit - debit
    assert a["Gjöld"] == (Decimal("0.00"), Decimal("40.00"))
    b = {r.account_code: r.balance for r in ledger.gold_account_summary_by_year(stm, acc, "2024-01-01").collect()}
    assert b == {"1": Decimal("-100.00"), "2": Decimal("-40.00"), "3": Decimal("60.00"), "4": Decimal("30.00")}
    assert "9" not in b                                                  # unknown account dropped (D1)
    inc = ledger.gold_income_summary_by_year(stm, acc, "2024-01-01").first()
    assert (inc.total_revenue, inc.total_expenses, inc.net_income) == (
        Decimal("-100.00"), Decimal("-40.00"), Decimal("-60.00"))
    bs = {r.account_code: r.balance for r in ledger.gold_balance_sheet(stm, "2024-01-01").collect()}
    assert bs["3"] == Decimal("60.00") and bs["4"] == Decimal("30.00") and bs["1"] == Decimal("0.00")


def test_income_summary_is_rollup_of_by_year(spark):
    stm, acc = S.silver_account_statements(spark, SF), S.dim_accounts(spark, SF)
    by_year = ledger.gold_income_statement_by_year(stm, acc, "1995-01-01").withColumn(
        "rev", F.when(F.col("account_type") == "Tekjur", F.col("amount")).otherwise(0)).withColumn(
        "exp", F.when(F.col("account_type") == "Gjöld", F.col("amount")).otherwise(0))
    roll = {r.year: (r.r, r.e) for r in by_year.groupBy("year").agg(F.sum("rev").alias("r"),
                                                                  F.sum("exp").alias("e")).collect()}
    summ = {r.year: (r.total_revenue, r.total_expenses)
            for r in ledger.gold_income_summary_by_year(stm, acc, "1995-01-01").collect()}
    assert roll == summ


def test_debit_minus_credit_is_minus_amount_and_daily_total(spark):
    stm = S.silver_account_statements(spark, SF)
    r = stm.agg(F.sum("debit").alias("d"), F.sum("credit").alias("c"), F.sum("amount").alias("a"),
                F.count(F.lit(1)).alias("n")).first()
    assert r.d - r.c == -r.a
    daily = ledger.gold_daily_transactions(stm).agg(F.sum("transaction_count").alias("n"),
                                                    F.sum("net_flow").alias("net")).first()
    assert daily.n == r.n and daily.net == r.c - r.d


def test_eager_aggregation_equals_join_then_aggregate_with_duplicate_chart_rows(spark):
    stm = _stm(spark, [("1", "Sala", "", "0", "100"), ("1", "Sala", "", "0", "50")])
    acc = _acc(spark, [("1", "Sala", "Tekjur"), ("1", "Sala", "Tekjur")])     # duplicated account
    pre = ledger.gold_account_summary_by_year(stm, acc, None).first()
    naive = (ledger.facts_with_account(stm, acc).groupBy("account_code")
             .agg(F.count(F.lit(1)).alias("n"), F.sum("credit").alias("c")).first())
    assert (pre.transaction_count, pre.total_credit) == (naive.n, naive.c) == (4, Decimal("300.00"))


def test_bank_and_card_monthly(spark):
    b = S.silver_bank_transactions(spark, SF)
    g = bank.gold_bank_monthly(b).agg(F.sum("inflow").alias("i"), F.sum("outflow").alias("o"),
                                      F.sum("net").alias("n")).first()
    assert g.i - g.o == g.n
    c = bank.gold_card_monthly(S.silver_card_transactions(spark, SF)).agg(F.sum("withdrawals")).first()[0]
    assert c > 0                                             # withdrawals are no longer always 0


def test_invoice_views(spark):
    inv = S.dim_invoices(spark, SF)
    s = invoice.gold_invoice_summary(inv, "1998-08-01")
    statuses = {r.status_display for r in s.select("status_display").distinct().collect()}
    assert statuses == {"Paid", "Unpaid", "Draft", "Cancelled", "Credit Note"}
    assert {r.payment_status for r in s.where("status = 'SENT'").select("payment_status").distinct().collect()} \
        <= {"Overdue", "Due"}
    m = invoice.gold_invoice_monthly(inv).agg(F.sum("invoice_count")).first()[0]
    assert m == inv.where("is_active = 1").count()


def test_marts_kpi_consistency(spark):
    stm, acc = S.silver_account_statements(spark, SF), S.dim_accounts(spark, SF)
    fm = marts.fact_month(stm, acc, M.default_account_groups(spark))
    k = marts.v_kpi_month(fm).where("revenue <> 0").first()
    assert abs(k.gross_margin_pct - float(k.gross_profit) / float(k.revenue) * 100) < 1e-9
    rows = marts.fact_txn(stm, acc, M.default_account_groups(spark)).count()
    assert fm.agg(F.sum("transaction_count")).first()[0] == rows
