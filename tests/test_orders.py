"""Documented order of the views; account groups read from a file."""

import fixtures
import pytest
from conftest import SF

from ledgerspark import standins as S
from ledgerspark.operators import matching as M
from ledgerspark.plans import invoice, ledger, profiles
from ledgerspark.plans.orders import ORDERS, in_documented_order


def _views(spark):
    stm, acc, inv = (f(spark, SF) for f in (S.silver_account_statements, S.dim_accounts, S.dim_invoices))
    since = "1995-01-01"
    return {name: view(stm, acc, since) for name, view in (
        (f.__name__, f) for f in (
            ledger.gold_account_summary_by_year, ledger.gold_income_statement_by_year,
            ledger.gold_balance_sheet_by_year, ledger.gold_income_summary_by_year,
            ledger.gold_balance_summary_by_year, ledger.gold_monthly_pl_trend))} | {
        "gold_chart_of_accounts": ledger.gold_chart_of_accounts(acc),
        "gold_invoice_monthly": invoice.gold_invoice_monthly(inv),
        "gold_customer_invoices": invoice.gold_customer_invoices(inv),
        "invoice_status_stats": profiles.invoice_status_stats(inv)}


def test_views_come_in_their_documented_order(spark):
    views = _views(spark)
    assert views.keys() == ORDERS.keys()
    for name, df in views.items():
        rows = in_documented_order(name, df).collect()
        by, ties = ORDERS[name]
        want = list(rows)
        for c in reversed(by + [t for t in ties if t in df.columns]):      # stable, last key first
            want.sort(key=lambda r, c=c: r[c.lstrip("-")], reverse=c[0] == "-")
        assert rows == want and len(rows) == df.count()
    with pytest.raises(ValueError):
        in_documented_order("nothing", views["gold_chart_of_accounts"])


def test_account_groups_of_a_file(spark, scratch):
    head = "acct_type,acct_subtype,report_group,report_subgroup,statement,sign\n"
    fixtures.write(scratch + "/groups.csv", head + "Tekjur,,Revenue,Operating,PL,-1\n"
                   "Gjöld,Laun,OPEX,Payroll,PL,1\nGjöld, ,Other costs,,PL,1\n")
    groups = M.account_groups_from_csv(spark, scratch + "/groups.csv")
    accounts = spark.createDataFrame([("Tekjur", "x"), ("Gjöld", "Laun"), ("Gjöld", "y"), ("Eignir", "")],
                                     "account_type string, account_subtype string")
    got = {(r.account_type, r.account_subtype): (r.report_group, r.report_subgroup, r.sign)
           for r in M.account_groups_join(accounts, groups).collect()}
    assert got == {("Tekjur", "x"): ("Revenue", "Operating", -1), ("Gjöld", "Laun"): ("OPEX", "Payroll", 1),
                   ("Gjöld", "y"): ("Other costs", None, 1), ("Eignir", ""): (None, None, None)}
    for bad in ("Tekjur,,Revenue,,XX,1\n", "Tekjur,,Revenue,,PL,2\n", ",,Revenue,,PL,1\n"):
        fixtures.write(scratch + "/bad.csv", head + bad)
        with pytest.raises(ValueError):
            M.account_groups_from_csv(spark, scratch + "/bad.csv")
