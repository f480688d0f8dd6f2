"""Plan shapes that the scale design relies on (read from ``explain``)."""

import io
import tempfile
from contextlib import redirect_stdout

import pytest

import fixtures

import __spark_entry__ as E
from conftest import SF
from ledgerspark import standins as S
from ledgerspark.operators import reports as R
from ledgerspark.operators import search
from ledgerspark.plans import ledger
from ledgerspark.sources import sheets, statement_xml as X


def plan(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


@pytest.fixture()
def whole_filters(spark):
    """Plans that show every filter of a scan, however many."""
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


@pytest.fixture()
def silver(spark):
    """Silver tables (typed columns), as a deployment reads them; cleared afterwards."""
    S.materialize(spark, SF, tempfile.mkdtemp(prefix="plans-silver-"),
                  ["silver_account_statements", "dim_accounts"], partition_by="month")
    yield
    S.forget_materialized()


def test_date_filter_pushed_and_fact_aggregated_before_join(spark, silver):
    p = plan(ledger.gold_account_summary_by_year(S.silver_account_statements(spark, SF),
                                                 S.dim_accounts(spark, SF), "1996-01-01"))
    assert "GreaterThanOrEqual(transaction_date,1996-01-01)" in p
    # partial aggregation of the fact side sits below the join with the chart
    join_at = min(i for i in (p.find("BroadcastHashJoin"), p.find("SortMergeJoin")) if i >= 0)
    assert "partial_count" in p[join_at:] and "partial_sum" in p[join_at:]


def test_type_filter_reaches_chart_scan(spark, silver):
    p = plan(ledger.gold_income_summary_by_year(S.silver_account_statements(spark, SF),
                                                S.dim_accounts(spark, SF), "1995-01-01"))
    assert "PushedFilters: [In(account_type" in p


def test_per_group_top_k_limits_before_shuffle(spark):
    p = plan(R.frequent_descriptions(R.account_lines_from_bank(S.silver_bank_transactions(spark, SF))))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_global_top_k_is_bounded_heap(spark):
    p = plan(E.queries()["top_expenses"](spark, SF))
    assert "TakeOrderedAndProject" in p


def test_bank_transactions_sides_are_top_k(spark):
    p = plan(search.bank_transactions(S.silver_bank_transactions(spark, SF),
                                      S.silver_card_transactions(spark, SF), limit=100))
    assert p.count("TakeOrderedAndProject") >= 2


def test_config_tables_are_broadcast(spark):
    p = plan(E.queries()["match_accounts_by_rule"](spark, SF))
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p
    p = plan(E.queries()["v_kpi_month"](spark, SF))
    assert "SortMergeJoin" not in p


def test_sources_do_not_shuffle(spark, scratch):
    fixtures.write_sheet_csv(scratch + "/sheets")
    fixtures.write_bank_tree(scratch + "/raw")
    assert "Exchange" not in plan(sheets.statement_sheet_source(spark, scratch + "/sheets"))
    assert "Exchange" not in plan(sheets.sheet_currency(spark, scratch + "/sheets"))
    assert "Exchange" not in plan(X.bank_xml_source(spark, scratch + "/raw/accounts"))


def test_no_python_udfs_anywhere(spark):
    for name, fn in E.queries().items():
        p = plan(fn(spark, SF))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_bucketed_invoice_tables_join_without_exchange(spark):
    from ledgerspark.plans import invoice
    from ledgerspark.sources import sinks
    sinks.write_bucketed(S.dim_invoices(spark, SF), "b_invoices", ["invoice_id"], 8)
    sinks.write_bucketed(S.dim_invoice_lines(spark, SF), "b_invoice_lines", ["invoice_id"], 8)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # force the large-large path
    try:
        df = invoice.gold_invoice_lines(spark.table("b_invoice_lines"), spark.table("b_invoices"),
                                        "1998-08-01")
        p = plan(df)
        n = df.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" in p and "Exchange" not in p
    expected = invoice.gold_invoice_lines(S.dim_invoice_lines(spark, SF), S.dim_invoices(spark, SF),
                                          "1998-08-01").count()
    assert n == expected


def test_bucketed_ledger_facts_and_chart(spark):
    from ledgerspark.sources import sinks
    sinks.write_bucketed(S.silver_account_statements(spark, SF), "b_statements", ["account_code"], 8)
    sinks.write_bucketed(S.dim_accounts(spark, SF), "b_accounts", ["account_number"], 8)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # force the large-large path
    try:
        rows = ledger.facts_with_account(spark.table("b_statements"), spark.table("b_accounts"))
        p_rows = plan(rows)
        by_year = ledger.gold_account_summary_by_year(spark.table("b_statements"),
                                                      spark.table("b_accounts"), "1995-01-01")
        p_year = plan(by_year)
        n = by_year.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "Exchange" not in p_rows                      # row-level fact x chart join co-located
    # per-account pre-aggregation and the chart join both run on the buckets: no exchange
    # below the join (only the final small re-aggregation above it may shuffle)
    join_at = p_year.find("SortMergeJoin")
    assert join_at >= 0 and "Exchange" not in p_year[join_at:]
    assert n == ledger.gold_account_summary_by_year(S.silver_account_statements(spark, SF),
                                                    S.dim_accounts(spark, SF), "1995-01-01").count()


def test_month_and_year_parameters_are_date_bounds_of_the_scan(spark, scratch, whole_filters):
    from ledgerspark.operators import loading as LD
    from ledgerspark.plans import analytics as A
    path = scratch + "/stm"
    S.silver_account_statements(spark, SF).write.parquet(path)
    stm, acc = spark.read.parquet(path), S.dim_accounts(spark, SF)
    for df, low, high in (
            (A.monthly_revenue_trend_of(stm, "1996-02"), "1996-02-01", None),
            (A.expense_categories_of(stm, "1996-02", "1996-12"), "1996-02-01", "1997-01-01"),
            (A.monthly_trend_overview_of(stm, acc, "1996"), "1996-01-01", "1997-01-01"),
            (A.annual_report_detail_of(stm, acc, "Eignir", "1996"), "1996-01-01", "1997-01-01"),
            (LD.load_range(stm, stm, "1996-01-01", "1996-02-01"), "1996-01-01", None)):
        pushed = plan(df)
        assert f"GreaterThanOrEqual(transaction_date,{low})" in pushed
        assert high is None or f"LessThan(transaction_date,{high})" in pushed
    created = plan(search.account_statement(stm, created_from="1996-01-01", created_to="1996-01-31"))
    assert "GreaterThanOrEqual(created_at,1996-01-01)" in created
    assert "LessThan(created_at,1996-02-01)" in created


def test_year_over_year_reads_the_lines_once(spark):
    p = plan(R.year_over_year(S.dim_accounts(spark, SF), S.silver_account_statements(spark, SF),
                              "1996", "1997"))
    assert p.count("l_extendedprice") and p.count("lineitem.parquet") == 1


def test_date_bounds_prune_month_folders(spark, scratch, whole_filters):
    from ledgerspark.plans import analytics as A
    from ledgerspark.sources import sinks
    path, acc = scratch + "/silver", S.dim_accounts(spark, SF)
    sinks.write_silver(S.silver_account_statements(spark, SF), path, "transaction_date",
                       ["account_code"])
    whole = sinks.read_silver(spark, path)

    def months(df):
        return " ".join(x.split("]")[0] for x in plan(df).split("PartitionFilters: [")[1:])
    for low, high, report in (
            ("1996-01-01", None, lambda s: ledger.gold_account_summary_by_year(s, acc, "1996-01-01")),
            ("1996-01-01", "1996-12-31", lambda s: A.top_expenses(s, "", "1996", 5)),
            ("1996-01-01", "1996-12-31", lambda s: R.income_statement(acc, s, "1996")[0])):
        cut = sinks.read_silver(spark, path, "transaction_date", low, high)
        assert cut.columns == whole.columns
        assert "month" in months(report(cut)) and "1996-01" in months(report(cut))
        assert sorted(report(cut).collect(), key=repr) == sorted(report(whole).collect(), key=repr)
    odd = sinks.read_silver(spark, path, "transaction_date", "1996-01-15", "1996-03-02")
    assert odd.count() == whole.where("transaction_date BETWEEN '1996-01-15' AND '1996-03-02'").count()


def test_files_follow_bytes(spark):
    from ledgerspark.sources import sinks
    mb = 1 << 20
    assert sinks.file_count(10 * mb, 8) == 2 and sinks.file_count(0, 8) == 1
    assert sinks.file_count(100 * mb, 8) == 8                  # enough writers, no tiny files
    assert sinks.file_count(100_000 * mb, 8) == 782
    small = S.silver_account_statements(spark, SF)
    assert sinks.planned_bytes(small) < 8 * mb
