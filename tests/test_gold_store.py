"""The persisted gold layer: refreshed months equal the views over all statement lines."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerspark.operators import loading as LD
from ledgerspark.plans import gold_store as G
from ledgerspark.plans import ledger as L
from ledgerspark.plans import marts as M
from ledgerspark.sources import sinks

STM = ("id string, account_code string, account_name string, transaction_date date, "
       "debit decimal(18,2), credit decimal(18,2), balance decimal(18,2)")
ACC = ("account_id string, account_number string, account_name string, account_type string, "
       "account_subtype string, is_active int")


def lines(spark, seed, n, months=range(1, 13), year=2023):
    r = random.Random(seed)
    return spark.createDataFrame([
        (f"{seed}-{i}", str(1000 * r.randrange(1, 5)), r.choice(["a", "b"]),
         dt.date(year, r.choice(list(months)), r.randrange(1, 29)) if r.random() > 0.02 else None,
         Decimal(r.randrange(500)), Decimal(r.randrange(500)), Decimal(r.randrange(-99, 99)))
        for i in range(n)], STM)


@pytest.fixture()
def accounts(spark):
    types = ["Tekjur", "Gjöld", "Eignir", "Skuldir"]
    return spark.createDataFrame([(str(i), str(1000 * (i + 1)), f"n{i}", t, "s", 1)
                                  for i, t in enumerate(types)], ACC)


def groups(spark):
    return spark.createDataFrame(
        [("Tekjur", None, "Revenue", None, "PL", -1), ("Gjöld", None, "OPEX", None, "PL", 1),
         ("Eignir", None, "Assets", None, "BS", 1), ("Skuldir", None, "Liabilities", None, "BS", -1)],
        "acct_type string, acct_subtype string, report_group string, report_subgroup string, "
        "statement string, sign int")


def rows(df):
    return sorted(tuple(str(v) for v in r) for r in df.collect())


def same(spark, gold, statements, accounts):
    dated = statements.where("transaction_date IS NOT NULL")
    monthly = gold.where(F.col("month") != G.UNKNOWN)
    for since in (None, "2023-04-01"):
        for view in (L.gold_account_summary_by_year, L.gold_income_statement_by_year,
                     L.gold_balance_sheet_by_year, L.gold_income_summary_by_year,
                     L.gold_balance_summary_by_year, L.gold_monthly_pl_trend):
            assert rows(view(monthly, accounts, since)) == rows(view(dated, accounts, since))
    assert rows(L.gold_monthly_balances(monthly)) == rows(L.gold_monthly_balances(dated))
    fact, facts = (M.fact_month(x, accounts, groups(spark)) for x in (monthly, dated))
    for mart in (M.v_pl_month, M.v_bs_month, M.v_trial_balance_month, M.v_kpi_month,
                 M.v_monthly_summary, M.v_account_detail):
        assert rows(mart(fact)) == rows(mart(facts))


def test_refreshed_equals_recomputed(spark, scratch, accounts):
    path = f"{scratch}/gold"
    old = lines(spark, 1, 300)
    G.write_gold(old, path)
    same(spark, G.read_gold(spark, path), old, accounts)
    # inserts into two months and one new month
    new = lines(spark, 2, 80, months=[3, 4]).unionByName(lines(spark, 3, 9, [1], 2024))
    both = old.unionByName(new)
    G.refresh_gold(both, path, G.touched_months(new))
    same(spark, G.read_gold(spark, path), both, accounts)
    assert rows(G.read_gold(spark, path)) == rows(G.monthly_sums(both))
    # replacements: one line changes its month, a month loses all its lines
    changed = both.withColumn("transaction_date", F.when(
        F.month("transaction_date") == 7, F.add_months("transaction_date", 1))
        .otherwise(F.col("transaction_date")))
    for _ in range(2):                                       # again, as a repeated load would
        G.refresh_gold(changed, path, ["2023-07", "2023-08"])
        assert rows(G.read_gold(spark, path)) == rows(G.monthly_sums(changed))


def test_refresh_reads_its_months_only(spark, scratch, accounts):
    old = lines(spark, 1, 300).where("transaction_date IS NOT NULL")
    sinks.write_silver(old, f"{scratch}/silver", "transaction_date", ["account_code"])
    silver = spark.read.parquet(f"{scratch}/silver")
    G.write_gold(silver, f"{scratch}/gold")
    plan = G.monthly_sums(G.in_months(silver, ["2023-03", "2023-04"])) \
        ._jdf.queryExecution().executedPlan().toString()
    assert "month#" in plan.split("PartitionFilters:")[1].split("]")[0]
    assert "GreaterThanOrEqual(transaction_date,2023-03-01)" in plan
    with pytest.raises(ValueError):
        L.gold_income_summary_by_year(G.read_gold(spark, f"{scratch}/gold"), accounts, "2023-04-15")
    with pytest.raises(ValueError):
        G.write_gold(silver, f"{scratch}/gold")


def test_months_touched_by_a_load(spark, scratch):
    batch = lines(spark, 5, 30, months=[2, 3])
    assert set(G.touched_months(batch)) <= {"2023-02", "2023-03", G.UNKNOWN}
    assert G.in_months(batch, []).count() == 0
    assert G.in_months(batch, G.touched_months(batch)).count() == 30
    assert LD.table_exists(spark, scratch)
