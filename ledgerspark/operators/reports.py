"""Report-level operators.

Inputs:

* *account lines* — one row per statement line with ``account, account_name, currency, date,
  description, amount, balance, row_no`` (``row_no`` is the line's position in its source
  statement; ``sources.sheets`` produces this shape, ``account_lines_from_bank`` adapts the
  bank silver table);
* the chart of accounts and ledger statements for the report generator (E55-E59).

Every roll-up aggregates first (map-side partial aggregation), so windows and joins only see
aggregated rows; money stays DECIMAL until presentation, FX products included.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.accounting import account_class
from ..functions.dates import in_years
from ..functions.keys import month_key, text_prefix_key
from ..functions.money import CENTS, percent_change, whole_div
from ..schemas import MONEY
from .topk import last_n_periods, top_k_per_group

RATE = "decimal(18,6)"


def account_lines_from_bank(bank: DataFrame) -> DataFrame:
    """Bank silver rows as account lines; ``row_no`` = statement reference order."""
    return bank.select(
        F.concat_ws("-", "branch", "ledger", "account_no").alias("account"),
        F.concat(F.lit("Account "), F.col("account_no")).alias("account_name"),
        "currency", F.col("booking_date").alias("date"), "description", "amount", "balance",
        F.col("reference").cast("bigint").alias("row_no"))


# ------------------------------------------------------------------ E42, E43

def bank_summary(tx: DataFrame, from_date: str | None = None,
                 to_date: str | None = None) -> tuple[DataFrame, DataFrame]:
    """E42 over the lines that C1 selects, all of them (``limit=None``): overall count / sum /
    date range, and per account count, sum, and the type and currency of its newest line (ties
    by type, then currency)."""
    overall = tx.agg(F.count(F.lit(1)).alias("total_transactions"),
                     F.coalesce(F.sum("amount"), F.lit(0)).alias("total_amount")).select(
        "total_transactions", "total_amount",
        F.lit(from_date or "all").alias("date_from"), F.lit(to_date or "all").alias("date_to"))
    newest = F.struct(F.datediff(F.lit("9999-12-31").cast("date"), F.col("date")).alias("age"),
                      "account_type", "currency")
    per = tx.groupBy("account_number").agg(
        F.count(F.lit(1)).alias("transaction_count"),
        F.sum("amount").alias("total_amount"), F.min(newest).alias("first")).select(
        "account_number", F.col("first.account_type").alias("account_type"), "transaction_count",
        "total_amount", F.col("first.currency").alias("currency"))
    return overall, per


def invoice_summary(invoices: DataFrame, high_average: float = 1000.0) -> DataFrame:
    """One row: count, total, JS-rounded average, status breakdown, most recent invoice
    by creation time, and insight counters (overdue, awaiting payment, high average)."""
    # per status first (map-side partial aggregation), then one global row over the
    # handful of statuses: no join needed to put totals and breakdown side by side
    key = F.struct(F.coalesce("created_at", F.lit("")).alias("c"), F.col("invoice_id").alias("i"))
    st = invoices.groupBy(F.coalesce("status", F.lit("unknown")).alias("status")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.coalesce(F.col("total"), F.lit(0).cast(MONEY))).alias("tv"),
        F.max_by(F.struct("invoice_number", "created_at"), key).alias("rec"),
        F.max(key).alias("reck"))
    tot = st.agg(
        F.sum("n").alias("total_items"),
        F.sum("tv").alias("total_value"),
        F.concat_ws(", ", F.array_sort(F.collect_list(
            F.concat(F.col("n").cast("string"), F.lit(" "), F.col("status"))))).alias(
            "status_breakdown"),
        F.sum(F.when(F.col("status") == "OVERDUE", F.col("n")).otherwise(0)).alias("overdue_count"),
        F.sum(F.when(F.col("status") == "SENT", F.col("n")).otherwise(0)).alias("awaiting_count"),
        F.max_by("rec", "reck").alias("__recent"))
    cents = (F.col("total_value") * 100).cast(CENTS)
    n = F.col("total_items").cast(CENTS)
    # JS Math.round(total / n) = floor(total / n + 0.5), exactly: floor((2c + 100n) / 200n)
    num, den = (cents * 2 + n * 100).cast(CENTS), F.nullif((n * 200).cast(CENTS), F.lit(0))
    avg_js = whole_div(num - F.pmod(num, den), den)
    return tot.select(
        "total_items", "total_value",
        F.when(n > 0, avg_js).alias("average_value"),
        "status_breakdown",
        F.col("__recent.invoice_number").alias("most_recent_number"),
        F.col("__recent.created_at").alias("most_recent_created"),
        "overdue_count", "awaiting_count",
        (F.col("total_value").cast("double") / n > high_average).alias("high_average"))


# ------------------------------------------------------------------ E44-E54 (account lines)

def account_profile(lines: DataFrame) -> DataFrame:
    """Per account: credits, debits, average (credits - debits) / n, largest in/out,
    ending balance = last non-zero balance by row order. Zero amounts are ignored except
    for the ending balance."""
    a = F.col("amount")
    nz = a != 0
    g = lines.groupBy("account", "account_name", "currency").agg(
        F.count(F.when(nz, F.lit(1))).alias("transactions"),
        F.coalesce(F.sum(F.when(a > 0, a)), F.lit(0).cast(MONEY)).alias("total_credits"),
        F.coalesce(F.sum(F.when(a < 0, -a)), F.lit(0).cast(MONEY)).alias("total_debits"),
        F.coalesce(F.max(F.when(a > 0, a)), F.lit(0).cast(MONEY)).alias("largest_inflow"),
        F.coalesce(F.max(F.when(a < 0, -a)), F.lit(0).cast(MONEY)).alias("largest_outflow"),
        F.coalesce(F.max_by(F.when(F.col("balance") != 0, F.col("balance")),
                            F.when(F.col("balance") != 0, F.struct("date", "row_no"))),
                   F.lit(0).cast(MONEY)).alias("ending_balance"))
    avg = F.when(F.col("transactions") > 0,
                 (F.col("total_credits") - F.col("total_debits")).cast("double")
                 / F.col("transactions")).otherwise(F.lit(0.0))
    return g.withColumn("average_transaction", avg)


def _monthly(lines: DataFrame) -> DataFrame:
    a = F.col("amount")
    return lines.where(a != 0).groupBy("account", "currency", month_key("date").alias("month")).agg(
        F.sum(F.when(a > 0, a).otherwise(F.lit(0))).alias("credits"),
        F.sum(F.when(a < 0, -a).otherwise(F.lit(0))).alias("debits"),
        F.count(F.lit(1)).alias("count"))


def account_monthly_activity(lines: DataFrame, last_n: int = 6) -> DataFrame:
    """Account x month -> credits, debits, count, for each account's latest n months."""
    return last_n_periods(_monthly(lines).drop("currency"), "month", last_n, ["account"])


def frequent_descriptions(lines: DataFrame, top: int = 5,
                          prefix_len: int | None = None) -> DataFrame:
    """Account x description -> count; each account's top 5 (ties by text). Whole texts are
    grouped; ``prefix_len`` merges those that share so many first characters."""
    d = F.coalesce(F.col("description"), F.lit(""))
    key = d if prefix_len is None else F.substring(d, 1, prefix_len)
    g = (lines.where((F.col("amount") != 0) & (d != ""))
         .groupBy("account", key.alias("description_prefix"))
         .agg(F.count(F.lit(1)).alias("count")))
    return top_k_per_group(g, ["account"], [F.col("count").desc(), F.col("description_prefix")],
                           top, rank_col="rank")


def _with_rate(df: DataFrame, rates: DataFrame) -> DataFrame:
    # rates from ``fx_rates`` are a size-checked, broadcast-marked configuration table
    r = rates.select(F.col("currency").alias("__cur"), F.col("rate_to_isk").cast(RATE).alias("__rate"))
    j = df.join(r, df["currency"] == r["__cur"], "left")
    return j.withColumn("__rate", F.coalesce("__rate", F.lit(1).cast(RATE))).drop("__cur")


def company_totals(lines: DataFrame, rates: DataFrame) -> DataFrame:
    """Company-wide credits, debits, net in ISK (per-currency rates, default 1)."""
    a = F.col("amount")
    per_cur = lines.groupBy("currency").agg(
        F.sum(F.when(a > 0, a).otherwise(F.lit(0))).alias("c"),
        F.sum(F.when(a < 0, -a).otherwise(F.lit(0))).alias("d"))
    j = _with_rate(per_cur, rates)
    c, d = F.sum(F.col("c") * F.col("__rate")), F.sum(F.col("d") * F.col("__rate"))
    return j.agg(c.alias("total_inflows_isk"), d.alias("total_outflows_isk"),
                 (c - d).alias("net_position_isk"))


def _monthly_fx(lines: DataFrame, rates: DataFrame) -> DataFrame:
    m = _monthly(lines).groupBy("currency", "month").agg(
        F.sum(F.col("credits") - F.col("debits")).alias("net"))
    j = _with_rate(m, rates)
    return j.groupBy("month").agg(F.sum(F.col("net") * F.col("__rate")).alias("net_flow_isk"))


def company_cash_flow(lines: DataFrame, rates: DataFrame, last_n: int = 12) -> DataFrame:
    """Month -> FX-converted net flow, latest n months."""
    return last_n_periods(_monthly_fx(lines, rates), "month", last_n)


def quarterly_performance(lines: DataFrame, rates: DataFrame, last_n: int = 8) -> DataFrame:
    """Quarter -> sum of the monthly FX net flows, latest n quarters."""
    m = _monthly_fx(lines, rates)
    q = m.groupBy(F.concat(F.substring("month", 1, 4), F.lit("-Q"),
                           F.ceil(F.substring("month", 6, 2).cast("int") / 3).cast("string"))
                  .alias("quarter")).agg(F.sum("net_flow_isk").alias("total_isk"))
    return last_n_periods(q, "quarter", last_n)


def account_usage(lines: DataFrame) -> DataFrame:
    """Per account: lines / max(1, active months); foreign flag, count and ending
    balance (listed for the non-ISK accounts)."""
    p = account_profile(lines)
    months = _monthly(lines).groupBy("account").agg(F.count(F.lit(1)).alias("active_months"))
    j = p.join(months, "account", "left")
    return j.select(
        "account", "account_name", "currency", "transactions",
        (F.col("transactions") / F.greatest(F.lit(1), F.coalesce("active_months", F.lit(0))))
        .alias("avg_monthly_transactions"),
        (F.col("currency") != "ISK").alias("is_foreign"), "ending_balance")


def _counterparties(lines: DataFrame, key_len: int | None) -> DataFrame:
    """account x counterparty -> count, Σamount; the counterparty is the trimmed description, or
    its first ``key_len`` characters."""
    k = text_prefix_key("description", key_len) if key_len else \
        F.nullif(F.trim(F.coalesce("description", F.lit(""))), F.lit(""))
    return (lines.where(F.col("amount") != 0).withColumn("counterparty", k)
         .where(F.col("counterparty").isNotNull())
         .groupBy("account", "counterparty")
         .agg(F.count(F.lit(1)).alias("count"), F.sum("amount").alias("total")))


def counterparty_volume(lines: DataFrame, top: int = 5, key_len: int | None = None) -> DataFrame:
    """Account x counterparty -> count, Σamount; each account's top 5 by |Σamount| (ties by
    key)."""
    return top_k_per_group(_counterparties(lines, key_len), ["account"], [F.abs("total").desc(), F.col("counterparty")], top,
                           rank_col="rank")


def recurring_counterparties(lines: DataFrame, top: int = 10, min_count: int = 3,
                             key_len: int | None = None) -> DataFrame:
    """Counterparties seen >= 3 times over all accounts; the top 10 by count (ties by
    name). Everything is aggregated before anything is ranked."""
    g = _counterparties(lines, key_len).groupBy("counterparty").agg(
        F.sum("count").alias("transactions")).where(F.col("transactions") >= min_count)
    return g.orderBy(F.col("transactions").desc(), "counterparty").limit(top)


def counterparty_stats(lines: DataFrame, min_count: int = 3,
                       key_len: int | None = None) -> DataFrame:
    """E52 (counters): counterparties, and the recurring ones among them."""
    g = _counterparties(lines, key_len).groupBy("counterparty").agg(F.sum("count").alias("n"))
    return g.agg(F.count(F.lit(1)).alias("unique_counterparties"),
                 F.count_if(F.col("n") >= min_count).alias("recurring_counterparties"))


def largest_transactions(lines: DataFrame, n: int = 5, after_year: int = 2020) -> DataFrame:
    """ISK lines; the n largest inflows and n largest outflows, *then* only those
    dated after ``after_year`` are kept (as in the source). Ties by account, row."""
    isk = lines.where(F.col("currency") == "ISK")
    cols = ["account", "date", "amount", "description", "row_no"]
    ins = (isk.where(F.col("amount") > 0).orderBy(F.col("amount").desc(), "account", "row_no")
           .limit(n).select(F.lit("inflow").alias("kind"), *cols))
    outs = (isk.where(F.col("amount") < 0).orderBy(F.col("amount").asc(), "account", "row_no")
            .limit(n).select(F.lit("outflow").alias("kind"), *cols))
    return ins.unionByName(outs).where(in_years("date", after_year + 1))


def isk_monthly_trend(lines: DataFrame, from_year: int = 2024) -> DataFrame:
    """ISK accounts, months of ``from_year`` onwards -> revenue (in), expenses (out), net."""
    m = _monthly(lines.where((F.col("currency") == "ISK") & in_years("date", from_year)))
    g = m.groupBy("month").agg(F.sum("credits").alias("revenue"), F.sum("debits").alias("expenses"))
    return g.withColumn("net", F.col("revenue") - F.col("expenses"))


# ------------------------------------------------------------------ E55-E59 report generator

def account_balances(accounts: DataFrame, transactions: DataFrame, year: str | None = None) -> DataFrame:
    """Σamount per known account (unknown codes ignored, accounts without rows -> 0)."""
    t = transactions
    if year is not None:
        t = t.where(in_years("transaction_date", year, year))
    per = t.groupBy(F.col("account_code").alias("__code")).agg(F.sum("amount").alias("__sum"))
    a = accounts.select(F.col("account_number").alias("code"), F.col("account_name").alias("name"),
                        F.col("account_type").alias("type"),
                        F.coalesce(F.nullif(F.col("account_subtype"), F.lit("")), F.lit("Other"))
                        .alias("sub_type"))
    j = a.join(per, a["code"] == per["__code"], "left")
    return j.select("code", "name", "type", "sub_type",
                    F.coalesce("__sum", F.lit(0).cast(MONEY)).alias("balance"),
                    account_class("type").alias("class"))


def income_statement(accounts: DataFrame, transactions: DataFrame, year: str) -> tuple[DataFrame, DataFrame]:
    """E55 (convention C): revenue/expense accounts with |Σamount| > 0, and the totals."""
    b = account_balances(accounts, transactions, year).where(
        F.col("class").isin("revenue", "expense")).withColumn("amount", F.abs("balance"))
    lines = b.where(F.col("amount") > 0).select(
        F.col("class").alias("section"), "code", "name", "amount")
    rev = F.sum(F.when(F.col("class") == "revenue", F.col("amount")).otherwise(F.lit(0)))
    exp = F.sum(F.when(F.col("class") == "expense", F.col("amount")).otherwise(F.lit(0)))
    totals = b.agg(F.coalesce(rev, F.lit(0)).alias("total_revenue"),
                   F.coalesce(exp, F.lit(0)).alias("total_expenses"))
    totals = totals.withColumn("net_income", F.col("total_revenue") - F.col("total_expenses"))
    return lines, totals


def balance_sheet(accounts: DataFrame, transactions: DataFrame, year: str) -> tuple[DataFrame, DataFrame]:
    """|balance| per asset/liability/equity account, non-zero only, with sub-type
    (default 'Other'); totals per class and liabilities + equity."""
    b = account_balances(accounts, transactions, year).where(
        F.col("class").isin("asset", "liability", "equity")).withColumn("amount", F.abs("balance"))
    lines = b.where(F.col("amount") > 0).select(F.col("class").alias("section"), "sub_type",
                                                "code", "name", "amount")

    def tot(cls):
        return F.coalesce(F.sum(F.when(F.col("section") == cls, F.col("amount"))),
                          F.lit(0).cast(MONEY))
    totals = lines.agg(tot("asset").alias("total_assets"), tot("liability").alias("total_liabilities"),
                       tot("equity").alias("total_equity"))
    totals = totals.withColumn("total_liabilities_and_equity",
                               F.col("total_liabilities") + F.col("total_equity"))
    return lines, totals


def key_metrics(accounts: DataFrame, transactions: DataFrame, year: str) -> DataFrame:
    """(metric, value) for Total Revenue, Total Expenses, Net Income, Total Assets,
    Total Liabilities (balances taken over the year's transactions)."""
    b = account_balances(accounts, transactions, year).withColumn("amount", F.abs("balance"))

    def tot(cls):
        return F.coalesce(F.sum(F.when(F.col("class") == cls, F.col("amount"))), F.lit(0).cast(MONEY))
    w = b.agg(tot("revenue").alias("r"), tot("expense").alias("e"), tot("asset").alias("a"),
              tot("liability").alias("l"))
    return w.select(F.expr(
        "stack(5, 'Total Revenue', r, 'Total Expenses', e, 'Net Income', r - e, "
        "'Total Assets', a, 'Total Liabilities', l) AS (metric, value)"))


def year_over_year(accounts: DataFrame, transactions: DataFrame, y1: str, y2: str) -> DataFrame:
    """Metric, value in y1 and y2, change, % change (0 when the base is 0). Both years come from
    one pass over the transactions."""
    t = transactions.where(in_years("transaction_date", y1, y1) | in_years("transaction_date", y2, y2))

    def of(year):
        return F.sum(F.when(in_years("transaction_date", year, year), F.col("amount")))
    per = t.groupBy(F.col("account_code").alias("__code")).agg(of(y1).alias("v1"), of(y2).alias("v2"))
    cls = accounts.select(F.col("account_number").alias("__account"),
                          account_class("account_type").alias("class"))
    b = cls.join(per, cls["__account"] == per["__code"], "left")

    def total(name, v):
        part = F.sum(F.when(F.col("class") == name, F.abs(v)))
        return F.coalesce(part, F.lit(0).cast(MONEY)).alias(f"{name}_{v}")
    w = b.agg(*[total(c, v) for c in ("revenue", "expense", "asset", "liability")
                for v in ("v1", "v2")])
    rows = [("Total Revenue", "revenue_{0}"), ("Total Expenses", "expense_{0}"),
            ("Net Income", "revenue_{0} - expense_{0}"), ("Total Assets", "asset_{0}"),
            ("Total Liabilities", "liability_{0}")]
    stacked = ", ".join(f"'{n}', {e.format('v1')}, {e.format('v2')}" for n, e in rows)
    return w.select(F.expr(f"stack(5, {stacked}) AS (metric, value_1, value_2)")).select(
        "metric", "value_1", "value_2", (F.col("value_2") - F.col("value_1")).alias("change"),
        percent_change("value_1", "value_2").alias("pct_change"))


def accounts_of_type(accounts: DataFrame) -> DataFrame:
    """The accounts themselves as flat rows (type, sub-type, number, name)."""
    sub_type = F.coalesce(F.nullif(F.col("account_subtype"), F.lit("")), F.lit("Other"))
    return accounts.select("account_type", sub_type.alias("sub_type"), "account_number",
                           "account_name")


def accounts_by_type(accounts: DataFrame) -> DataFrame:
    """Type x sub-type ('Other' when blank) -> number of accounts."""
    return accounts.groupBy(
        "account_type",
        F.coalesce(F.nullif(F.col("account_subtype"), F.lit("")), F.lit("Other")).alias("sub_type")
    ).agg(F.count(F.lit(1)).alias("account_count"))

