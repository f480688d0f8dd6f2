"""Stand-in adapters: the provided TPC-H-like tables, read as the silver schema.

Verification runs on generated Parquet tables, not on bank files, so each silver table has
one adapter here. The gold functions never see TPC-H names. Every adapter is a pure
projection (scan -> project; filters and column pruning reach the Parquet scan), except
``silver_account_statements(typed=True)`` which looks the account type up in the chart of
accounts the way the API would deliver it. ``oracle_sql`` mirrors each adapter in DuckDB.

Money is derived with integer arithmetic on cents so that both engines round identically.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.accounting import (TYPE_ASSET, TYPE_EQUITY, TYPE_EXPENSE, TYPE_LIABILITY,
                                   TYPE_REVENUE)
from .functions.keys import bank_tx_id, month_key
from .schemas import MONEY

# --- fixed values: stand-in mapping of part types to account types -----------------------
PART_TYPE_TO_ACCOUNT_TYPE = {
    "SMALL": TYPE_REVENUE,
    "MEDIUM": TYPE_EXPENSE,
    "LARGE": TYPE_ASSET,
    "ECONOMY": TYPE_LIABILITY,
    "STANDARD": TYPE_EQUITY,
}
OTHER_ACCOUNT_TYPE = "Annað"   # PROMO and anything else: exercises the ELSE branches
# -----------------------------------------------------------------------------------------------


# Set by ``materialize`` while it loads silver: spread single-file inputs over this many
# partitions. A provided table is one file with one row group, i.e. one scan task, so the
# adapters' projections would run on one core; directories of many files are left alone.
_SPREAD: int | None = None


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = os.path.join(sf_dir, f"{name}.parquet")
    df = spark.read.parquet(path)
    if _SPREAD and os.path.isfile(path):
        df = df.repartition(_SPREAD)
    return df


# Materialised silver tables: (abs sf_dir, table) -> path written by ``materialize``.
_MATERIALIZED: dict[tuple[str, str], str] = {}


def _materialized(spark: SparkSession, sf_dir: str, name: str) -> DataFrame | None:
    path = _MATERIALIZED.get((os.path.abspath(sf_dir), name))
    if path is None:
        return None
    from .sources.sinks import read_silver
    return read_silver(spark, path)


def _cents_to_money(cents):
    # cents (bigint) -> DECIMAL(18,2), exact
    return (cents.cast("decimal(18,0)") * F.lit(0.01).cast("decimal(2,2)")).cast(MONEY)


def _price_cents(c):
    # prices carry 2 decimals; x*100 is within 1e-9 of an integer, so this is exact
    return F.round(c * 100).cast("bigint")


def _div_half_up(num, den):
    # round(num/den) half-up for num >= 0, den > 0, integers only
    n2, d2 = num * 2 + den, den * 2
    return ((n2 - F.pmod(n2, d2)) / d2).cast("bigint")


def dim_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chart of accounts from ``part``."""
    m = _materialized(spark, sf_dir, "dim_accounts")
    if m is not None:
        return m
    p = read_table(spark, sf_dir, "part")
    head = F.substring_index(F.col("p_type"), " ", 1)
    t = None
    for k, v in PART_TYPE_TO_ACCOUNT_TYPE.items():
        t = F.when(head == k, F.lit(v)) if t is None else t.when(head == k, F.lit(v))
    t = t.otherwise(F.lit(OTHER_ACCOUNT_TYPE))
    key = F.col("p_partkey").cast("string")
    return p.select(
        key.alias("account_id"),
        key.alias("account_number"),
        F.col("p_name").alias("account_name"),
        t.alias("account_type"),
        F.col("p_brand").alias("account_subtype"),
        F.lit(None).cast("string").alias("parent_account_id"),
        F.when(F.col("p_size") > 5, F.lit(1)).otherwise(F.lit(0)).alias("is_active"),
        F.lit(None).cast("string").alias("created_at"),
        F.lit(None).cast("string").alias("updated_at"),
    )


def _line_id():
    return F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"),
                       F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"))


def silver_account_statements(spark: SparkSession, sf_dir: str, typed: bool = False) -> DataFrame:
    """General-ledger lines from ``lineitem``.

    amount = +extendedprice, negated for returned lines (flag R); debit/credit by the sign
    rule; balance = quantity x 100. ``typed=False`` leaves type/subtype '' (as the incremental
    loaders do) so reports must join the chart of accounts; ``typed=True`` fills them from
    the chart, as the full API load does (needed by convention-A views).
    """
    m = _materialized(spark, sf_dir, "silver_account_statements" + ("_typed" if typed else ""))
    if m is not None:
        return m
    if typed:
        s = silver_account_statements(spark, sf_dir, typed=False)
        a = dim_accounts(spark, sf_dir).select(
            F.col("account_number").alias("__acct"),
            F.col("account_type").alias("__type"), F.col("account_subtype").alias("__sub"))
        return (s.join(a, s["account_code"] == a["__acct"], "left")
                 .withColumn("account_type", F.coalesce("__type", F.lit("")))
                 .withColumn("account_subtype", F.coalesce("__sub", F.lit("")))
                 .drop("__acct", "__type", "__sub"))
    l = read_table(spark, sf_dir, "lineitem")
    amount = _cents_to_money(F.when(F.col("l_returnflag") == "R", -_price_cents(F.col("l_extendedprice")))
                             .otherwise(_price_cents(F.col("l_extendedprice"))))
    code = F.col("l_partkey").cast("string")
    tdate = F.col("l_shipdate").cast("date")
    kind = (F.when(F.col("l_returnflag") == "R", F.lit("Return"))
            .when(F.col("l_returnflag") == "A", F.lit("Adjusted sale"))
            .otherwise(F.lit("Sale")))
    status = F.when(F.col("l_linestatus") == "O", F.lit("open")).otherwise(F.lit("final"))
    currency = (F.when(F.pmod(F.col("l_suppkey"), F.lit(10)) == 7, F.lit("EUR"))
                .when(F.pmod(F.col("l_suppkey"), F.lit(10)) == 8, F.lit("GBP"))
                .otherwise(F.lit("ISK")))
    s = l.select(
        _line_id().alias("id"),
        code.alias("account_code"),
        code.alias("account_id"),
        F.concat(F.lit("Account "), code).alias("account_name"),
        F.lit("").alias("account_type"),
        F.lit("").alias("account_subtype"),
        tdate.alias("transaction_date"),
        tdate.alias("journal_date"),
        F.concat(kind, F.lit(" / supplier "), F.col("l_suppkey").cast("string"), F.lit(" / "),
                 status).alias("description"),
        F.col("l_orderkey").cast("string").alias("reference"),
        amount.alias("amount"),
        F.when(amount < 0, -amount).otherwise(F.lit(0)).cast(MONEY).alias("debit"),
        F.when(amount > 0, amount).otherwise(F.lit(0)).cast(MONEY).alias("credit"),
        _cents_to_money(F.round(F.col("l_quantity") * 10000).cast("bigint")).alias("balance"),
        currency.alias("currency"),
        F.col("l_orderkey").cast("string").alias("journal_id"),
        F.col("l_orderkey").cast("string").alias("journal_number"),
        F.col("l_linenumber").alias("line_number"),
        F.lit("transaction").alias("record_type"),
        tdate.cast("string").alias("created_at"),
    )
    return s


def _priority_digit():
    return F.substring(F.col("o_orderpriority"), 1, 1)


def dim_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoices from ``orders``: F->PAID, O->SENT, P->DRAFT (priority 4 -> CANCELLED,
    priority 5 -> CREDIT); due = date + 30 d; inactive when orderkey % 10 = 0."""
    m = _materialized(spark, sf_dir, "dim_invoices")
    if m is not None:
        return m
    o = read_table(spark, sf_dir, "orders")
    pdig = _priority_digit()
    status = (F.when(F.col("o_orderstatus") == "F", F.lit("PAID"))
              .when(F.col("o_orderstatus") == "O", F.lit("SENT"))
              .when((F.col("o_orderstatus") == "P") & (pdig == "4"), F.lit("CANCELLED"))
              .when((F.col("o_orderstatus") == "P") & (pdig == "5"), F.lit("CREDIT"))
              .when(F.col("o_orderstatus") == "P", F.lit("DRAFT"))
              .otherwise(F.col("o_orderstatus")))
    currency = (F.when(pdig == "2", F.lit("EUR")).when(pdig == "3", F.lit("USD"))
                .when(pdig == "5", F.lit("GBP")).otherwise(F.lit("ISK")))
    total_c = _price_cents(F.col("o_totalprice"))
    sub_c = _div_half_up(total_c * 100, F.lit(124))
    idate = F.col("o_orderdate").cast("date")
    return o.select(
        F.concat(F.lit("inv-"), F.col("o_orderkey").cast("string")).alias("invoice_id"),
        F.col("o_orderkey").cast("string").alias("invoice_number"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        status.alias("status"),
        currency.alias("currency"),
        _cents_to_money(sub_c).alias("subtotal"),
        _cents_to_money(total_c - sub_c).alias("vat_amount"),
        _cents_to_money(total_c).alias("total"),
        idate.alias("invoice_date"),
        F.date_add(idate, 30).alias("due_date"),
        F.date_add(idate, 45).alias("final_due_date"),
        F.when(F.col("o_orderstatus") == "F", F.date_add(idate, 20).cast("string")).alias("paid_date"),
        F.when(F.col("o_orderstatus") == "F", F.lit("transfer")).alias("payment_type"),
        F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("description"),
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("reference"),
        F.when(F.pmod(F.col("o_orderkey"), F.lit(10)) != 0, F.lit(1)).otherwise(F.lit(0)).alias("is_active"),
        idate.cast("string").alias("created_at"),
        idate.cast("string").alias("updated_at"),
    )


def dim_invoice_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoice lines from ``lineitem`` (on ``l_orderkey``)."""
    m = _materialized(spark, sf_dir, "dim_invoice_lines")
    if m is not None:
        return m
    l = read_table(spark, sf_dir, "lineitem")
    price_c = _price_cents(F.col("l_extendedprice"))
    qty = F.round(F.col("l_quantity")).cast("bigint")
    tax_pct = F.round(F.col("l_tax") * 100).cast("bigint")
    disc_pct = F.round(F.col("l_discount") * 100).cast("bigint")
    return l.select(
        _line_id().alias("id"),
        F.concat(F.lit("inv-"), F.col("l_orderkey").cast("string")).alias("invoice_id"),
        F.col("l_linenumber").alias("line_number"),
        F.concat(F.lit("Part "), F.col("l_partkey").cast("string")).alias("description"),
        qty.cast(MONEY).alias("quantity"),
        _cents_to_money(_div_half_up(price_c, F.greatest(qty, F.lit(1)))).alias("unit_price"),
        disc_pct.cast(MONEY).alias("discount_percent"),
        tax_pct.cast(MONEY).alias("vat_percent"),
        _cents_to_money(_div_half_up(price_c * tax_pct, F.lit(100))).alias("vat_amount"),
        _cents_to_money(price_c).alias("line_total"),
        F.col("l_partkey").cast("string").alias("account_id"),
        F.col("l_partkey").cast("string").alias("account_code"),
        F.col("l_shipdate").cast("date").cast("string").alias("created_at"),
    )


BANK_EVENT_TYPES = ("purchase", "error", "signup")
CARD_EVENT_TYPES = ("click", "view")


def silver_bank_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bank statement lines from ``events`` (purchase/error/signup); purchases are outflows."""
    m = _materialized(spark, sf_dir, "silver_bank_transactions")
    if m is not None:
        return m
    e = read_table(spark, sf_dir, "events").where(F.col("event_type").isin(*BANK_EVENT_TYPES))
    value_c = _price_cents(F.col("value"))
    amount = _cents_to_money(F.when(F.col("event_type") == "purchase", -value_c).otherwise(value_c))
    branch = F.lpad((F.pmod(F.col("user_id"), F.lit(5)) + 100).cast("string"), 4, "0")
    ledger = F.lit("26")
    acct = F.lpad(F.col("user_id").cast("string"), 6, "0")
    bdate = F.col("ts").cast("date")
    currency = (F.when(F.pmod(F.col("user_id"), F.lit(7)) == 0, F.lit("EUR"))
                .when(F.pmod(F.col("user_id"), F.lit(7)) == 1, F.lit("GBP"))
                .otherwise(F.lit("ISK")))
    ref = F.col("event_id").cast("string")
    batch = F.pmod(F.col("event_id"), F.lit(3)).cast("string")
    return e.select(
        bank_tx_id(branch, ledger, acct, bdate, amount, batch, ref, F.col("event_type")).alias("id"),
        branch.alias("branch"), ledger.alias("ledger"), acct.alias("account_no"),
        bdate.alias("booking_date"), bdate.alias("value_date"), amount.alias("amount"),
        currency.alias("currency"),
        _cents_to_money(value_c * 10).alias("balance"),
        ref.alias("reference"), F.col("event_type").alias("text_key"),
        F.lit(None).cast("string").alias("payer_ssn"), batch.alias("rb_batchno"),
        F.upper(F.col("event_type")).alias("type_code"),
        F.concat(F.lit("Bank "), F.col("event_type"), F.lit(" "),
                 F.pmod(F.col("user_id"), F.lit(13)).cast("string")).alias("description"),
        F.sha1(F.col("props")).alias("raw_hash"),
        month_key(bdate).alias("source_period"),
        F.col("ts").cast("timestamp").alias("ingested_at"),
    )


def silver_card_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Card lines from ``events`` (click = withdrawal, stored negative; view = deposit)."""
    m = _materialized(spark, sf_dir, "silver_card_transactions")
    if m is not None:
        return m
    e = read_table(spark, sf_dir, "events").where(F.col("event_type").isin(*CARD_EVENT_TYPES))
    value_c = _price_cents(F.col("value"))
    withdrawal = F.col("event_type") == "click"
    amount = _cents_to_money(F.when(withdrawal, -value_c).otherwise(value_c))
    d = F.col("ts").cast("date")
    merchant = F.concat(F.lit("Merchant "), F.pmod(F.col("user_id"), F.lit(17)).cast("string"))
    return e.select(
        F.concat(F.lit("C"), F.lpad(F.col("user_id").cast("string"), 6, "0")).alias("card_id"),
        F.col("event_id").cast("string").alias("entry_id"),
        F.when(withdrawal, F.lit("withdrawal")).otherwise(F.lit("deposit")).alias("kind"),
        F.lit(None).cast("string").alias("clearance_id"),
        d.alias("date"), amount.alias("amount"),
        F.lit(None).cast(MONEY).alias("foreign_amount"),
        F.lit("ISK").alias("currency"), F.lit(None).cast("string").alias("foreign_currency"),
        F.pmod(F.col("user_id"), F.lit(17)).cast("string").alias("merchant_id"),
        merchant.alias("merchant_name"),
        F.lit(None).cast("string").alias("trans_key"),
        F.lit(None).cast("string").alias("trans_descriptor"),
        F.lit(None).cast("string").alias("due_date"),
        F.lit(None).cast("string").alias("mcc"),
        merchant.alias("description"),
        F.sha1(F.col("props")).alias("raw_hash"),
        month_key(d).alias("source_period"),
        F.col("ts").cast("timestamp").alias("ingested_at"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer register from ``customer``."""
    c = read_table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").cast("string").alias("country"),
        _cents_to_money(_price_cents(F.col("c_acctbal"))).alias("balance"),
    )


def expenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expenses: returned lines, booked against their supplier (creditor)."""
    l = read_table(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == "R")
    return l.select(
        _line_id().alias("expense_id"),
        F.col("l_suppkey").cast("string").alias("creditor_id"),
        F.col("l_shipdate").cast("date").alias("date"),
        _cents_to_money(_price_cents(F.col("l_extendedprice"))).alias("amount"),
        F.concat(F.lit("Return of part "), F.col("l_partkey").cast("string")).alias("description"),
        F.col("l_partkey").cast("string").alias("account_code"),
    )


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments: one per paid invoice."""
    i = dim_invoices(spark, sf_dir).where(F.col("status") == "PAID")
    return i.select(
        F.concat(F.lit("pay-"), F.col("invoice_number")).alias("payment_id"),
        "invoice_id", "customer_id",
        F.col("paid_date").cast("date").alias("date"),
        F.col("total").alias("amount"), "currency", "payment_type",
    )


# table -> (adapter, date column for month partitioning or None, sort keys)
MATERIALIZABLE = {
    "dim_accounts": (dim_accounts, None, ["account_number"]),
    "silver_account_statements": (lambda sp, d: silver_account_statements(sp, d, False),
                                  "transaction_date", ["account_code"]),
    "silver_account_statements_typed": (lambda sp, d: silver_account_statements(sp, d, True),
                                        "transaction_date", ["account_code"]),
    "dim_invoices": (dim_invoices, "invoice_date", ["customer_id"]),
    "dim_invoice_lines": (dim_invoice_lines, None, ["invoice_id"]),
    "silver_bank_transactions": (silver_bank_transactions, "booking_date", ["account_no"]),
    "silver_card_transactions": (silver_card_transactions, "date", ["card_id"]),
}


def materialize(spark: SparkSession, sf_dir: str, root: str,
                tables: list[str] | None = None,
                partition_by: str | None = "month", cluster: bool = True) -> dict[str, float]:
    """Load the stand-in silver tables once into Parquet under ``root`` (the silver layer a
    deployment keeps), then serve later reads of this ``sf_dir`` from there. Returns the
    load time per table."""
    import time

    from .sources.sinks import write_silver
    global _SPREAD
    timings = {}
    names = tables or list(MATERIALIZABLE)
    # the typed statements are the untyped silver plus the chart lookup: write them last,
    # so they are derived from the already-written (parallel-readable) untyped table
    names = sorted(names, key=lambda n: n == "silver_account_statements_typed")
    _SPREAD = spark.sparkContext.defaultParallelism
    try:
        for name in names:
            fn, date_col, keys = MATERIALIZABLE[name]
            path = os.path.join(root, name)
            t0 = time.perf_counter()
            df = fn(spark, sf_dir)
            if date_col:
                write_silver(df, path, date_col, keys, partition_by=partition_by, cluster=cluster)
            else:
                n = spark.sparkContext.defaultParallelism
                spread = df.repartitionByRange(n, *keys) if cluster else df.repartition(n)
                spread.sortWithinPartitions(*keys).write.mode("overwrite").parquet(path)
            timings[name] = time.perf_counter() - t0
            _MATERIALIZED[(os.path.abspath(sf_dir), name)] = path
    finally:
        _SPREAD = None
    return timings


def forget_materialized() -> None:
    _MATERIALIZED.clear()
