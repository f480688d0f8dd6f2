"""Search operators over the silver tables.

All filters are plain comparisons on typed columns, so they reach the Parquet scan as pushed
filters; ``limit`` after ``orderBy`` plans as TakeOrderedAndProject (a bounded top-k heap per
task), never a full sort of the table. Bounds are inclusive; ``query`` is a case-insensitive
"contains".
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import account_display

ISO_DATE = re.compile(r"^\d{4}-\d{2}-\d{2}$")
UUID_RE = re.compile(r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$", re.I)


def _check_date(name: str, v: str | None) -> None:
    if v is not None and not ISO_DATE.match(v):
        raise ValueError(f"{name} must be in YYYY-MM-DD format")


def _date_range(c: Column, lo: str | None, hi: str | None) -> Column:
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (c >= F.lit(lo).cast("date"))
    if hi is not None:
        cond = cond & (c <= F.lit(hi).cast("date"))
    return cond


def contains_ci(cols: list[str], query: str) -> Column:
    """Case-insensitive "contains" over any of ``cols``."""
    q = query.lower()
    cond = F.lit(False)
    for c in cols:
        cond = cond | F.lower(F.coalesce(F.col(c).cast("string"), F.lit(""))).contains(q)
    return cond


def bank_transactions(bank: DataFrame, cards: DataFrame, from_date: str | None = None,
                      to_date: str | None = None, account_number: str | None = None,
                      account_type: str = "all",
                      limit: int | None = None) -> DataFrame:
    """Bank and/or card lines, newest first.

    With ``all`` each side gives its newest ``limit`` rows and the union is cut once, so the
    result is the newest ``limit`` rows of both (bank before card on equal dates). Without
    ``limit`` every row is returned. Bank lines are filtered and sorted on the value date.
    """
    _check_date("fromDate", from_date)
    _check_date("toDate", to_date)
    if account_type not in ("bank", "card", "all"):
        raise ValueError("accountType must be bank, card or all")
    if limit is not None and int(limit) < 1:
        raise ValueError("limit must be at least 1")
    sides = []
    if account_type in ("all", "bank"):
        acct = account_display("branch", "ledger", "account_no")
        b = bank.where(_date_range(F.col("value_date"), from_date, to_date))
        if account_number:
            b = b.where(acct == account_number)
        b = b.select(F.lit("bank").alias("account_type"), acct.alias("account_number"),
                     F.col("value_date").alias("date"), "description", "amount", "balance",
                     F.col("reference").alias("reference_number"), "currency",
                     F.col("type_code").alias("transaction_type"),
                     F.lit(None).cast("string").alias("merchant_name"),
                     F.lit(None).cast("string").alias("card_number_masked"),
                     F.lit(0).alias("__src"), F.col("id").alias("__tie"))
        sides.append(b)
    if account_type in ("all", "card"):
        c = cards.where(_date_range(F.col("date"), from_date, to_date))
        if account_number:
            c = c.where(F.col("card_id") == account_number)
        c = c.select(F.lit("card").alias("account_type"), F.col("card_id").alias("account_number"),
                     "date", "description", "amount", F.lit(None).cast(bank.schema["balance"].dataType)
                     .alias("balance"), F.lit(None).cast("string").alias("reference_number"),
                     "currency", F.lit("CARD_TRANSACTION").alias("transaction_type"),
                     "merchant_name", F.lit(None).cast("string").alias("card_number_masked"),
                     F.lit(1).alias("__src"), F.col("entry_id").alias("__tie"))
        sides.append(c)
    order = [F.col("date").desc(), "__src", "account_number", "__tie"]
    if limit is not None:
        sides = [s.orderBy(*order).limit(limit) for s in sides]
    out = sides[0]
    for s in sides[1:]:
        out = out.unionByName(s)
    out = out.orderBy(*order)
    return (out if limit is None else out.limit(limit)).drop("__src", "__tie")


def invoice_search(invoices: DataFrame, lines: DataFrame | None = None,
                   customer_id: str | None = None, exclude_status: str | None = None,
                   date_from: str | None = None, date_to: str | None = None,
                   due_from: str | None = None, due_to: str | None = None,
                   final_due_from: str | None = None, final_due_to: str | None = None,
                   query: str | None = None, order_by: str | None = None, order: str = "asc",
                   include_lines: bool = False, legacy_from: str | None = None,
                   legacy_to: str | None = None) -> DataFrame:
    """Invoice filters. ``legacy_from``/``legacy_to`` apply only when the invoice-date
    range is absent. With ``include_lines`` the result has one row per line (invoice columns
    repeated) — a flat equi-join instead of nesting, so no invoice's lines are ever gathered
    into one array."""
    lo = date_from if (date_from or date_to) else legacy_from
    hi = date_to if (date_from or date_to) else legacy_to
    df = invoices.where(_date_range(F.col("invoice_date"), lo, hi)
                        & _date_range(F.col("due_date"), due_from, due_to)
                        & _date_range(F.col("final_due_date"), final_due_from, final_due_to))
    if customer_id:
        df = df.where(F.col("customer_id") == customer_id)
    if exclude_status:
        excl = [s.strip() for s in exclude_status.split(",") if s.strip()]
        if excl:
            df = df.where(~F.col("status").isin(*excl) | F.col("status").isNull())
    if query:
        df = df.where(contains_ci(["invoice_number", "description", "reference"], query))
    if include_lines and lines is not None:
        ln = lines.select(F.col("invoice_id").alias("__inv"),
                          *[F.col(c).alias(f"line_{c}") for c in lines.columns if c != "invoice_id"])
        df = df.join(ln, df["invoice_id"] == ln["__inv"], "left").drop("__inv")
    if order_by:
        col = F.col(order_by)
        df = df.orderBy(col.desc() if order.lower() == "desc" else col.asc(), "invoice_id")
    return df


def invoice_lookup(invoices: DataFrame, key: str) -> DataFrame:
    """By invoice id when ``key`` is a UUID, else by invoice number. No scan window."""
    if not key:
        return invoices.limit(0)
    if UUID_RE.match(key):
        return invoices.where(F.col("invoice_id") == key)
    return invoices.where(F.col("invoice_number") == key)


def customer_search(customers: DataFrame, query: str | None = None) -> DataFrame:
    """C4: customers whose name (or id) contains ``query``."""
    if not query:
        return customers
    return customers.where(contains_ci(["name", "customer_id"], query))


def customer_get(customers: DataFrame, customer_id: str) -> DataFrame:
    """C4: one customer by id."""
    return customers.where(F.col("customer_id") == customer_id)


def expense_search(expenses: DataFrame, date_from: str | None = None,
                   date_to: str | None = None, query: str | None = None,
                   include: dict[str, DataFrame] | None = None) -> DataFrame:
    """Expenses in a date range, optionally matching ``query``. ``include`` names details to
    join flat (name -> rows with an ``expense_id``); their columns get the name as a prefix, and
    expenses without such rows stay."""
    df = expenses.where(_date_range(F.col("date"), date_from, date_to))
    if query:
        df = df.where(contains_ci(["description", "creditor_id"], query))
    for name, rows in (include or {}).items():
        own = rows.select("expense_id", *[F.col(c).alias(f"{name}_{c}") for c in rows.columns
                                          if c != "expense_id"])
        df = df.join(own, "expense_id", "left")
    return df


def payment_search(payments: DataFrame, date_from: str | None = None,
                   date_to: str | None = None) -> DataFrame:
    """Payments in a date range."""
    return payments.where(_date_range(F.col("date"), date_from, date_to))


def sales_orders(orders: DataFrame, lines: DataFrame | None = None,
                 include_lines: bool = False) -> DataFrame:
    """Sales orders, with their lines as a flat join when asked."""
    if not include_lines or lines is None:
        return orders
    return invoice_search(orders, lines, include_lines=True)


def account_statement(statements: DataFrame, journal_date_from: str | None = None,
                      journal_date_to: str | None = None, created_from: str | None = None,
                      created_to: str | None = None, account_code: str | None = None,
                      account_type: str | None = None,
                      account_subtype: str | None = None) -> DataFrame:
    """Statement lines; needs both journal dates or both created dates."""
    has_journal = bool(journal_date_from and journal_date_to)
    has_created = bool(created_from and created_to)
    if not (has_journal or has_created):
        raise ValueError("Either both journal dates or both created dates are required")
    for n, v in (("dateFrom", journal_date_from), ("dateTo", journal_date_to),
                 ("createdFrom", created_from), ("createdTo", created_to)):
        _check_date(n, v)
    df = statements
    if has_journal:
        df = df.where(_date_range(F.col("journal_date"), journal_date_from, journal_date_to))
    if has_created:
        # ISO texts compare like their dates, so the bounds reach the scan as they are
        after = (dt.date.fromisoformat(created_to) + dt.timedelta(days=1)).isoformat()
        df = df.where((F.col("created_at") >= created_from) & (F.col("created_at") < after))
    for col, v in (("account_code", account_code), ("account_type", account_type),
                   ("account_subtype", account_subtype)):
        if v:
            df = df.where(F.col(col) == v)
    return df


def journal_entries(statements: DataFrame) -> DataFrame:
    """Journal entries: one row per journal with its line count and totals."""
    return statements.groupBy("journal_id", "journal_number").agg(
        F.min("journal_date").alias("journal_date"),
        F.count(F.lit(1)).alias("line_count"),
        F.sum("debit").alias("total_debit"), F.sum("credit").alias("total_credit"))


def payment_types(types: DataFrame, query: str | None = None) -> DataFrame:
    """The payment types (bank accounts), by title; optionally those matching ``query``."""
    if query:
        types = types.where(contains_ci(["title", "description"], query))
    return types.orderBy("title", "id")


def expense_accounts(accounts: DataFrame) -> DataFrame:
    """Expense accounts of the chart."""
    from ..functions.accounting import types_of
    return accounts.where(F.col("account_type").isin(*types_of("expense")))
