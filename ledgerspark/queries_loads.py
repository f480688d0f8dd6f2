"""Registered queries of the loads that write tables: windows of pages, invoice versions, the key
index, the persisted gold layer and the observed load log. Their tables are written below the
shared scratch folder, one folder a run."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import standins as S
from .functions.keys import month_key
from .operators import key_index, loading as LD
from .oracle_sql import D
from .plans import gold_store, ledger, marts
from .queries import NEW_LINES_SQL, REGISTRY, SINCE, _acc, _stm, register
from .session import scratch_path
from .streaming import invoices as invoice_stream


def _folder(spark, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


# ------------------------------------------------------------------ J1 windows of several pages

def _windowed_lines(spark, d) -> DataFrame:
    """Statement lines as pages of monthly windows that run on for three days. Half of the lines
    have no id, and account and amount are made coarse, so that equal lines occur. The
    later window misses some lines of the days that both cover, the earlier one others."""
    s = _stm(spark, d)
    day, number = F.dayofmonth("transaction_date"), F.col("line_number")
    month = F.trunc("transaction_date", "month")
    windows = F.array(
        F.when(~((day == 3) & (number == 2)), month),
        F.when((day <= 3) & (number != 1), F.add_months(month, -1)))
    return s.select(
        F.when(number % 2 == 0, "").otherwise(F.col("id")).alias("id"),
        F.substring("account_code", -1, 1).alias("account_code"), "transaction_date",
        F.lit("").alias("journal_id"), F.lit("").alias("journal_number"),
        (F.floor(F.col("amount") / 20000) * 20000).cast("decimal(18,2)").alias("amount"),
        F.substring_index("description", " ", 1).alias("description"),
        (number % 3 + 1).cast("long").alias("page"), F.xxhash64("id").alias("page_pos"),
        F.explode(F.array_compact(windows)).alias("load_window")) \
        .withColumn("load_window", F.col("load_window").cast("string")) \
        .withColumn("source_file", F.concat_ws("/", "load_window", "page"))


@register("load_overlapping_windows", """
WITH lines AS (
  SELECT CASE WHEN line_number % 2 = 0 THEN '' ELSE id END AS id,
         right(account_code, 1) AS account_code, transaction_date, line_number,
         floor(amount / 20000) * 20000 AS amount, split_part(description, ' ', 1) AS description,
         date_trunc('month', transaction_date) AS m, day(transaction_date) AS day
  FROM silver_account_statements),
delivered AS (
  SELECT *, m AS w FROM lines WHERE NOT (day = 3 AND line_number = 2)
  UNION ALL
  SELECT *, m - INTERVAL 1 MONTH FROM lines WHERE day <= 3 AND line_number <> 1),
counted AS (SELECT account_code, transaction_date, amount, description, id, w, COUNT(*) AS n
            FROM delivered GROUP BY ALL)
SELECT account_code, CAST(transaction_date AS VARCHAR) AS transaction_date,
       CAST(amount AS DOUBLE) AS amount, description, id, MAX(n) AS lines
FROM counted GROUP BY account_code, transaction_date, amount, description, id""")
def q_load_overlapping_windows(spark, d):
    keyed = LD.first_per_key(LD.statement_keys(_windowed_lines(spark, d)), ["line_key"], ["id"])
    return keyed.groupBy("account_code", "transaction_date", "amount", "description", "id").agg(
        F.count(F.lit(1)).alias("lines"))


# ------------------------------------------------------------------ J8 versions of invoices

def _invoice_documents(spark, d, file: str, shift: int, status: str | None,
                       n_lines: Column) -> DataFrame:
    inv = S.dim_invoices(spark, d)
    text = {c: F.lit(None).cast("string") for c in (
        "currency", "subtotal", "vatAmount", "finalDueDate", "paidDate", "paymentType",
        "description", "reference", "isActive", "created", "updated")}
    line = lambda k: F.struct(*[
        v.cast("string").alias(n) for n, v in (
            ("description", F.concat(F.lit(file), k.cast("string"))), ("quantity", F.lit(1)),
            ("unitPrice", 10 * k), ("discountPercent", F.lit(0)), ("vatPercent", F.lit(0)),
            ("vatAmount", F.lit(0)), ("total", 10 * k), ("accountId", F.lit("a")),
            ("accountCode", F.lit("1")), ("created", F.lit("x")))])
    return inv.select(
        F.lit(file).alias("source_file"),
        F.col("invoice_number").cast("int").alias("page_pos"),
        F.col("invoice_id").alias("id"), F.col("invoice_number").alias("number"),
        F.col("customer_id").alias("customerId"),
        (F.lit(status) if status else F.col("status")).alias("status"),
        F.col("total").cast("string").alias("total"),
        F.date_add("invoice_date", shift).cast("string").alias("invoiceDate"),
        F.col("due_date").cast("string").alias("dueDate"),
        *[v.alias(c) for c, v in text.items()],
        F.when(n_lines > 0, F.transform(F.sequence(F.lit(1), F.greatest(n_lines, F.lit(1))), line))
        .alias("lines"))


@register("merge_invoice_versions", f"""
WITH i AS (SELECT *, CAST(invoice_number AS BIGINT) AS k FROM dim_invoices)
SELECT invoice_id, CASE WHEN k % 5 = 0 THEN 'CANCELLED' ELSE status END AS status,
       strftime(invoice_date + CASE WHEN k % 5 = 0 THEN 40 ELSE 0 END, '%Y-%m') AS month,
       {D("total")} AS total,
       CAST(CASE WHEN k % 10 = 0 THEN 0 WHEN k % 5 = 0 THEN 1 ELSE k % 3 + 1 END AS BIGINT) AS n_lines,
       CAST(CASE WHEN k % 10 = 0 THEN 0 WHEN k % 5 = 0 THEN 10
            ELSE 5 * (k % 3 + 1) * (k % 3 + 2) END AS DOUBLE) AS lines_total
FROM i""")
def q_merge_invoice_versions(spark, d):
    """All invoices; then newer documents of every fifth, which move it by 40 days and replace its
    lines, together with older documents of every seventh, which change nothing."""
    path = _folder(spark, "invoices")
    k = F.col("invoice_number").cast("long")
    every = _invoice_documents(spark, d, "b", 0, None, (k % 3 + 1).cast("int"))
    newer = _invoice_documents(spark, d, "c", 40, "CANCELLED", F.when(k % 10 == 0, 0).otherwise(1)) \
        .where(F.col("number").cast("long") % 5 == 0)
    older = _invoice_documents(spark, d, "a", 400, "OLD", F.lit(9)) \
        .where(F.col("number").cast("long") % 7 == 0)
    for docs in (every, newer.unionByName(older)):
        invoice_stream.merge_invoices(spark, docs, path, "2024-01-01", buckets=8)
    lines = invoice_stream.read_invoice_lines(spark, path).groupBy("invoice_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("line_total").alias("t"))
    return invoice_stream.read_invoices(spark, path).join(lines, "invoice_id", "left").select(
        "invoice_id", "status", month_key("invoice_date").alias("month"), "total",
        F.coalesce("n", F.lit(0)).alias("n_lines"), F.coalesce("t", F.lit(0)).alias("lines_total"))


# ------------------------------------------------------------------ J2/J7/D9 with the key index

@register("insert_or_ignore_indexed", NEW_LINES_SQL)
def q_insert_or_ignore_indexed(spark, d):
    keyed = lambda s: LD.statement_keys(
        LD.dealt_by_month(s), near=["month", "month_part"]).drop("month_part")
    s = _stm(spark, d)
    table, root = f"line_keys_{uuid.uuid4().hex}", _folder(spark, "indexed")
    key_index.create(spark, table, "line_key", f"{root}/index",
                     buckets=key_index.buckets_for(s.count()))
    first = s.where(F.col("transaction_date") < F.lit("1998-01-01").cast("date"))
    batch = s.where(F.col("transaction_date") >= F.lit("1997-07-01").cast("date"))
    key_index.load_new_rows(keyed(first), f"{root}/lines", table, "first",
                            dealt=True)
    return key_index.load_new_rows(keyed(batch), f"{root}/lines", table, "second",
                                   dealt=True).drop("month")


# ------------------------------------------------------------------ A11 the persisted gold layer

def _gold(spark, d) -> DataFrame:
    """Monthly sums written from the lines before July 1997 and refreshed by the rest, which
    also changes months that were there."""
    s, path = _stm(spark, d), _folder(spark, "gold")
    day = F.lit("1997-07-15").cast("date")
    gold_store.write_gold(s.where(F.col("transaction_date") < day), path)
    rest = s.where(F.col("transaction_date") >= day)
    gold_store.refresh_gold(s, path, gold_store.touched_months(rest))
    return gold_store.read_gold(spark, path)


def _oracle(name: str) -> str:
    return REGISTRY[name][1]


def _register_over_gold(name: str, like: str):
    """A view over the persisted sums; its SQL is that of the view over the lines."""
    def deco(fn):
        REGISTRY[name] = (fn, _oracle(like))
        return fn
    return deco


@_register_over_gold("gold_store_income_summary_by_year", "gold_income_summary_by_year")
def q_gold_store_income_summary(spark, d):
    return ledger.gold_income_summary_by_year(_gold(spark, d), _acc(spark, d), SINCE)


@_register_over_gold("gold_store_trial_balance_month", "v_trial_balance_month")
def q_gold_store_trial_balance(spark, d):
    from .queries import _groups
    return marts.v_trial_balance_month(marts.fact_month(_gold(spark, d), _acc(spark, d),
                                                        _groups(spark)))


# ------------------------------------------------------------------ J6 the observed load log

LOADS = [("1992-01-01", "1994-12-31"), ("1995-01-01", "1996-12-31"), ("1997-01-01", "2099-12-31"),
         ("2100-01-01", "2100-12-31")]


@register("load_log_observed", " UNION ALL ".join(f"""
SELECT 'manual' AS operation_type, '{a}' AS date_from, '{b}' AS date_to,
       COUNT(*) AS records_loaded, '2024-01-0{i} 00:00:00' AS load_timestamp
FROM silver_account_statements WHERE transaction_date BETWEEN DATE '{a}' AND DATE '{b}'"""
    for i, (a, b) in enumerate(LOADS, 1)))
def q_load_log_observed(spark, d):
    """Loads of spans of dates, the last one without rows; every log entry comes from its write."""
    s, root = _stm(spark, d), _folder(spark, "loads")
    for i, (a, b) in enumerate(LOADS, 1):
        rows = s.where(F.col("transaction_date").between(F.lit(a).cast("date"), F.lit(b).cast("date")))
        LD.load_and_log(spark, rows, f"{root}/lines", f"{root}/log", "manual", a, b,
                        at=f"2024-01-0{i} 00:00:00")
    return spark.read.parquet(f"{root}/log")
