"""Invoice gold views (E17-E20). ``as_of`` replaces the wall-clock ``date('now')``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.invoice import payment_status, status_display
from ..functions.keys import month_key
from ..functions.money import money_avg


def _active(invoices: DataFrame) -> DataFrame:
    return invoices.where(F.col("is_active") == 1)


def _d(c):
    return F.date_format(F.col(c), "yyyy-MM-dd")


def gold_invoice_summary(invoices: DataFrame, as_of: str) -> DataFrame:
    """Active invoices with display status and payment status."""
    i = _active(invoices)
    return i.select(
        "invoice_id", "invoice_number", "customer_id", "status", "currency", "subtotal",
        "vat_amount", "total", _d("invoice_date").alias("invoice_date"),
        _d("due_date").alias("due_date"), _d("final_due_date").alias("final_due_date"),
        "paid_date", "payment_type", "description", "reference",
        status_display("status").alias("status_display"),
        payment_status("status", F.col("due_date"), as_of).alias("payment_status"),
        F.lit(as_of).alias("created_at"),
    )


def gold_invoice_lines(lines: DataFrame, invoices: DataFrame, as_of: str) -> DataFrame:
    """E18 (D3): lines of active invoices, 18 columns. Lines x invoices is a large-large
    equi-join on invoice_id: sort-merge on the key (AQE splits a skewed invoice)."""
    i = _active(invoices).select(
        F.col("invoice_id").alias("__inv"), "invoice_number", "customer_id",
        F.col("status").alias("invoice_status"), _d("invoice_date").alias("invoice_date"),
        F.col("total").alias("invoice_total"))
    j = lines.join(i, lines["invoice_id"] == i["__inv"], "inner")
    return j.select(
        F.col("id").alias("line_id"), "invoice_id", "invoice_number", "customer_id",
        "invoice_status", "invoice_date", "invoice_total", "line_number",
        F.col("description").alias("line_description"), "quantity", "unit_price",
        "discount_percent", "vat_percent", F.col("vat_amount").alias("line_vat_amount"),
        "line_total", "account_id", "account_code", F.lit(as_of).alias("created_at"),
    )


def _status_measures():
    st, tot = F.col("status"), F.col("total")
    return [
        F.count(F.lit(1)).alias("invoice_count"),
        F.count(F.when(st == "PAID", F.lit(1))).alias("paid_count"),
        F.count(F.when(st == "SENT", F.lit(1))).alias("unpaid_count"),
    ], [
        F.sum(tot).alias("total_amount"),
        F.sum(F.when(st == "PAID", tot).otherwise(F.lit(0))).alias("paid_amount"),
        F.sum(F.when(st == "SENT", tot).otherwise(F.lit(0))).alias("unpaid_amount"),
        money_avg(tot).alias("avg_invoice_amount"),
    ]


def gold_invoice_monthly(invoices: DataFrame) -> DataFrame:
    """Month x currency -> counts (all/paid/unpaid/cancelled), amounts, average.
    Invoices without a date are excluded."""
    i = _active(invoices).where(F.col("invoice_date").isNotNull())
    counts, amounts = _status_measures()
    cancelled = F.count(F.when(F.col("status") == "CANCELLED", F.lit(1))).alias("cancelled_count")
    g = i.groupBy(month_key("invoice_date").alias("month"), "currency").agg(
        *counts, cancelled, *amounts)
    return g.select("month", F.substring("month", 1, 4).alias("year"), "invoice_count",
                    "paid_count", "unpaid_count", "cancelled_count", "total_amount",
                    "paid_amount", "unpaid_amount", "avg_invoice_amount", "currency")


def gold_customer_invoices(invoices: DataFrame) -> DataFrame:
    """Customer x currency -> counts, amounts, average, first/last invoice date."""
    i = _active(invoices)
    counts, amounts = _status_measures()
    return i.groupBy("customer_id", "currency").agg(
        *counts, *amounts,
        F.date_format(F.min("invoice_date"), "yyyy-MM-dd").alias("first_invoice"),
        F.date_format(F.max("invoice_date"), "yyyy-MM-dd").alias("last_invoice"),
    )
