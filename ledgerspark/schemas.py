"""Declared schemas of the silver, dim and control tables.

Money is ``DECIMAL(18,2)``: exact, so sums do not depend on partitioning or task order.
Dates are ``DATE`` at silver (typed, pushdown-friendly); month / year keys are ISO strings.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)

_S, _D, _I, _L, _DT, _TS = (T.StringType(), MONEY, T.IntegerType(), T.LongType(),
                            T.DateType(), T.TimestampType())


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


SILVER_BANK_ACCOUNTS = _struct(
    ("branch", _S, False), ("ledger", _S, False), ("account_no", _S, False),
    ("display_number", _S, True), ("currency", _S, True), ("status", _S, True),
    ("first_seen_at", _TS, True),
)

SILVER_BANK_TRANSACTIONS = _struct(
    ("id", _S, False), ("branch", _S, False), ("ledger", _S, False), ("account_no", _S, False),
    ("booking_date", _DT, True), ("value_date", _DT, True), ("amount", _D, True),
    ("currency", _S, True), ("balance", _D, True), ("reference", _S, True),
    ("text_key", _S, True), ("payer_ssn", _S, True), ("rb_batchno", _S, True),
    ("type_code", _S, True), ("description", _S, True), ("raw_hash", _S, True),
    ("source_period", _S, True), ("ingested_at", _TS, True),
)

SILVER_CREDITCARD_TRANSACTIONS = _struct(
    ("card_id", _S, False), ("entry_id", _S, False), ("kind", _S, False),
    ("clearance_id", _S, True), ("date", _DT, True), ("amount", _D, True),
    ("foreign_amount", _D, True), ("currency", _S, True), ("foreign_currency", _S, True),
    ("merchant_id", _S, True), ("merchant_name", _S, True), ("trans_key", _S, True),
    ("trans_descriptor", _S, True), ("due_date", _S, True), ("mcc", _S, True),
    ("description", _S, True), ("raw_hash", _S, True), ("source_period", _S, True),
    ("ingested_at", _TS, True),
)

DIM_ACCOUNTS = _struct(
    ("account_id", _S, False), ("account_number", _S, True), ("account_name", _S, True),
    ("account_type", _S, True), ("account_subtype", _S, True), ("parent_account_id", _S, True),
    ("is_active", _I, True), ("created_at", _S, True), ("updated_at", _S, True),
)

SILVER_ACCOUNT_STATEMENTS = _struct(
    ("id", _S, False), ("account_code", _S, True), ("account_id", _S, True),
    ("account_name", _S, True), ("account_type", _S, True), ("account_subtype", _S, True),
    ("transaction_date", _DT, True), ("journal_date", _DT, True), ("description", _S, True),
    ("reference", _S, True), ("amount", _D, True), ("debit", _D, True), ("credit", _D, True),
    ("balance", _D, True), ("currency", _S, True), ("journal_id", _S, True),
    ("journal_number", _S, True), ("line_number", _I, True), ("record_type", _S, True),
    ("created_at", _S, True),
)

DIM_INVOICES = _struct(
    ("invoice_id", _S, False), ("invoice_number", _S, True), ("customer_id", _S, True),
    ("status", _S, True), ("currency", _S, True), ("subtotal", _D, True),
    ("vat_amount", _D, True), ("total", _D, True), ("invoice_date", _DT, True),
    ("due_date", _DT, True), ("final_due_date", _DT, True), ("paid_date", _S, True),
    ("payment_type", _S, True), ("description", _S, True), ("reference", _S, True),
    ("is_active", _I, True), ("created_at", _S, True), ("updated_at", _S, True),
)

DIM_INVOICE_LINES = _struct(
    ("id", _S, False), ("invoice_id", _S, False), ("line_number", _I, True),
    ("description", _S, True), ("quantity", _D, True), ("unit_price", _D, True),
    ("discount_percent", _D, True), ("vat_percent", _D, True), ("vat_amount", _D, True),
    ("line_total", _D, True), ("account_id", _S, True), ("account_code", _S, True),
    ("created_at", _S, True),
)

LOAD_LOG = _struct(
    ("operation_type", _S, False), ("date_from", _S, False), ("date_to", _S, False),
    ("records_loaded", _L, True), ("load_timestamp", _TS, False),
)

ACCOUNT_GROUPS = _struct(
    ("acct_type", _S, True), ("acct_subtype", _S, True), ("report_group", _S, True),
    ("report_subgroup", _S, True), ("statement", _S, True), ("sign", _I, True),
)

PAYMENT_TYPES = _struct(
    ("id", _S, False), ("title", _S, True), ("description", _S, True), ("created", _S, True),
    ("currency", _S, True),
)
