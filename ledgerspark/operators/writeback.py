"""Batch write-backs re-aimed as table transformations (L1-L4).

The reference sends one HTTP request per change; here a whole batch of changes is applied to
the table as a join: the batch is resolved to invoice ids (D7), validated row by row with
``when`` chains, reduced to the last valid change per invoice, and left-joined onto the
table. Rejected changes come back as a second DataFrame with the reason.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import paid_date_norm
from .matching import number_to_uuid

# --- fixed values: update modes, explicit statuses, journal enums, limits --------------------
MODES = ("mark_as_paid", "resend_email", "cancel_claim", "payment_extension", "cancel_invoice",
         "update_draft")
OVERRIDE_STATUSES = ("PAID", "CANCELLED", "SENT")
VAT_TYPES = ("NoVAT", "ReducedVAT", "StandardVAT", "NotSet")
JOURNAL_STATUSES = ("DRAFT", "POST")
DESCRIPTION_MAX = 100
DRAFT_FIELDS = ("description", "reference", "currency", "due_date", "final_due_date",
                "customer_id", "payment_type")
# -----------------------------------------------------------------------------------------------


def apply_invoice_updates(invoices: DataFrame, updates: DataFrame, now_iso: str,
                          order_col: str = "seq") -> tuple[DataFrame, DataFrame]:
    """L1: (new invoice table, per-update results).

    updates: (seq, invoice_ref, mode, status, paid_date, payment_type, draft_data MAP).
    mark_as_paid needs payment_type (-> PAID, paid date; a bare date becomes noon UTC, a
    missing one ``now_iso``); resend_email -> SENT; cancel_invoice -> CANCELLED;
    cancel_claim / payment_extension set flags; update_draft needs draft_data (known keys
    overwrite columns). Explicit status / paid date / payment type override afterwards (the
    paid date keeps its noon normalisation). Several updates of one invoice apply in order:
    for each field the last value given stands, and flags once set stay set. A draft with an
    unknown key, or a value that its column cannot take, is rejected.
    """
    u = number_to_uuid(updates, invoices)
    mode, st = F.col("mode"), F.col("status")
    kinds = {c: invoices.schema[c].dataType for c in DRAFT_FIELDS if c in invoices.columns}
    unfit = F.lit(False)
    for c, kind in kinds.items():
        given = F.col("draft_data")[c]
        unfit = unfit | (given.isNotNull() & given.try_cast(kind).isNull())
    error = (F.when(~F.col("resolved"), F.lit("NOT_FOUND"))
             .when(~mode.isin(*MODES) | mode.isNull(), F.lit("VALIDATION_ERROR: invalid mode"))
             .when((mode == "mark_as_paid") & (F.coalesce(F.col("payment_type"), F.lit("")) == ""),
                   F.lit("VALIDATION_ERROR: mark_as_paid needs a payment type"))
             .when((mode == "update_draft") & F.col("draft_data").isNull(),
                   F.lit("VALIDATION_ERROR: update_draft needs draft data"))
             .when(st.isNotNull() & ~st.isin(*OVERRIDE_STATUSES),
                   F.lit("VALIDATION_ERROR: invalid status"))
             .when((mode == "update_draft") & F.exists(
                 F.map_keys("draft_data"), lambda k: ~k.isin(*DRAFT_FIELDS)),
                   F.lit("VALIDATION_ERROR: unknown field in the draft"))
             .when((mode == "update_draft") & unfit,
                   F.lit("VALIDATION_ERROR: a value of the draft does not fit its field")))
    u = u.withColumn("error", error)
    new_status = (F.when(mode == "mark_as_paid", F.lit("PAID"))
                  .when(mode == "resend_email", F.lit("SENT"))
                  .when(mode == "cancel_invoice", F.lit("CANCELLED")))
    new_status = F.coalesce(st, new_status)
    paid = F.when((mode == "mark_as_paid") | F.col("paid_date").isNotNull(),
                  paid_date_norm("paid_date", now_iso))
    changes = u.where(F.col("error").isNull()).select(
        "invoice_id", order_col, new_status.alias("__status"), paid.alias("__paid"),
        F.col("payment_type").alias("__ptype"),
        (mode == "cancel_claim").alias("__claim"), (mode == "payment_extension").alias("__ext"),
        *[F.when(mode == "update_draft", F.col("draft_data")[c]).alias(f"__draft_{c}")
          for c in kinds])

    def last(c):
        """The latest value given for a field; NULL where no update gives one."""
        return F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order_col))).alias(c)
    merged = changes.groupBy("invoice_id").agg(
        *[last(c) for c in changes.columns if c not in ("invoice_id", order_col, "__claim",
                                                        "__ext")],
        F.bool_or("__claim").alias("__claim"), F.bool_or("__ext").alias("__ext"))
    j = invoices.join(merged, "invoice_id", "left")
    cols = []
    for c in invoices.columns:
        v = F.col(c)
        if c in kinds:
            v = F.coalesce(F.col(f"__draft_{c}").try_cast(kinds[c]), v)
        if c == "status":
            v = F.coalesce("__status", v)
        elif c == "paid_date":
            v = F.coalesce("__paid", v)
        elif c == "payment_type":
            v = F.coalesce("__ptype", v)
        cols.append(v.alias(c))
    out = j.select(*cols,
                   F.coalesce("__claim", F.lit(False)).alias("claim_cancelled"),
                   F.coalesce("__ext", F.lit(False)).alias("payment_extended"))
    results = u.select(order_col, "invoice_ref", "invoice_id", "mode",
                       F.when(F.col("error").isNull(), F.lit("OK")).otherwise(
                           F.split("error", ":")[0]).alias("outcome"),
                       F.col("error").alias("message"))
    return out, results


def validate_journal(journals: DataFrame) -> DataFrame:
    """L2: per journal (id, date, description, status, lines ARRAY<STRUCT>) the validation
    errors (empty array = valid) and the effective status (default DRAFT)."""
    line_party_count = lambda l: (
        F.when(F.coalesce(l["ledgerAccountId"], F.lit("")) != "", 1).otherwise(0)
        + F.when(F.coalesce(l["customerId"], F.lit("")) != "", 1).otherwise(0)
        + F.when(F.coalesce(l["creditorId"], F.lit("")) != "", 1).otherwise(0))
    lines = F.coalesce(F.col("lines"), F.array())
    checks = [
        (~F.coalesce(F.col("date"), F.lit("")).rlike("^\\d{4}-\\d{2}-\\d{2}$")
         | F.try_to_date(F.col("date"), "yyyy-MM-dd").isNull(), "date must be YYYY-MM-DD"),
        (F.length(F.coalesce("description", F.lit(""))) > DESCRIPTION_MAX,
         f"description longer than {DESCRIPTION_MAX} characters"),
        (F.size(lines) < 1, "at least one line is required"),
        (F.exists(lines, lambda l: line_party_count(l) != 1),
         "exactly one of ledgerAccountId, customerId, creditorId per line"),
        (F.exists(lines, lambda l: l["vatPercentType"].isNotNull()
                  & ~l["vatPercentType"].isin(*VAT_TYPES)), "invalid vatPercentType"),
        (F.exists(lines, lambda l: l["amount"].isNull()), "line amount is required"),
        (F.col("status").isNotNull() & ~F.col("status").isin(*JOURNAL_STATUSES), "invalid status"),
    ]
    errs = F.filter(F.array(*[F.when(c, F.lit(msg)) for c, msg in checks]), lambda x: x.isNotNull())
    return journals.select("*", errs.alias("errors"),
                           F.coalesce("status", F.lit("DRAFT")).alias("effective_status"))


def expand_journal_lines(journals: DataFrame) -> DataFrame:
    """L3: journal lines as rows; a line with ``balancingLedgerAccountId`` adds the opposite
    amount on that account when the journal is posted."""
    l = journals.select("journal_id", F.coalesce("status", F.lit("DRAFT")).alias("status"),
                        F.posexplode("lines").alias("line_no", "l"))
    base = F.struct(F.col("l.amount").alias("amount"),
                    F.col("l.ledgerAccountId").alias("ledger_account_id"),
                    F.col("l.customerId").alias("customer_id"),
                    F.col("l.creditorId").alias("creditor_id"), F.lit(False).alias("balancing"))
    opposite = F.struct((-F.col("l.amount")).alias("amount"),
                        F.col("l.balancingLedgerAccountId").alias("ledger_account_id"),
                        F.lit(None).cast("string").alias("customer_id"),
                        F.lit(None).cast("string").alias("creditor_id"), F.lit(True).alias("balancing"))
    with_bal = (F.col("status") == "POST") & F.col("l.balancingLedgerAccountId").isNotNull()
    arr = F.when(with_bal, F.array(base, opposite)).otherwise(F.array(base))
    return l.select("journal_id", "status", "line_no", F.explode(arr).alias("x")).select(
        "journal_id", "status", "line_no", "x.*")


def post_journal(journals: DataFrame, to_post: DataFrame) -> tuple[DataFrame, DataFrame]:
    """L4: DRAFT -> POST for the journal ids in ``to_post``; anything else is rejected
    (already posted, or unknown)."""
    req = to_post.select("journal_id").distinct().withColumn("__req", F.lit(True))
    j = journals.join(req, "journal_id", "left")
    eff = F.coalesce("status", F.lit("DRAFT"))
    out = j.withColumn("status", F.when(F.col("__req") & (eff == "DRAFT"), F.lit("POST"))
                       .otherwise(F.col("status"))).drop("__req")
    known = journals.select("journal_id", eff.alias("__st"))
    res = req.join(known, "journal_id", "left").select(
        "journal_id", F.when(F.col("__st").isNull(), F.lit("NOT_FOUND"))
        .when(F.col("__st") == "DRAFT", F.lit("OK")).otherwise(F.lit("ALREADY_POSTED")).alias("outcome"))
    return out, res
