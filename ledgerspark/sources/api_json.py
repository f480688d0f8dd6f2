"""Accounting JSON sources (A5-A8): account registry, statement pages, chart of accounts,
invoices.

All are read with a declared schema (no inference pass) and ``multiLine`` (one document per
file); arrays are flattened with ``explode``/``posexplode``, which never moves data between
tasks. Money fields are declared as strings so that numbers *and* numeric strings
(``"amount": "-400.50"``) arrive as text and go through the ANSI-safe parsers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import iso_date
from ..functions.keys import active_flag, first_nonempty
from ..functions.money import debit_of, credit_of, parse_amount_or_zero, parse_quantity

_S, _L = T.StringType(), T.LongType()


def _struct(*names, types=None) -> T.StructType:
    types = types or {}
    return T.StructType([T.StructField(n, types.get(n, _S)) for n in names])


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return (spark.read.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE")
            .option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").json(path))


# ---------------------------------------------------------------------------- A5 registry

REGISTRY_SCHEMA = _struct("name", "number", "category")


def account_registry(spark: SparkSession, path: str) -> DataFrame:
    """A5: bank account registry (JSON array of name/number/category); the number splits
    into branch (4) - ledger (2) - account (6); entries without that shape are dropped."""
    df = _read(spark, path, REGISTRY_SCHEMA)
    digits = "(\\d{4})\\D*(\\d{2})\\D*(\\d{6})"
    out = df.select("name", "number", "category",
                    F.regexp_extract("number", digits, 1).alias("branch"),
                    F.regexp_extract("number", digits, 2).alias("ledger"),
                    F.regexp_extract("number", digits, 3).alias("account_no"))
    return out.where(F.col("branch") != "")


# ---------------------------------------------------------------------------- A6 statements

LINE_FIELDS = ("id", "accountCode", "accountName", "accountType", "accountSubType", "date",
               "description", "reference", "amount", "balance", "currency", "entryId",
               "voucher", "created", "journalId", "journalNumber", "lineNumber")
PAGE_SCHEMA = T.StructType([
    T.StructField("page", _L), T.StructField("pages", _L), T.StructField("total", _L),
    T.StructField("lines", T.ArrayType(_struct(*LINE_FIELDS)))])


#: Where a statement line came from.
PAGE_COLUMNS = ("source_file", "load_window", "page", "pages", "page_pos")


def load_window(source_file: Column, page: Column, pages: Column) -> Column:
    """The load window that a page file belongs to: one request for a span of dates, answered in
    ``pages`` pages. Its pages are files that differ only in the number at the end of their
    names, counted from 0 or 1 like the page numbers inside (``x/page-1.json`` ...); a file
    without such a number, or an answer of one page, is a window of its own."""
    ending = "([0-9]+)\\.json$"
    number = F.regexp_extract(source_file, ending, 1).try_cast("long")
    first = number - page
    stem = F.concat(F.regexp_replace(source_file, ending, ""), F.lit("#"),
                    first.cast("string"), F.lit("/"), pages.cast("string"))
    return F.when((pages > 1) & first.isin(-1, 0), stem).otherwise(source_file)


def page_files(pages: DataFrame) -> DataFrame:
    """Page documents with their file, load window and page numbers, still one row a page."""
    file = F.col("_metadata.file_path")
    return pages.select(file.alias("source_file"), "page", "pages", "lines",
                        load_window(file, F.col("page"), F.col("pages")).alias("load_window"))


def page_lines(files: DataFrame) -> DataFrame:
    """The lines of ``page_files``, with their position in the page (``page_pos``). Pages without
    ``lines`` add nothing."""
    return files.select("source_file", "load_window", "page", "pages",
                        F.posexplode("lines").alias("page_pos", "l")).select(
        "source_file", "load_window", "page", "pages", "page_pos", "l.*")


def statement_pages_source(spark: SparkSession, path: str) -> DataFrame:
    """Every page's ``lines`` concatenated, with the load window, the page number and the
    position of the line in its page (for load-order tie-breaks)."""
    return page_lines(page_files(_read(spark, path, PAGE_SCHEMA)))


def load_statements(lines: DataFrame, typed: bool = True, created_default: str | None = None
                    ) -> DataFrame:
    """Page rows -> ``silver_account_statements`` rows.

    B2 amounts (missing/bad -> 0), B6 debit/credit, B9 defaults (currency ISK, texts '').
    ``typed=False`` writes '' into type/subtype, as the incremental loaders do.
    """
    amount = parse_amount_or_zero("amount")
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    created = F.coalesce(F.nullif(blank("created"), F.lit("")),
                         F.lit(created_default) if created_default else F.current_timestamp().cast("string"))
    return lines.select(
        blank("id").alias("id"),
        blank("accountCode").alias("account_code"),
        blank("id").alias("account_id"),
        blank("accountName").alias("account_name"),
        (blank("accountType") if typed else F.lit("")).alias("account_type"),
        (blank("accountSubType") if typed else F.lit("")).alias("account_subtype"),
        iso_date("date").alias("transaction_date"),
        iso_date("date").alias("journal_date"),
        blank("description").alias("description"),
        blank("reference").alias("reference"),
        amount.alias("amount"),
        debit_of(amount).alias("debit"),
        credit_of(amount).alias("credit"),
        parse_amount_or_zero("balance").alias("balance"),
        first_nonempty("currency", default="ISK").alias("currency"),
        F.coalesce(F.nullif(blank("journalId"), F.lit("")), blank("entryId")).alias("journal_id"),
        F.coalesce(F.nullif(blank("journalNumber"), F.lit("")), blank("voucher")).alias("journal_number"),
        F.coalesce(F.col("lineNumber").try_cast("int"), F.lit(0)).alias("line_number"),
        F.lit("transaction").alias("record_type"),
        created.alias("created_at"),
        # where a row came from, as far as the reader knows it (see ``statement_keys``)
        *[F.col(c) for c in PAGE_COLUMNS if c in lines.columns],
    )


# ---------------------------------------------------------------------------- A7 chart

ACCOUNT_FIELDS = ("id", "code", "name", "type", "subType", "parentId", "isActive", "created",
                  "modified", "accountNumber", "accountName", "accountType", "active")
_ACC = _struct(*ACCOUNT_FIELDS)
ACCOUNTS_SCHEMA = T.StructType(list(_ACC.fields) + [T.StructField("data", T.ArrayType(_ACC))])


def accounts_source(spark: SparkSession, path: str) -> DataFrame:
    """Chart of accounts whether the body is an array or ``{"data": [...]}``."""
    df = _read(spark, path, ACCOUNTS_SCHEMA)
    wrapped = df.where(F.col("data").isNotNull()).select(F.explode("data").alias("a")).select("a.*")
    bare = df.where(F.col("data").isNull()).select(*ACCOUNT_FIELDS)
    return bare.unionByName(wrapped)


def load_accounts(raw: DataFrame, version: int = 2) -> DataFrame:
    """API account records -> ``dim_accounts`` (v1 has no subtype column semantics; both
    accept the older field names accountNumber/accountName/accountType/active)."""
    active = F.when(F.col("isActive").isNotNull(), active_flag("isActive")).otherwise(
        active_flag("active"))
    out = raw.select(
        first_nonempty("id", "code", "accountNumber", default="").alias("account_id"),
        first_nonempty("code", "accountNumber", default="").alias("account_number"),
        first_nonempty("name", "accountName", default="").alias("account_name"),
        first_nonempty("type", "accountType", default="").alias("account_type"),
        (first_nonempty("subType", default="") if version >= 2 else F.lit("")).alias("account_subtype"),
        first_nonempty("parentId", default="").alias("parent_account_id"),
        active.alias("is_active"),
        first_nonempty("created", default="").alias("created_at"),
        first_nonempty("modified", default="").alias("updated_at"),
    )
    return out


# ---------------------------------------------------------------------------- A8 invoices

INVOICE_LINE_FIELDS = ("description", "quantity", "unitPrice", "discountPercent", "vatPercent",
                       "vatAmount", "total", "accountId", "accountCode", "created")
INVOICE_FIELDS = ("id", "number", "customerId", "status", "currency", "subtotal", "vatAmount",
                  "total", "invoiceDate", "dueDate", "finalDueDate", "paidDate", "paymentType",
                  "description", "reference", "isActive", "created", "updated")
_INV = T.StructType([T.StructField(n, _S) for n in INVOICE_FIELDS]
                    + [T.StructField("lines", T.ArrayType(_struct(*INVOICE_LINE_FIELDS)))])
INVOICE_PAGE_SCHEMA = T.StructType([
    T.StructField("data", T.ArrayType(_INV)), T.StructField("invoices", T.ArrayType(_INV))])


def invoices_source(spark: SparkSession, path: str) -> DataFrame:
    """Invoice documents from pages listing them under ``data`` or ``invoices``, with
    their load order (file, position) for last-wins upserts."""
    return invoice_documents(_read(spark, path, INVOICE_PAGE_SCHEMA))


def invoice_documents(pages: DataFrame) -> DataFrame:
    """The documents of page files (read with ``INVOICE_PAGE_SCHEMA``, as batch or stream)."""
    return pages.select(F.col("_metadata.file_path").alias("source_file"),
                        F.posexplode(F.coalesce("data", "invoices")).alias("page_pos", "i")
                        ).select("source_file", "page_pos", "i.*")


def load_invoices(raw: DataFrame, now_iso: str) -> tuple[DataFrame, DataFrame]:
    """Invoice documents -> (``dim_invoices`` rows, ``dim_invoice_lines`` rows).

    Headers default missing text to '' and money to 0 (B2); lines are numbered from 1 in
    document order (``posexplode`` position + 1). The line id is the invoice id and line
    number, stable across re-loads.
    """
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    inv = raw.select(
        blank("id").alias("invoice_id"), blank("number").alias("invoice_number"),
        blank("customerId").alias("customer_id"), blank("status").alias("status"),
        first_nonempty("currency", default="ISK").alias("currency"),
        parse_amount_or_zero("subtotal").alias("subtotal"),
        parse_amount_or_zero("vatAmount").alias("vat_amount"),
        parse_amount_or_zero("total").alias("total"),
        iso_date("invoiceDate").alias("invoice_date"), iso_date("dueDate").alias("due_date"),
        iso_date("finalDueDate").alias("final_due_date"), blank("paidDate").alias("paid_date"),
        blank("paymentType").alias("payment_type"), blank("description").alias("description"),
        blank("reference").alias("reference"), active_flag("isActive").alias("is_active"),
        first_nonempty("created", default=now_iso).alias("created_at"),
        first_nonempty("updated", default=now_iso).alias("updated_at"),
        "source_file", "page_pos")
    lines = raw.select(blank("id").alias("invoice_id"), "source_file", "page_pos",
                       F.posexplode("lines").alias("pos", "l")).select(
        F.concat_ws("#", "invoice_id", (F.col("pos") + 1).cast("string")).alias("id"),
        "invoice_id", (F.col("pos") + 1).alias("line_number"),
        F.coalesce("l.description", F.lit("")).alias("description"),
        parse_quantity("l.quantity").alias("quantity"),
        parse_quantity("l.unitPrice").alias("unit_price"),
        parse_quantity("l.discountPercent").alias("discount_percent"),
        parse_quantity("l.vatPercent").alias("vat_percent"),
        parse_amount_or_zero("l.vatAmount").alias("vat_amount"),
        parse_amount_or_zero("l.total").alias("line_total"),
        F.coalesce("l.accountId", F.lit("")).alias("account_id"),
        F.coalesce("l.accountCode", F.lit("")).alias("account_code"),
        F.coalesce("l.created", F.lit(now_iso)).alias("created_at"), "source_file", "page_pos")
    return inv, lines


def upsert_invoices(target: DataFrame | None, loaded: DataFrame) -> DataFrame:
    """J8 headers with J3 semantics: the last document of an invoice id wins, in load order
    (source file, then position in the page); stored invoices with that id are replaced."""
    from ..operators.loading import insert_or_replace
    cols = [c for c in loaded.columns if c not in ("source_file", "page_pos")]
    if target is None:
        return insert_or_replace(None, loaded, ["invoice_id"], ["source_file", "page_pos"]).select(*cols)
    return insert_or_replace(target.select(*cols), loaded, ["invoice_id"],
                             ["source_file", "page_pos"]).select(*cols)


def upsert_invoice_lines(target: DataFrame | None, new_lines: DataFrame,
                         headers: DataFrame) -> DataFrame:
    """J8 lines: an invoice's lines are replaced as a set by its newest document's lines, also
    where that document has none. ``headers`` are the batch's headers (``load_invoices``), whose
    newest document of an invoice, by source file and position, says which lines count."""
    newest = headers.groupBy("invoice_id").agg(
        F.max(F.struct("source_file", "page_pos")).alias("d")).select(
        "invoice_id", "d.source_file", "d.page_pos")
    lines = new_lines.join(newest, ["invoice_id", "source_file", "page_pos"], "left_semi") \
        .select(*[c for c in new_lines.columns if c not in ("source_file", "page_pos")])
    if target is None:
        return lines
    kept = target.join(newest.select("invoice_id"), "invoice_id", "left_anti")
    return kept.unionByName(lines.select(*target.columns))
