"""Registered queries of parsers, raw sources and write-backs. Their raw inputs (texts in several
notations, statement XML, API lines, journals) are made by Spark from the provided tables, so that
the result has to be what the table says; the SQL reads the table itself."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import standins as S
from .functions import currency as CU, dates as DT, keys as K, money as MO, text as TX
from .operators import loading as LD, search, writeback as WB
from .oracle_sql import D
from .queries import _pt, _PT_SQL, _acc, _stm, register
from .sources import api_json as J, statement_xml as X


# ------------------------------------------------------------------ B1-B6, B25 amounts

def _amounts(spark, d) -> DataFrame:
    """Order totals, every other one negative, as texts in the notations of the sources; some
    are empty (k % 7 = 0) or no numbers (k % 11 = 0)."""
    total = (F.col("total") * F.when(F.col("k") % 2 == 0, -1).otherwise(1)).cast("decimal(18,2)")
    a = S.dim_invoices(spark, d).select(F.col("invoice_number").cast("long").alias("k"), "total") \
        .withColumn("total", total)
    point = F.col("total").cast("string")
    groups = F.format_number("total", 2)                              # -1,234.50
    icelandic = F.translate(groups, ",.", ".,")                       # -1.234,50

    def odd(c: Column) -> Column:
        return F.when(F.col("k") % 7 == 0, "").when(F.col("k") % 11 == 0, "abc").otherwise(c)
    return a.select("k", "total", odd(F.translate(point, ".", ",")).alias("xml"),
                    odd(F.concat(F.lit(" "), point, F.lit(" kr"))).alias("api"),
                    odd(F.concat(icelandic, F.lit(" kr."))).alias("sheet"),
                    odd(icelandic).alias("icelandic"),
                    odd(F.concat(F.lit("$"), groups)).alias("english"))


@register("parse_amount_texts", f"""
WITH a AS (SELECT CAST(invoice_number AS BIGINT) AS k, total FROM dim_invoices),
v AS (SELECT k, k % 7 = 0 OR k % 11 = 0 AS odd,
             CASE WHEN k % 2 = 0 THEN -total ELSE total END AS v FROM a)
SELECT k, {D("CASE WHEN NOT odd THEN v END")} AS xml, {D("CASE WHEN odd THEN 0 ELSE v END")} AS api,
       {D("CASE WHEN odd THEN 0 ELSE v END")} AS sheet,
       {D("CASE WHEN odd THEN 0 ELSE v END")} AS icelandic,
       {D("CASE WHEN NOT odd THEN v END")} AS english,
       {D("CASE WHEN odd THEN 0 WHEN v < 0 THEN -v ELSE 0 END")} AS debit,
       {D("CASE WHEN odd THEN 0 WHEN v > 0 THEN v ELSE 0 END")} AS credit,
       CAST(v AS DOUBLE) / 1000000.0 AS millions
FROM v""")
def q_parse_amount_texts(spark, d):
    api = MO.parse_amount_or_zero("api")
    return _amounts(spark, d).select(
        "k", MO.parse_amount_xml("xml").alias("xml"), api.alias("api"),
        MO.parse_amount_keep("sheet").alias("sheet"),
        MO.parse_amount_is("icelandic").alias("icelandic"),
        MO.parse_amount_en("english").alias("english"), MO.debit_of(api).alias("debit"),
        MO.credit_of(api).alias("credit"), MO.to_millions("total").alias("millions"))


# ------------------------------------------------------------------ B13, B14 dates

@register("parse_sheet_dates", """
WITH v AS (SELECT CAST(invoice_number AS BIGINT) AS k, invoice_date FROM dim_invoices)
SELECT k, CASE WHEN k % 5 < 3 THEN CAST(invoice_date AS VARCHAR) END AS sheet_date,
       CASE WHEN k % 5 < 4 THEN CAST(invoice_date AS VARCHAR) END AS serial_date,
       CASE WHEN k % 5 < 4 THEN CAST(invoice_date AS VARCHAR) END AS iso_date
FROM v""")
def q_parse_sheet_dates(spark, d):
    k, day = F.col("k") % 5, F.col("invoice_date")
    v = S.dim_invoices(spark, d).select(F.col("invoice_number").cast("long").alias("k"), "invoice_date")
    serial = F.datediff(day, F.lit("1970-01-01").cast("date")) + DT.EXCEL_EPOCH_SERIAL
    return v.select(
        "k",
        DT.parse_sheet_date(F.when(k == 0, F.date_format(day, "dd.MM.yyyy"))
                            .when(k == 1, F.date_format(day, "d.M.yyyy"))
                            .when(k == 2, day.cast("string"))
                            .when(k == 3, F.date_format(day, "'32.13.'yyyy"))
                            .otherwise("no date")).alias("sheet_date"),
        DT.excel_serial_date(F.when(k == 0, serial.cast("string"))
                             .when(k < 4, F.concat(serial.cast("string"), F.lit(".75")))
                             .otherwise("x")).alias("serial_date"),
        DT.iso_date(F.when(k < 2, day.cast("string"))
                    .when(k < 4, F.concat(day.cast("string"), F.lit("T10:00:00Z")))
                    .otherwise("")).alias("iso_date"))


# ------------------------------------------------------------------ B8-B10, B12, B16-B18, B24 texts

@register("parse_account_texts", """
WITH v AS (SELECT CAST(customer_id AS BIGINT) AS k, name FROM customers)
SELECT k, CASE WHEN k % 4 = 0 THEN '' ELSE '0101-26-' || lpad(CAST(k AS VARCHAR), 6, '0') END AS account,
       CASE WHEN k % 4 = 0 THEN '' ELSE name END AS account_name,
       CASE k % 3 WHEN 0 THEN 'GBP' WHEN 1 THEN 'EUR' ELSE 'ISK' END AS by_name,
       CASE WHEN k % 2 = 1 THEN 'ISK' WHEN k % 3 = 0 THEN 'GBP' WHEN k % 3 = 1 THEN 'EUR' ELSE 'ISK' END
         AS by_type,
       CASE k % 4 WHEN 0 THEN 'GBP' WHEN 1 THEN 'EUR' WHEN 2 THEN 'ISK' END AS by_text,
       replace(name, '#', '') || '_' || CAST(k AS VARCHAR) AS title,
       CASE WHEN k % 3 = 0 THEN 'third' WHEN k % 3 = 1 THEN 'second' ELSE 'first' END AS chosen,
       CASE WHEN k % 5 IN (0, 1) THEN 0 ELSE 1 END AS active,
       sha1('{"k":' || CAST(k AS VARCHAR) || ',"name":"' || name || '"}') AS hash
FROM v""")
def q_parse_account_texts(spark, d):
    k, name, lit = F.col("k"), F.col("name"), F.lit
    v = S.customers(spark, d).select(F.col("customer_id").cast("long").alias("k"), "name")
    line = F.when(k % 4 == 0, "no number here").otherwise(
        F.concat(lit("Yfirlit 0101-26-"), F.lpad(k.cast("string"), 6, "0"), lit("   "), name, lit(" ")))
    file = F.concat(lit("statement "), F.when(k % 3 == 0, "GBP").when(k % 3 == 1, "EUR")
                    .otherwise("2024"), lit(".csv"))
    copy = F.concat(lit("sheet "), F.when(k % 3 == 0, "(2)").when(k % 3 == 1, "(3)").otherwise(""))
    kind = F.when(k % 2 == 0, "Erlendur reikningur").otherwise("Veltureikningur")
    row = F.when(k % 4 == 0, "sent £5").when(k % 4 == 1, "EUR 7").when(k % 4 == 2, "12 kr.") \
        .otherwise("none")
    return v.select(
        "k", TX.account_number_from_text(line).alias("account"),
        TX.account_name_from_text(line).alias("account_name"),
        CU.currency_from_name(file).alias("by_name"), CU.currency_from_type(kind, copy).alias("by_type"),
        CU.currency_hint_from_text(row).alias("by_text"),
        K.clean_title(F.concat(name, lit("! "), k.cast("string"))).alias("title"),
        K.first_nonempty(F.when(k % 3 == 2, "first").otherwise(""),
                         F.when(k % 3 == 1, "second"), default="third").alias("chosen"),
        K.active_flag(F.when(k % 5 == 0, "false").when(k % 5 == 1, "0").when(k % 5 == 2, "true")
                      .when(k % 5 == 3, "1")).alias("active"),
        K.raw_hash("k", "name").alias("hash"))


# ------------------------------------------------------------------ B19 exchange rates

@register("fx_to_isk", f"""
SELECT invoice_id, currency, CAST(CAST(total AS DECIMAL(18,2)) * rate AS DOUBLE) AS total_isk,
       CAST(CAST(vat_amount AS DECIMAL(18,2)) * rate AS DOUBLE) AS vat_amount_isk
FROM dim_invoices JOIN (VALUES ('EUR', 150.25::DECIMAL(12,6)), ('GBP', 175.125), ('USD', 1), ('ISK', 1))
  r(currency, rate) USING (currency)""")
def q_fx_to_isk(spark, d):
    rates = CU.fx_rates(spark, {"EUR": 150.25, "GBP": 175.125})
    return CU.fx_to_isk(S.dim_invoices(spark, d), ["total", "vat_amount"], rates).select(
        "invoice_id", "currency", "total_isk", "vat_amount_isk")


# ------------------------------------------------------------------ A1-A4, H2 statement XML

def _element(name: str, value) -> Column:
    return F.concat(F.lit(f"<{name}>"), F.coalesce(value.cast("string"), F.lit("")),
                    F.lit(f"</{name}>"))


def _documents(rows: DataFrame, keys: list[str], body: Column, head: str, tail: str,
               path: Column) -> DataFrame:
    """One XML document (file_path, value) a file: the rows of one account and month; every
    document is also there as an error body in another folder, which has to be set aside."""
    whole = rows.groupBy(*keys).agg(F.array_join(F.collect_list(body), "").alias("body"))
    good = whole.select(path.alias("file_path"), F.concat(
        F.lit('<?xml version="1.0" encoding="iso-8859-1"?>' + head), "body", F.lit(tail)).alias("value"))
    return good.unionByName(good.select(F.concat(F.lit("err/"), "file_path").alias("file_path"),
                                        F.lit("<LI_Villa><code>1</code></LI_Villa>").alias("value")))


@register("bank_xml_rows", f"""
SELECT id, branch, ledger, account_no, CAST(booking_date AS VARCHAR) AS booking_date,
       {D("amount")} AS amount, 'ISK' AS currency, {D("balance")} AS balance, reference, text_key,
       type_code, description, source_period
FROM silver_bank_transactions""")
def q_bank_xml_rows(spark, d):
    t = S.silver_bank_transactions(spark, d)
    c = F.col
    body = F.concat(F.lit("<faersla>"), *[_element(n, v) for n, v in (
        ("bokunardags", c("booking_date")), ("vaxtadags", c("value_date")),
        ("rb_bunkanr", c("rb_batchno")), ("faerslulykill", c("type_code")),
        ("tilvisun", c("reference")), ("textalykill", c("text_key")),
        ("skyring_textalykils", c("description")),
        ("upphaed", F.translate(c("amount").cast("string"), ".", ",")),
        ("stada_reiknings", c("balance")))], F.lit("</faersla>"))
    files = _documents(t, ["branch", "ledger", "account_no", "source_period"], body,
                       "<svar><mynt>ISK</mynt><faerslur>", "</faerslur></svar>",
                       F.concat(F.concat_ws("-", "branch", "ledger", "account_no"), F.lit("/"),
                                "source_period", F.lit(".xml")))
    return X.bank_transactions(X.parse_bank_files(files)).select(
        "id", "branch", "ledger", "account_no", "booking_date", "amount", "currency", "balance",
        "reference", "text_key", "type_code", "description", "source_period")


@register("card_xml_rows", f"""
SELECT card_id, entry_id, kind, CAST(date AS VARCHAR) AS date, {D("amount")} AS amount, currency,
       CASE WHEN kind = 'withdrawal' THEN merchant_name END AS merchant_name,
       CASE WHEN kind = 'deposit' THEN description END AS description, source_period
FROM silver_card_transactions""")
def q_card_xml_rows(spark, d):
    c = F.col
    t = S.silver_card_transactions(spark, d)
    out = c("kind") == "withdrawal"
    both = [("entry_id", c("entry_id")), ("date", c("date")), ("amount", F.abs("amount")),
            ("currency", c("currency"))]
    rows = t.groupBy("card_id", "source_period").agg(*[
        F.array_join(F.collect_list(F.when(side, F.concat(
            F.lit(f"<{tag}>"), *[_element(n, v) for n, v in both + [more]], F.lit(f"</{tag}>")))), "")
        .alias(tag) for tag, side, more in (
            ("withdrawal", out, ("merchant_name", c("merchant_name"))),
            ("deposit", ~out, ("description", c("description"))))])
    files = rows.select(
        F.concat("card_id", F.lit("/"), "source_period", F.lit(".xml")).alias("file_path"),
        F.concat(F.lit("<svar><balance>1</balance><withdrawals>"), "withdrawal",
                 F.lit("</withdrawals><deposits>"), "deposit", F.lit("</deposits></svar>")).alias("value"))
    signed = F.when(c("kind") == "deposit", F.abs("amount")).otherwise(c("amount"))
    return X.card_transactions(X.parse_card_files(files)).select(
        "card_id", "entry_id", "kind", "date", signed.alias("amount"), "currency", "merchant_name",
        "description", "source_period")


@register("rejected_xml_files", """
SELECT 'err/' || branch || '-' || ledger || '-' || account_no || '/' || source_period || '.xml' AS file_path,
       source_period, 'error_body' AS reject_reason
FROM silver_bank_transactions GROUP BY branch, ledger, account_no, source_period""")
def q_rejected_xml_files(spark, d):
    t = S.silver_bank_transactions(spark, d)
    files = _documents(t, ["branch", "ledger", "account_no", "source_period"], F.lit(""),
                       "<svar><mynt>ISK</mynt>", "</svar>",
                       F.concat(F.concat_ws("-", "branch", "ledger", "account_no"), F.lit("/"),
                                "source_period", F.lit(".xml")))
    return X.rejected_files(X.parse_bank_files(files))


# ------------------------------------------------------------------ J1, J9 API rows

@register("load_statement_rows", f"""
SELECT id, account_code, account_name, CAST(transaction_date AS VARCHAR) AS transaction_date,
       description, {D("amount")} AS amount, {D("debit")} AS debit, {D("credit")} AS credit,
       {D("CASE WHEN line_number % 2 = 0 THEN 0 ELSE balance END")} AS balance, currency, journal_id,
       journal_number, line_number, record_type
FROM silver_account_statements""")
def q_load_statement_rows(spark, d):
    s, even = _stm(spark, d), F.col("line_number") % 2 == 0
    text = {c: F.lit(None).cast("string") for c in ("accountType", "accountSubType", "reference", "created")}
    lines = s.select(
        "id", F.col("account_code").alias("accountCode"), F.col("account_name").alias("accountName"),
        F.concat(F.col("transaction_date").cast("string"), F.when(even, "T00:00:00").otherwise(""))
        .alias("date"), "description", F.col("amount").cast("string").alias("amount"),
        F.when(even, "").otherwise(F.col("balance").cast("string")).alias("balance"),
        F.when(F.col("currency") == "ISK", "").otherwise(F.col("currency")).alias("currency"),
        F.when(even, F.col("journal_id")).alias("journalId"), F.col("journal_id").alias("entryId"),
        F.when(even, F.col("journal_number")).otherwise("").alias("journalNumber"),
        F.col("journal_number").alias("voucher"), F.col("line_number").cast("string").alias("lineNumber"),
        *[v.alias(c) for c, v in text.items()])
    return J.load_statements(lines, created_default="x").select(
        "id", "account_code", "account_name", "transaction_date", "description", "amount", "debit",
        "credit", "balance", "currency", "journal_id", "journal_number", "line_number", "record_type")


@register("load_account_rows", """
SELECT account_id, account_number, account_name, account_type, account_subtype, is_active
FROM dim_accounts""")
def q_load_account_rows(spark, d):
    """Half of the records have the older field names."""
    a, old = _acc(spark, d), F.pmod(F.crc32("account_id"), F.lit(2)) == 0
    active = (F.col("is_active") == 1).cast("string")

    def either(newer: str, older: str, value: str | Column) -> list[Column]:
        v = F.col(value) if isinstance(value, str) else value
        return [F.when(~old, v).alias(newer), F.when(old, v).alias(older)]
    raw = a.select(F.col("account_id").alias("id"), *either("code", "accountNumber", "account_number"),
                   *either("name", "accountName", "account_name"),
                   *either("type", "accountType", "account_type"),
                   F.col("account_subtype").alias("subType"), *either("isActive", "active", active),
                   *[F.lit(None).cast("string").alias(c) for c in ("parentId", "created", "modified")])
    return J.load_accounts(raw).select("account_id", "account_number", "account_name", "account_type",
                                       "account_subtype", "is_active")


# ------------------------------------------------------------------ J4, C9

@register("update_account_meta", """
WITH months AS (
  SELECT branch, ledger, account_no, source_period,
         MAX(CASE WHEN CAST(reference AS BIGINT) % 3 > 0 THEN currency || '-' || source_period END) AS currency,
         MAX(CASE WHEN CAST(reference AS BIGINT) % 7 = 0 THEN 'closed ' || reference END) AS status
  FROM (SELECT * REPLACE (strftime(booking_date, '%Y-%m-') || CASE WHEN day(booking_date) < 16 THEN 'a'
                          ELSE 'b' END AS source_period) FROM silver_bank_transactions) t
  GROUP BY 1, 2, 3, 4)
SELECT branch, ledger, account_no,
       COALESCE(arg_max(currency, source_period) FILTER (WHERE currency IS NOT NULL),
                CASE WHEN CAST(account_no AS BIGINT) % 2 = 0 THEN 'OLD' END) AS currency,
       COALESCE(arg_max(status, source_period) FILTER (WHERE status IS NOT NULL),
                CASE WHEN CAST(account_no AS BIGINT) % 2 = 0 THEN 'open' END) AS status
FROM months GROUP BY branch, ledger, account_no""")
def q_update_account_meta(spark, d):
    """Half of the accounts are known already; their stored values stay where no period has one."""
    half = F.concat(F.date_format("booking_date", "yyyy-MM-"),
                    F.when(F.dayofmonth("booking_date") < 16, "a").otherwise("b"))
    number = F.col("reference").cast("long")
    key = ["branch", "ledger", "account_no"]
    t = S.silver_bank_transactions(spark, d).withColumn("source_period", half)
    meta = t.groupBy(*key, "source_period").agg(
        F.max(F.when(number % 3 > 0, F.concat_ws("-", "currency", "source_period"))).alias("currency"),
        F.max(F.when(number % 7 == 0, F.concat(F.lit("closed "), "reference"))).alias("status")) \
        .withColumn("display_number", F.concat_ws("-", *key))
    stored = t.select(*key).distinct().where(F.col("account_no").cast("long") % 2 == 0).select(
        *key, F.concat_ws("-", *key).alias("display_number"), F.lit("OLD").alias("currency"),
        F.lit("open").alias("status"), F.lit("2020-01-01").cast("timestamp").alias("first_seen_at"))
    return LD.update_account_meta(stored, meta).select(*key, "currency", "status")


@register("payment_type_usage", f"""
WITH pt AS ({_PT_SQL}),
used AS (SELECT currency, COUNT(*) AS n FROM dim_invoices GROUP BY currency)
SELECT pt.id, pt.title, pt.currency, CAST(COALESCE(n, 0) AS BIGINT) AS invoices
FROM pt LEFT JOIN used ON used.currency = pt.currency
WHERE lower(pt.title) LIKE '%account%' OR lower(pt.description) LIKE '%account%'""")
def q_payment_type_usage(spark, d):
    """The payment types that a query finds, with the invoices in their currency."""
    used = S.dim_invoices(spark, d).groupBy("currency").agg(F.count(F.lit(1)).alias("n"))
    found = search.payment_types(_pt(spark), "ACCOUNT").select("id", "title", "currency")
    return used.join(found, "currency", "right").select(
        "id", "title", "currency", F.coalesce("n", F.lit(0)).alias("invoices"))


# ------------------------------------------------------------------ L2-L4 journals

def _journals(spark, d) -> DataFrame:
    """A journal an invoice, with its lines; some break a rule each."""
    text = lambda c: F.col(c).cast("string")                                       # noqa: E731
    number = F.col("line_number")
    line = F.struct(
        "line_number", F.when(number != 6, F.col("line_total")).alias("amount"),
        F.when(number == 5, "Wrong").when(number % 2 == 0, "NoVAT").alias("vatPercentType"),
        text("account_code").alias("ledgerAccountId"),
        F.when(number == 7, "c1").alias("customerId"), F.lit(None).cast("string").alias("creditorId"),
        F.when(number % 2 == 1, F.concat(F.lit("b"), F.substring("account_code", -1, 1)))
        .alias("balancingLedgerAccountId"))
    lines = S.dim_invoice_lines(spark, d).groupBy("invoice_id").agg(
        F.sort_array(F.collect_list(line)).alias("lines"))
    k = F.col("k")
    head = S.dim_invoices(spark, d).select(
        "invoice_id", F.col("invoice_number").cast("long").alias("k"),
        F.col("invoice_date").cast("string").alias("day"))
    return head.join(lines, "invoice_id", "left").select(
        F.col("invoice_id").alias("journal_id"), "k",
        F.when(k % 11 == 0, F.translate("day", "-", "/")).otherwise(F.col("day")).alias("date"),
        F.repeat(F.lit("x"), F.when(k % 13 == 0, 101).otherwise(100)).alias("description"),
        F.when(k % 17 == 0, "WRONG").when(k % 3 == 1, "DRAFT").when(k % 3 == 2, "POST").alias("status"),
        "lines")


_JOURNALS_SQL = """
l AS (SELECT invoice_id, COUNT(*) AS n, bool_or(line_number = 5) AS vat, bool_or(line_number = 6) AS amount,
             bool_or(line_number = 7) AS party FROM dim_invoice_lines GROUP BY invoice_id),
j AS (SELECT i.invoice_id AS journal_id, CAST(invoice_number AS BIGINT) AS k, n, vat, amount, party,
             CASE WHEN k % 17 = 0 THEN 'WRONG' WHEN k % 3 = 1 THEN 'DRAFT' WHEN k % 3 = 2 THEN 'POST' END
               AS status
      FROM dim_invoices i LEFT JOIN l ON l.invoice_id = i.invoice_id)"""


@register("validate_journals", f"""
WITH {_JOURNALS_SQL}
SELECT journal_id, COALESCE(status, 'DRAFT') AS effective_status,
       (k % 11 = 0)::INT + (k % 13 = 0)::INT + (k % 17 = 0)::INT + (n IS NULL)::INT
       + COALESCE(vat, false)::INT + COALESCE(amount, false)::INT + COALESCE(party, false)::INT AS errors
FROM j""")
def q_validate_journals(spark, d):
    return WB.validate_journal(_journals(spark, d)).select(
        "journal_id", "effective_status", F.size("errors").alias("errors"))


@register("post_journal_lines", f"""
WITH {_JOURNALS_SQL},
posted AS (SELECT journal_id, CASE WHEN k % 2 = 0 AND COALESCE(status, 'DRAFT') = 'DRAFT' THEN 'POST'
                                   ELSE COALESCE(status, 'DRAFT') END AS status FROM j),
x AS (SELECT status, account_code AS ledger_account_id, false AS balancing,
             CASE WHEN line_number <> 6 THEN line_total END AS amount
      FROM posted JOIN dim_invoice_lines l ON l.invoice_id = journal_id
      UNION ALL
      SELECT status, 'b' || right(account_code, 1), true, CASE WHEN line_number <> 6 THEN -line_total END
      FROM posted JOIN dim_invoice_lines l ON l.invoice_id = journal_id
      WHERE status = 'POST' AND line_number % 2 = 1)
SELECT status, ledger_account_id, balancing, COUNT(*) AS lines, {D("SUM(amount)")} AS amount
FROM x GROUP BY status, ledger_account_id, balancing""")
def q_post_journal_lines(spark, d):
    """Even journals are posted; lines and balancing lines by account and status."""
    j = _journals(spark, d)
    posted, _ = WB.post_journal(j, j.where("k % 2 = 0").select("journal_id"))
    return WB.expand_journal_lines(posted).groupBy("status", "ledger_account_id", "balancing").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("amount").alias("amount"))


@register("post_journal_outcomes", f"""
WITH {_JOURNALS_SQL}
SELECT journal_id, CASE WHEN COALESCE(status, 'DRAFT') = 'DRAFT' THEN 'OK' ELSE 'ALREADY_POSTED' END AS outcome
FROM j WHERE k % 2 = 0
UNION ALL SELECT 'unknown-' || journal_id, 'NOT_FOUND' FROM j WHERE k % 5 = 0""")
def q_post_journal_outcomes(spark, d):
    j = _journals(spark, d)
    asked = j.where("k % 2 = 0").select("journal_id").unionByName(
        j.where("k % 5 = 0").select(F.concat(F.lit("unknown-"), "journal_id").alias("journal_id")))
    return WB.post_journal(j, asked)[1]
