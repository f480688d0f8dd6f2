"""Sources (A1-A15) on synthetic fixtures (every value invented)."""

import os
from decimal import Decimal

import fixtures
from pyspark.sql import functions as F

from ledgerspark.sources import api_json as J
from ledgerspark.sources import dims, sheets
from ledgerspark.sources import statement_xml as X


def test_bank_xml(spark, scratch):
    fixtures.write_bank_tree(scratch)
    parsed = X.parse_bank_files(X.read_files(spark, scratch + "/accounts"))
    files = {r.source_period: (r.ok, r.reject_reason) for r in parsed.collect()}
    assert files == {"2024-01": (True, None), "2024-02": (True, None), "2024-03": (True, None),
                     "2024-04": (False, "error_body"), "2024-05": (False, "unparsable")}
    tx = X.bank_transactions(parsed).collect()
    assert len(tx) == 6                                   # 5 in January + the repeat in March
    by_ref = {r.reference: r for r in tx}
    assert by_ref["R1"].description == "Greiðsla þæö"    # UTF-8 survives the false prolog
    assert by_ref["R1"].amount == Decimal("-1500.50")
    assert by_ref[None].amount == Decimal("250.25")      # decimal comma, empty reference
    assert by_ref[None].description == "Fallback text"
    assert len({r.id for r in tx}) == 4                  # repeat + id collision share ids
    meta = X.bank_accounts(parsed).select("currency", "status").distinct().collect()
    assert [tuple(r) for r in meta] == [("ISK", "Opinn")]


def test_card_xml_keys_and_signs(spark, scratch):
    fixtures.write_card_tree(scratch)
    rows = X.card_xml_source(spark, scratch + "/cards").collect()
    assert len(rows) == 6
    wd = [r for r in rows if r.kind == "withdrawal"]
    assert all(r.amount < 0 for r in wd)
    assert {r.merchant_id for r in wd} == {"M1", "M2"}    # merchent_id spelling accepted
    dep = [r for r in rows if r.kind == "deposit"]
    jan = {r.entry_id for r in dep if r.source_period == "2024-01"}
    feb = {r.entry_id for r in dep if r.source_period == "2024-02"}
    assert len(jan) == 2                                   # two equal deposits stay distinct
    assert feb <= jan                                      # first occurrence re-reads alike


def test_statement_pages_and_loader(spark, scratch):
    fixtures.write_statement_pages(scratch)
    rows = J.load_statements(J.statement_pages_source(spark, scratch),
                             created_default="2024-06-01").orderBy("id").collect()
    assert [r.id for r in rows] == ["a1", "a2", "a3"]
    assert rows[1].amount == Decimal("-400.50") and rows[1].debit == Decimal("400.50")
    assert rows[2].amount == Decimal("0.00")              # empty string -> 0
    assert rows[1].currency == "ISK"                      # default currency
    assert rows[2].created_at == "2024-06-01"
    untyped = J.load_statements(J.statement_pages_source(spark, scratch), typed=False)
    assert {r.account_type for r in untyped.collect()} == {""}


def test_accounts_both_shapes(spark, scratch):
    fixtures.write_accounts_json(scratch)
    acc = {r.account_number: r for r in J.load_accounts(J.accounts_source(spark, scratch)).collect()}
    assert set(acc) == {"1000", "2000", "3000"}
    assert acc["2000"].is_active == 0 and acc["3000"].is_active == 1
    assert acc["3000"].account_type == "Eignir"           # older field names


def test_invoices_source(spark, scratch):
    fixtures.write_invoices_json(scratch)
    inv, lines = J.load_invoices(J.invoices_source(spark, scratch), "2024-06-01T00:00:00Z")
    assert inv.count() == 3
    assert sorted((r.invoice_id[-1], r.line_number) for r in lines.collect()) == [
        ("1", 1), ("1", 2), ("3", 1)]
    assert inv.where(F.col("final_due_date").isNull()).count() == 3   # blank date -> NULL


def test_statement_sheet(spark, scratch):
    fixtures.write_sheet_csv(scratch)
    rows = sheets.statement_sheet_source(spark, scratch).orderBy("row_no").collect()
    assert [r.row_no for r in rows] == [5, 6, 8]          # dateless row skipped
    assert rows[0].account == "0101-26-000123" and rows[0].account_name == "Veltureikningur"
    assert rows[0].currency == "GBP"
    assert rows[0].amount == Decimal("1234.50") and rows[1].amount == Decimal("-500.00")


def test_dims(spark):
    d = dims.dim_date(spark, "2024-02-28", "2024-03-02").collect()
    assert [r.date for r in d] == ["2024-02-28", "2024-02-29", "2024-03-01", "2024-03-02"]
    assert [r.is_weekend for r in d] == [0, 0, 0, 1]
    assert dims.dim_currency(spark).count() == 4


def test_invoice_upsert_last_document_wins(spark, scratch):
    import json
    fixtures.write_invoices_json(scratch)
    newer = {"invoices": [{"id": "00000000-0000-0000-0000-000000000001", "number": "101",
                           "customerId": "c1", "status": "CANCELLED", "total": 99,
                           "invoiceDate": "2024-01-01", "lines": []}]}
    fixtures.write(os.path.join(scratch, "p3.json"), json.dumps(newer))      # same id, later file
    inv, lines = J.load_invoices(J.invoices_source(spark, scratch), "2024-06-01T00:00:00Z")
    heads = J.upsert_invoices(None, inv)
    got = {r.invoice_number: (r.status, r.total) for r in heads.collect()}
    assert got["101"] == ("CANCELLED", Decimal("99.00")) and len(got) == 3
    stored = J.upsert_invoice_lines(None, lines, inv)
    newest = {r.invoice_id: (r.source_file, r.page_pos) for r in
              inv.orderBy("source_file", "page_pos").collect()}
    want = [r.id for r in lines.collect() if newest[r.invoice_id] == (r.source_file, r.page_pos)]
    assert sorted(r.id for r in stored.collect()) == sorted(want)


def test_newer_invoice_document_replaces_all_lines(spark):
    heads = spark.createDataFrame([("i1", "a", 0), ("i1", "b", 0), ("i2", "b", 1)],
                                  "invoice_id string, source_file string, page_pos int")
    lines = spark.createDataFrame(
        [("i1#1", "i1", "a", 0), ("i1#2", "i1", "a", 0), ("i1#1", "i1", "b", 0)],
        "id string, invoice_id string, source_file string, page_pos int")
    first = J.upsert_invoice_lines(None, lines, heads)
    assert [tuple(r) for r in first.collect()] == [("i1#1", "i1")]       # of document b only
    stored = spark.createDataFrame([("i2#1", "i2"), ("i3#1", "i3"), ("i1#9", "i1")],
                                   "id string, invoice_id string")
    after = J.upsert_invoice_lines(stored, lines, heads)
    # invoice 2's newest document has no lines, so none of its stored lines stays
    assert sorted(r.id for r in after.collect()) == ["i1#1", "i3#1"]


def test_wide_sheet(spark, scratch):
    names = [f"x{i}" for i in range(60)] + ["Dags", "Texti", "Upphæð", "Staða", "Tilvísun"]
    cells = ["" for _ in range(60)] + ["02.01.2024", '"a, ""b"""', '"1.234,50"', "7", "r"]
    text = "\n".join(["h", "acc 0101-26-000001", "", "", ",".join(names), ",".join(cells)])
    with open(f"{scratch}/wide ISK.csv", "w") as f:
        f.write(text)
    row = sheets.statement_sheet_source(spark, scratch, amount_format="is").first()
    assert (row.description, str(row.amount), row.reference) == ('a, "b"', "1234.50", "r")


def test_serial_date_sheet_and_profile(spark, scratch):
    import datetime as dt

    from ledgerspark.operators import reports as R
    fixtures.write_serial_sheet_csv(scratch)
    rows = sheets.statement_sheet_source(spark, scratch, amount_format="is", positional=True) \
        .orderBy("row_no").collect()
    assert [r.date for r in rows] == [dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)]
    assert [r.amount for r in rows] == [Decimal("1000.00"), Decimal("-250.00"), Decimal("0.00")]
    prof = R.account_profile(sheets.statement_sheet_source(spark, scratch, "is", True)).first()
    assert prof.transactions == 2                                  # zero amounts ignored
    assert prof.ending_balance == Decimal("750.00")               # last non-zero balance
    assert prof.largest_inflow == Decimal("1000.00") and prof.largest_outflow == Decimal("250.00")
    assert prof.average_transaction == 375.0
