"""Synthetic input fixtures (every value invented). Cases follow FIXTURES.md."""

from __future__ import annotations

import json
import os

PROLOG = '<?xml version="1.0" encoding="ISO-8859-1"?>\n'


def _bank_row(**kv) -> str:
    inner = "".join(f"<{k}>{v}</{k}>" for k, v in kv.items())
    return f"<faersla>{inner}</faersla>"


def bank_doc(rows: list[str] | None, currency="ISK", status="Opinn") -> str:
    body = f"<faerslur>{''.join(rows)}</faerslur>" if rows is not None else ""
    return (PROLOG + "<LI_Fyrirspurn_reikningsyfirlit_svar>"
            "<timi><dags_mottekid>2024-02-01</dags_mottekid><dags_svarad>2024-02-01</dags_svarad></timi>"
            "<reikningur><utibu>0101</utibu><hb>26</hb><reikningsnr>000123</reikningsnr></reikningur>"
            f"<mynt>{currency}</mynt><yfirdrattarheimild>0</yfirdrattarheimild>"
            f"<stada_reiknings>1000.00</stada_reiknings><astand_reiknings>{status}</astand_reiknings>"
            f"{body}</LI_Fyrirspurn_reikningsyfirlit_svar>")


def write(path: str, text: str) -> None:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)


def write_bank_tree(root: str) -> dict:
    """Bank statement files covering the parser cases. Returns expected facts."""
    acct = os.path.join(root, "accounts", "0101-26-000123")
    r1 = _bank_row(bokunardags="2024-01-03", vaxtadags="2024-01-04", rb_bunkanr="B1",
                   faerslulykill="01", tilvisun="R1", textalykill="T1",
                   skyring_textalykils="Greiðsla þæö", kt_greidanda="0000000000",
                   upphaed="-1500.50", stada_reiknings="8499.50")
    r2 = _bank_row(bokunardags="2024-01-05", vaxtadags="2024-01-05", rb_bunkanr="B2",
                   faerslulykill="02", tilvisun="", textalykill="T2",
                   skyring_textalykils="", skyring_tilvisunar="Fallback text",
                   upphaed="250,25", stada_reiknings="8749,75")
    r3 = _bank_row(bokunardags="2024-01-06", vaxtadags="2024-01-06", rb_bunkanr="B3",
                   faerslulykill="03", tilvisun="R3", textalykill="T3",
                   skyring_textalykils="Zero", upphaed="0", stada_reiknings="8749.75")
    # two rows equal under the id recipe (same key fields, different description)
    r4 = _bank_row(bokunardags="2024-01-07", vaxtadags="2024-01-07", rb_bunkanr="B4",
                   tilvisun="R4", textalykill="T4", skyring_textalykils="First",
                   upphaed="10.00", stada_reiknings="8759.75")
    r5 = _bank_row(bokunardags="2024-01-07", vaxtadags="2024-01-07", rb_bunkanr="B4",
                   tilvisun="R4", textalykill="T4", skyring_textalykils="Second",
                   upphaed="10.00", stada_reiknings="8769.75")
    write(os.path.join(acct, "2024-01.xml"), bank_doc([r1, r2, r3, r4, r5]))
    write(os.path.join(acct, "2024-02.xml"), bank_doc(None))                 # no faerslur
    write(os.path.join(acct, "2024-03.xml"), bank_doc([r1]))                 # same row again
    write(os.path.join(acct, "2024-04.xml"),
          PROLOG + "<LI_Villa><villa>Aðgangi hafnað</villa></LI_Villa>")     # error body
    write(os.path.join(acct, "2024-05.xml"), bank_doc([r1])[:120])           # truncated
    write(os.path.join(root, "accounts", "not-an-account", "2024-01.xml"), bank_doc([r1]))
    return {"rows": 6, "distinct_ids": 4, "rejected": 2}


def card_doc(withdrawals: list[dict], deposits: list[dict]) -> str:
    def el(tag, d):
        return f"<{tag}>" + "".join(f"<{k}>{v}</{k}>" for k, v in d.items()) + f"</{tag}>"
    w = ("<withdrawals>" + "".join(el("withdrawal", x) for x in withdrawals) + "</withdrawals>"
         if withdrawals else "<withdrawals />")
    dep = "<deposits>" + "".join(el("deposit", x) for x in deposits) + "</deposits>"
    return (PROLOG + "<LI_Get_Creditcard_Transactions_response>"
            "<time><date_arrived>2024-02-01</date_arrived><date_response>2024-02-01</date_response></time>"
            "<balance>-5000.00</balance><award_point_state>10</award_point_state>"
            f"<total_withdrawal>0</total_withdrawal>{w}{dep}</LI_Get_Creditcard_Transactions_response>")


def write_card_tree(root: str) -> None:
    card = os.path.join(root, "cards", "card-001")
    w1 = {"entry_id": "E1", "clearance_id": "C1", "foreign": "false", "date": "2024-01-10",
          "amount": "1200.00", "currency": "ISK", "trans_key": "K", "merchant_name": "Shop A",
          "merchent_id": "M1", "mcc": "5411"}
    w2 = {"entry_id": "E2", "foreign": "true", "date": "2024-01-11", "amount": "30.00",
          "foreign_amount": "30.00", "currency": "EUR", "merchant_name": "Shop B",
          "merchant_id": "M2"}
    dep = {"foreign": "false", "date": "2024-01-15", "description": "Refund", "amount": "500.00",
           "currency": "ISK"}
    write(os.path.join(card, "2024-01.xml"), card_doc([w1, w2], [dep, dep]))
    write(os.path.join(card, "2024-02.xml"), card_doc([], [dep]))
    write(os.path.join(card, "2024-03.xml"), card_doc([w1], []))  # repeated (card, entry_id)


def write_statement_pages(root: str) -> None:
    p1 = {"page": 1, "pages": 2, "total": 3, "lines": [
        {"id": "a1", "accountCode": "1000", "accountName": "Sala", "accountType": "Tekjur",
         "accountSubType": "Rekstrartekjur", "date": "2024-01-02", "description": "Invoice 1",
         "reference": "R1", "amount": 1000, "balance": 1000, "currency": "ISK",
         "entryId": "J1", "voucher": "V1", "created": "2024-01-02T10:00:00Z"},
        {"id": "a2", "accountCode": "2000", "accountName": "Kostnaður", "accountType": "Gjöld",
         "date": "2024-01-02", "description": "Rent", "amount": "-400.50", "balance": "",
         "entryId": "J2", "created": "2024-01-02T11:00:00Z"}]}
    p2 = {"page": 2, "pages": 2, "total": 3, "lines": [
        {"id": "a3", "accountCode": "2000", "accountName": "Kostnaður", "accountType": "Gjöld",
         "date": "2024-01-03", "description": "Rent", "amount": "", "entryId": "J3"}]}
    p3 = {"page": 1, "pages": 1, "total": 0}
    for i, p in enumerate((p1, p2, p3)):
        write(os.path.join(root, f"page-{i}.json"), json.dumps(p))


def write_accounts_json(root: str) -> None:
    arr = [{"id": "u1", "code": "1000", "name": "Sala", "type": "Tekjur", "subType": "Rekstur",
            "isActive": True, "created": "2020-01-01", "modified": "2024-01-01"},
           {"id": "u2", "code": "2000", "name": "Kostnaður", "type": "Gjöld", "isActive": False}]
    wrapped = {"data": [{"id": "u3", "accountNumber": "3000", "accountName": "Banki",
                         "accountType": "Eignir"}]}
    write(os.path.join(root, "a.json"), json.dumps(arr))
    write(os.path.join(root, "b.json"), json.dumps(wrapped))


def write_invoices_json(root: str) -> None:
    inv = lambda i, status, lines: {
        "id": f"00000000-0000-0000-0000-00000000000{i}", "number": str(100 + i),
        "customerId": "c1", "status": status, "currency": "ISK", "subtotal": 100, "vatAmount": 24,
        "total": 124, "invoiceDate": "2024-01-0%d" % i, "dueDate": "2024-02-0%d" % i,
        "finalDueDate": "", "paidDate": "", "description": f"Inv {i}", "isActive": True,
        "created": f"2024-01-0{i}T09:00:00Z", "lines": lines}
    line = {"description": "Work", "quantity": 2, "unitPrice": 50, "discountPercent": 0,
            "vatPercent": 24, "vatAmount": 24, "total": 124, "accountId": "a", "accountCode": "1000"}
    write(os.path.join(root, "p1.json"), json.dumps(
        {"data": [inv(1, "PAID", [line, line]), inv(2, "SENT", [])],
         "meta": {"pagination": {"total": 3, "total_pages": 2}}}))
    write(os.path.join(root, "p2.json"), json.dumps({"invoices": [inv(3, "DRAFT", [line])]}))


def write_sheet_csv(root: str) -> None:
    """Statement sheets exported as CSV: account line at line 1, header at line 4, data from 5."""
    rows = [
        "Yfirlit,,,,",
        "0101-26-000123 Veltureikningur,,,,",
        ",,,,",
        ",,,,",
        "Dags,Texti,Upphæð,Staða,Tilvísun",
        "02.01.2024,Greiðsla frá viðskiptavini með langri lýsingu yfir fjörutíu stafi,\"1.234,50\",\"10.000,00\",R1",
        "2024-01-03,Leiga,-500,\"9.500,00\",R2",
        ",Engin dagsetning,100,0,R3",
        "04.01.2024,Núll,0,0,R4",
    ]
    write(os.path.join(root, "Reikningur GBP.csv"), "\n".join(rows) + "\n")


def write_profile_csv(root: str) -> None:
    """Header-keyed sheets for A10/E60 (candidate account columns, debit/credit columns)."""
    a = ["Reikningur,Debet,Kredit,Texti",
         "0101-26-000123,100.50,,Greiðsla GBP",
         "0101-26-000123,,20,Innlegg",
         ",5,,kr. 5"]
    b = ["Account,Debet,Kredit,Texti",
         "0101 26 000124,1,2,EUR færsla",
         "123,3,4,stutt"]
    write(os.path.join(root, "a.csv"), "\n".join(a) + "\n")
    write(os.path.join(root, "b.csv"), "\n".join(b) + "\n")


def write_registry_json(root: str) -> None:
    write(os.path.join(root, "accounts.json"), json.dumps([
        {"name": "Checking", "number": "0101-26-000123", "category": "Debet"},
        {"name": "Broken", "number": "12-34", "category": "Debet"}]))


def write_serial_sheet_csv(root: str) -> None:
    """Serial-date export read by position: date col 0, text 10, amount 11, balance 12."""
    def row(date, text, amount, balance):
        cells = [date] + [""] * 9 + [text, amount, balance]
        return ",".join(cells)
    rows = ["Yfirlit", "0101-26-000777 Sparireikningur", "", "", "Header",
            row("45292", "Innlegg", "\"1.000,00\"", "\"1.000,00\""),
            row("45293", "Úttekt", "-250", "750"),
            row("Samtals", "", "750", "0"),
            row("45294", "Vextir", "0", "0")]
    write(os.path.join(root, "serial.csv"), "\n".join(rows) + "\n")
