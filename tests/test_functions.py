"""Scalar helpers (B1-B26) against hand-computed values."""

from decimal import Decimal

from pyspark.sql import functions as F

from ledgerspark import functions as L


def one(spark, expr, value, dtype="string"):
    df = spark.createDataFrame([(value,)], f"x {dtype}")
    return df.select(expr(F.col("x")).alias("y")).first()["y"]


def test_parse_amount_xml(spark):
    assert one(spark, L.parse_amount_xml, "-1500.50") == Decimal("-1500.50")
    assert one(spark, L.parse_amount_xml, "250,25") == Decimal("250.25")
    assert one(spark, L.parse_amount_xml, "") is None
    assert one(spark, L.parse_amount_xml, None) is None
    assert one(spark, L.parse_amount_xml, "abc") is None


def test_parse_amount_or_zero(spark):
    assert one(spark, L.parse_amount_or_zero, "12.5") == Decimal("12.50")
    assert one(spark, L.parse_amount_or_zero, "") == Decimal("0.00")
    assert one(spark, L.parse_amount_or_zero, None) == Decimal("0.00")
    assert one(spark, L.parse_amount_or_zero, "7abc") == Decimal("7.00")   # parseFloat prefix


def test_parse_amount_keep_drops_dot(spark):
    assert one(spark, L.parse_amount_keep, "1234.5") == Decimal("12345.00")
    assert one(spark, L.parse_amount_keep, "1.234,50 kr") == Decimal("1234.50")
    assert one(spark, L.parse_amount_keep, "x") == Decimal("0.00")


def test_parse_amount_is_and_en(spark):
    assert one(spark, L.parse_amount_is, "1.234.567,89") == Decimal("1234567.89")
    assert one(spark, L.parse_amount_is, "-500") == Decimal("-500.00")
    assert one(spark, L.parse_amount_en, "$1,234.50") == Decimal("1234.50")
    assert one(spark, L.parse_amount_en, "n/a") is None


def test_sign_rule(spark):
    df = spark.createDataFrame([(Decimal("-5.00"),), (Decimal("7.25"),), (Decimal("0.00"),)],
                               "amount decimal(18,2)")
    rows = df.select(L.debit_of("amount").alias("d"), L.credit_of("amount").alias("c")).collect()
    assert [(r.d, r.c) for r in rows] == [(Decimal("5.00"), Decimal("0.00")),
                                         (Decimal("0.00"), Decimal("7.25")),
                                         (Decimal("0.00"), Decimal("0.00"))]


def test_bank_tx_id_nulls_are_empty_and_amount_js_text(spark):
    import hashlib
    df = spark.createDataFrame([("0101", "26", "000123", "2024-01-03", Decimal("-1500.50"), None,
                                 "R1", None)],
                               "b string, l string, a string, d string, amt decimal(18,2), "
                               "batch string, ref string, tk string")
    got = df.select(L.bank_tx_id("b", "l", "a", "d", "amt", "batch", "ref", "tk")).first()[0]
    assert got == hashlib.sha1(b"0101|26|000123|2024-01-03|-1500.5||R1|").hexdigest()


def test_first_nonempty_and_active_flag(spark):
    df = spark.createDataFrame([("", None, "c"), (None, "b", "c")], "a string, b string, c string")
    assert [r[0] for r in df.select(L.first_nonempty("a", "b", "c")).collect()] == ["c", "b"]
    flags = spark.createDataFrame([(True,), (False,), (None,)], "x boolean")
    assert [r[0] for r in flags.select(L.active_flag("x")).collect()] == [1, 0, 1]


def test_dates(spark):
    import datetime as dt
    assert one(spark, L.parse_sheet_date, "02.01.2024") == dt.date(2024, 1, 2)
    assert one(spark, L.parse_sheet_date, "2024-01-03") == dt.date(2024, 1, 3)
    assert one(spark, L.parse_sheet_date, "32.13.2024") is None
    assert one(spark, L.excel_serial_date, "45292") == dt.date(2024, 1, 1)
    assert one(spark, L.excel_serial_date, "Dags") is None
    df = spark.createDataFrame([("2024-12-18",), ("2024-12-18T08:00:00Z",), (None,)], "x string")
    got = [r[0] for r in df.select(L.paid_date_norm("x", "NOW")).collect()]
    assert got == ["2024-12-18T12:00:00Z", "2024-12-18T08:00:00Z", "NOW"]


def test_calendar_keys(spark):
    import datetime as dt
    df = spark.createDataFrame([(dt.date(2024, 5, 17),)], "d date")
    r = df.select(L.month_key("d"), L.year_key("d"), L.quarter_key("d")).first()
    assert tuple(r) == ("2024-05", "2024", "2024-Q2")


def test_status_and_payment_status(spark):
    import datetime as dt
    df = spark.createDataFrame(
        [("PAID", dt.date(2024, 1, 1)), ("SENT", dt.date(2024, 1, 1)), ("SENT", dt.date(2024, 3, 1)),
         ("SENT", None), ("WEIRD", None), ("CREDIT", None), ("SENT", dt.date(2024, 2, 1))],
        "s string, due date")
    rows = df.select(L.status_display("s"), L.payment_status("s", "due", "2024-02-01")).collect()
    assert [tuple(r) for r in rows] == [("Paid", None), ("Unpaid", "Overdue"), ("Unpaid", "Due"),
                                       ("Unpaid", None), ("WEIRD", None), ("Credit Note", None),
                                       ("Unpaid", "Due")]               # due on as_of -> Due


def test_currency_rules(spark):
    df = spark.createDataFrame([("Erlendur reikningur", "stmt (2).xlsx"), ("Foreign", "x (3).csv"),
                                ("Debet", "x (2).csv")], "t string, f string")
    assert [r[0] for r in df.select(L.currency_from_type("t", "f")).collect()] == ["GBP", "EUR", "ISK"]
    names = spark.createDataFrame([("Reikningur GBP.csv",), ("EUR x",), ("plain",)], "n string")
    assert [r[0] for r in names.select(L.currency_from_name("n")).collect()] == ["GBP", "EUR", "ISK"]


def test_js_round_and_percent_change(spark):
    df = spark.createDataFrame([(-2.5, 0.0, 5.0), (2.5, 10.0, 15.0)], "x double, a double, b double")
    rows = df.select(L.js_round("x"), L.percent_change("a", "b")).collect()
    assert [tuple(r) for r in rows] == [(-2.0, 0.0), (3.0, 50.0)]


def test_money_avg_is_exact_half_up(spark):
    df = spark.createDataFrame([(Decimal("0.01"),), (Decimal("0.02"),)], "x decimal(18,2)")
    assert df.agg(L.money_avg("x")).first()[0] == 0.02          # 0.015 -> 0.02
    neg = spark.createDataFrame([(Decimal("-0.01"),), (Decimal("-0.02"),)], "x decimal(18,2)")
    assert neg.agg(L.money_avg("x")).first()[0] == -0.02


def test_account_class_both_languages(spark):
    df = spark.createDataFrame([(t,) for t in ["Tekjur", "Income", "Revenue", "Gjöld", "Cost",
                                               "Eignir", "Asset", "Skuldir", "Eigið fé", "Equity",
                                               "Annað", ""]], "t string")
    got = [r[0] for r in df.select(L.account_class("t")).collect()]
    assert got == ["revenue"] * 3 + ["expense"] * 2 + ["asset"] * 2 + ["liability", "equity",
                                                                        "equity", "other", "other"]


def test_clean_title_and_prefix(spark):
    assert one(spark, L.clean_title, "Main account (ISK)!") == "Main_account_ISK"
    assert one(spark, lambda c: L.text_prefix_key(c, 5), "  ab  cdef") == "ab"
    assert one(spark, lambda c: L.text_prefix_key(c, 5), "   ") is None


def test_to_millions_and_raw_hash(spark):
    df = spark.createDataFrame([(Decimal("2500000.00"), "a")], "x decimal(18,2), s string")
    r = df.select(L.to_millions("x").alias("m"), L.raw_hash("x", "s").alias("h")).first()
    assert r.m == 2.5 and len(r.h) == 40
