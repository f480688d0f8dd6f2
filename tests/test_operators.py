"""Operators: search, paging, guarded SQL, loaders, matching, write-backs, top-k."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerspark.operators import loading as LD
from ledgerspark.operators import matching as M
from ledgerspark.operators import paging, search
from ledgerspark.operators import writeback as WB
from ledgerspark.operators.sql_guard import assert_select_only, guarded_page, guarded_sql
from ledgerspark.operators.topk import top_k_per_group


# ------------------------------------------------------------------ C10 paging (reference cases)

@pytest.mark.parametrize("page,perpage,expected", [
    (None, None, (1, 50)), (-1, None, (1, 50)), (0, None, (1, 50)), (2, 1000, (2, 1000)),
    (1, 0, (1, 1)), (3, 25, (3, 25))])
def test_validate_pagination(page, perpage, expected):
    assert paging.validate_pagination(page, perpage) == expected
    assert paging.validate_pagination(2, 1000, perpage_max=500) == (2, 500)


def test_paginate_pages_and_meta(spark):
    df = spark.range(0, 120).withColumnRenamed("id", "k")
    rows, meta = paging.paginate(df, ["k"], page=3, perpage=50)
    assert [r.k for r in rows.collect()] == list(range(100, 120))
    m = meta.first()
    assert (m.page, m.perpage, m.total, m.has_next) == (3, 50, 120, False)
    _, meta2 = paging.paginate(df, ["k"], page=2, perpage=50)
    assert meta2.first().has_next is True


# ------------------------------------------------------------------ C11 guarded SQL

@pytest.mark.parametrize("sql", [
    "DELETE FROM t", "SELECT 1; SELECT 2", "UPDATE t SET a = 1", "WITH x AS (SELECT 1) INSERT INTO t SELECT * FROM x",
    "PRAGMA x", "select * from t where a = 1; drop table t"])
def test_guard_rejects(spark, sql):
    with pytest.raises(ValueError):
        assert_select_only(sql, spark)


def test_guard_accepts_keywords_inside_literals_and_trailing_semicolon(spark):
    assert guarded_sql(spark, "SELECT 'update me' AS x -- delete\n;").first().x == "update me"
    assert assert_select_only("/* drop */ WITH a AS (SELECT 1 AS v) SELECT v FROM a", spark)


def test_guarded_sql_params_limit_and_cap(spark):
    spark.range(0, 10).createOrReplaceTempView("guard_t")
    df = guarded_sql(spark, "SELECT id FROM guard_t WHERE id >= ? ORDER BY id LIMIT ?;", [3, 4])
    assert [r.id for r in df.collect()] == [3, 4, 5, 6]
    assert guarded_sql(spark, "SELECT id FROM guard_t", max_rows=0).count() == 1
    assert guarded_sql(spark, "SELECT id FROM guard_t").count() == 10
    rows, more = guarded_page(spark, "SELECT id FROM guard_t", max_rows=4)
    assert rows.count() == 4 and more.first().truncated
    assert not guarded_page(spark, "SELECT id FROM guard_t")[1].first().truncated


@pytest.mark.parametrize("sql", [
    "SELECT java_method('java.lang.System', 'getProperty', 'user.home')",
    "SELECT `reflect`('java.lang.System', 'getProperty', 'user.home')",
    "SELECT try_reflect('java.lang.System', 'x')", "SELECT * FROM parquet.`/tmp/x`",
    "SELECT * FROM csv.`file:/etc/passwd`", "SELECT 1; SELECT 2", "DROP TABLE x",
    "WITH a AS (SELECT 1) INSERT INTO t SELECT * FROM a", "SELECT 'it\\'s'; DROP TABLE x",
    "SELECT (", ""])
def test_guard_refuses(spark, sql):
    with pytest.raises(ValueError):
        guarded_sql(spark, sql)


def test_guard_reads_escaped_quotes(spark):
    assert guarded_sql(spark, r"SELECT 'it\'s; drop' AS x").first().x == "it's; drop"


# ------------------------------------------------------------------ C1 bank transactions

def _bank_and_cards(spark):
    bank = spark.createDataFrame(
        [(f"b{i}", "0101", "26", "000001", dt.date(2024, 1, 1 + i), dt.date(2024, 1, 1 + i),
          Decimal(f"{i}.00"), "ISK", Decimal("0"), f"R{i}", "T", None, "1", "01", "d", "h", "2024-01", None)
         for i in range(10)],
        "id string, branch string, ledger string, account_no string, booking_date date, value_date date, "
        "amount decimal(18,2), currency string, balance decimal(18,2), reference string, text_key string, "
        "payer_ssn string, rb_batchno string, type_code string, description string, raw_hash string, "
        "source_period string, ingested_at timestamp")
    cards = spark.createDataFrame(
        [("C1", f"e{i}", "deposit", dt.date(2024, 1, 1 + i), Decimal("-1.00"), "ISK", "M", "d")
         for i in range(10)],
        "card_id string, entry_id string, kind string, date date, amount decimal(18,2), "
        "currency string, merchant_name string, description string")
    return bank, cards


def test_bank_transactions_split_and_order(spark):
    bank, cards = _bank_and_cards(spark)
    rows = search.bank_transactions(bank, cards, limit=5).collect()
    every = search.bank_transactions(bank, cards, limit=None).collect()
    assert len(every) == bank.count() + cards.count() and rows == every[:5]
    dates = [r.date for r in every]
    assert dates == sorted(dates, reverse=True)
    few = search.bank_transactions(bank, cards.limit(1), limit=6).collect()
    assert len(few) == 6                      # few card lines leave their room to the bank
    with pytest.raises(ValueError):
        search.bank_transactions(bank, cards, from_date="2024/01/01")


def test_invoice_lookup_uuid_vs_number(spark):
    inv = spark.createDataFrame([("00000000-0000-0000-0000-00000000000a", "1165"), ("x-2", "1166")],
                                "invoice_id string, invoice_number string")
    assert search.invoice_lookup(inv, "1165").count() == 1
    assert search.invoice_lookup(inv, "00000000-0000-0000-0000-00000000000A").count() == 0
    assert search.invoice_lookup(inv, "00000000-0000-0000-0000-00000000000a").count() == 1
    assert search.invoice_lookup(inv, "").count() == 0


def test_account_statement_requires_dates(spark):
    s = spark.createDataFrame([("1", dt.date(2024, 1, 2), "2024-01-02")],
                              "account_code string, journal_date date, created_at string")
    with pytest.raises(ValueError):
        search.account_statement(s, journal_date_from="2024-01-01")
    assert search.account_statement(s, created_from="2024-01-01", created_to="2024-01-31").count() == 1


# ------------------------------------------------------------------ J loaders

def _stm_rows(spark, rows):
    return spark.createDataFrame(rows, "id string, account_code string, transaction_date date, "
                                       "journal_id string, journal_number string, amount decimal(18,2), "
                                       "description string")


def test_insert_or_ignore_is_idempotent_and_keeps_equal_lines(spark):
    d = dt.date(2024, 1, 5)
    batch = _stm_rows(spark, [("1", "A", d, "J", "1", Decimal("5.00"), "x"),
                              ("2", "A", d, "J", "1", Decimal("5.00"), "x"),   # genuinely equal line
                              ("3", "B", d, "J", "2", Decimal("1.00"), "y")])
    first = LD.load_range(None, batch, "2024-01-01", "2024-01-31")
    assert first.count() == 3
    again = LD.load_range(first, batch, "2024-01-01", "2024-01-31")   # overlap reload
    assert again.count() == 0
    with pytest.raises(ValueError):
        LD.load_range(None, batch, "2024-1-1", "2024-01-31")


def test_insert_or_replace_last_wins(spark):
    target = spark.createDataFrame([("k1", 1, "old"), ("k2", 1, "keep")], "k string, seq int, v string")
    inc = spark.createDataFrame([("k1", 2, "mid"), ("k1", 3, "new"), ("k3", 1, "add")],
                                "k string, seq int, v string")
    out = {r.k: r.v for r in LD.insert_or_replace(target, inc, ["k"], ["seq"]).collect()}
    assert out == {"k1": "new", "k2": "keep", "k3": "add"}


def test_next_load_window_fallbacks(spark):
    empty_log = spark.createDataFrame([], "operation_type string, date_from string, date_to string, "
                                          "records_loaded bigint, load_timestamp timestamp")
    no_tx = spark.createDataFrame([], "transaction_date date")
    w = LD.next_load_window(empty_log, no_tx, "2024-03-31").first()
    assert (w.date_from, w.date_to, w.skip) == ("2024-03-01", "2024-03-31", False)
    tx = spark.createDataFrame([(dt.date(2024, 3, 10),)], "transaction_date date")
    assert LD.next_load_window(empty_log, tx, "2024-03-31").first().date_from == "2024-03-10"
    log = LD.log_load(spark, None, "incremental", "2024-03-10", "2024-03-31", 0, at="2024-03-31 10:00:00")
    w = LD.next_load_window(log, tx, "2024-03-31").first()
    assert (w.date_from, w.skip) == ("2024-03-31", True)
    log2 = LD.log_load(spark, log, "incremental", "2024-03-10", "2024-03-31", 7, at="2024-04-01 10:00:00")
    assert [r.records_loaded for r in log2.collect()] == [7]      # same range replaced


def test_update_account_meta(spark):
    accts = spark.createDataFrame([("0101", "26", "000001", "0101-26-000001", "ISK", "Opinn",
                                    dt.datetime(2024, 1, 1))],
                                  "branch string, ledger string, account_no string, display_number string, "
                                  "currency string, status string, first_seen_at timestamp")
    meta = spark.createDataFrame([("0101", "26", "000001", "0101-26-000001", "2024-02", None, "Lokaður"),
                                  ("0101", "26", "000001", "0101-26-000001", "2024-01", "EUR", None),
                                  ("0101", "26", "000002", "0101-26-000002", "2024-01", "GBP", "Opinn")],
                                 "branch string, ledger string, account_no string, display_number string, "
                                 "source_period string, currency string, status string")
    out = {r.account_no: (r.currency, r.status) for r in LD.update_account_meta(accts, meta).collect()}
    assert out == {"000001": ("EUR", "Lokaður"), "000002": ("GBP", "Opinn")}


# ------------------------------------------------------------------ D matching

def _brute_reconcile(bank, docs, tol):
    """Pass by pass over the days, nearest first, pairing what is left in the order of ids."""
    free_b, free_d, out = sorted(bank), sorted(docs), []
    for off in [0] + [s * k for k in range(1, tol + 1) for s in (1, -1)]:
        for b in list(free_b):
            for d in free_d:
                if d[1] == b[1] and (d[2] - b[2]).days == off:
                    out.append((b[0], d[0], abs(off)))
                    free_b.remove(b)
                    free_d.remove(d)
                    break
    return sorted(out)


def test_reconcile_pairs_equal_fees(spark):
    rows = [(f"x{i}", Decimal("9.90"), dt.date(2024, 3, 1)) for i in range(3)]
    df = spark.createDataFrame(rows, "id string, amount decimal(18,2), date date")
    got = M.reconcile_bank(df, df, 3).collect()
    assert sorted((r.bank_id, r.document_id) for r in got) == [(f"x{i}", f"x{i}") for i in range(3)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_reconcile_matches_brute_force_with_hot_amount(spark, seed):
    rnd = random.Random(seed)
    base = dt.date(2024, 1, 1)
    amounts = [Decimal("100.00")] * 6 + [Decimal(f"{i}.50") for i in range(1, 5)]   # one hot amount
    bank = [(f"b{i:03d}", rnd.choice(amounts), base + dt.timedelta(days=rnd.randint(0, 40)))
            for i in range(120)]
    docs = [(f"d{i:03d}", rnd.choice(amounts), base + dt.timedelta(days=rnd.randint(0, 40)))
            for i in range(120)]
    schema = "id string, amount decimal(18,2), date date"
    got = M.reconcile_bank(spark.createDataFrame(bank, schema), spark.createDataFrame(docs, schema), 3)
    got = sorted((r.bank_id, r.document_id, r.days_apart) for r in got.collect())
    assert got == _brute_reconcile(bank, docs, 3)
    assert len({g[1] for g in got}) == len(got)          # one-to-one


def test_match_accounts_by_rule_priority(spark):
    accts = spark.createDataFrame([("0101-26-000001", "ISK"), ("0101-26-000002", "GBP"),
                                   ("0101-26-000003", "USD")], "account_number string, currency string")
    rules = spark.createDataFrame([(1, "0101-26-000001", None, "p1"), (2, None, "GBP", "p2"),
                                   (3, None, "ISK", "p3")],
                                  "priority int, account_number string, currency string, payment_type_id string")
    pts = spark.createDataFrame([("p1", "Main"), ("p2", "GBP"), ("p3", "ISK")], "id string, title string")
    out = {r.account_number: (r.payment_type_id, r.matched)
           for r in M.match_accounts_by_rule(accts, rules, pts).collect()}
    assert out == {"0101-26-000001": ("p1", True), "0101-26-000002": ("p2", True),
                   "0101-26-000003": (None, False)}


def test_match_by_currency_isk_default(spark):
    accts = spark.createDataFrame([("a", "ISK"), ("b", "EUR")], "account_number string, currency string")
    pts = spark.createDataFrame([("p1", "x", None), ("p2", "y", "ISK"), ("p3", "z", "GBP")],
                                "id string, title string, currency string")
    out = sorted((r.account_number, r.payment_type_id)
                 for r in M.match_accounts_by_currency(accts, pts).collect())
    assert out == [("a", "p1"), ("a", "p2"), ("b", None)]


# ------------------------------------------------------------------ L write-backs

def test_apply_invoice_updates_modes(spark):
    inv = spark.createDataFrame(
        [("u1", "1", "SENT", None, None, "d1"), ("u2", "2", "DRAFT", None, None, "d2"),
         ("u3", "3", "SENT", None, None, "d3")],
        "invoice_id string, invoice_number string, status string, paid_date string, "
        "payment_type string, description string")
    upd = spark.createDataFrame(
        [(1, "1", "mark_as_paid", None, "2024-12-18", "pt"),
         (2, "2", "update_draft", None, None, None),
         (3, "3", "mark_as_paid", None, None, None),
         (4, "9", "cancel_invoice", None, None, None),
         (5, "3", "bogus", None, None, None),
         (6, "2", "cancel_invoice", "SENT", None, None)],
        "seq int, invoice_ref string, mode string, status string, paid_date string, payment_type string"
    ).withColumn("draft_data", F.when(F.col("seq") == 7, F.create_map(F.lit("description"), F.lit("x"))))
    state, res = WB.apply_invoice_updates(inv, upd, "NOW")
    out = {r.invoice_id: (r.status, r.paid_date, r.payment_type) for r in state.collect()}
    assert out == {"u1": ("PAID", "2024-12-18T12:00:00Z", "pt"), "u2": ("SENT", None, None),
                   "u3": ("SENT", None, None)}
    outcomes = {r.seq: r.outcome for r in res.collect()}
    assert outcomes == {1: "OK", 2: "VALIDATION_ERROR", 3: "VALIDATION_ERROR", 4: "NOT_FOUND",
                        5: "VALIDATION_ERROR", 6: "OK"}


def _journals(spark):
    line = "struct<amount:double,vatPercentType:string,ledgerAccountId:string,customerId:string," \
           "creditorId:string,invoiceId:string,expenseId:string,balancingLedgerAccountId:string>"
    return spark.createDataFrame(
        [("j1", "2024-01-01", "ok", None, [(10.0, "NoVAT", "L1", None, None, None, None, "L9")]),
         ("j2", "2024-13-01", "x" * 101, "POST", []),
         ("j3", "2024-01-02", "two parties", None, [(5.0, "Bad", "L1", "C1", None, None, None, None)])],
        f"journal_id string, date string, description string, status string, lines array<{line}>")


def test_validate_expand_post_journal(spark):
    v = {r.journal_id: (len(r.errors), r.effective_status) for r in WB.validate_journal(_journals(spark)).collect()}
    assert v == {"j1": (0, "DRAFT"), "j2": (3, "POST"), "j3": (2, "DRAFT")}
    posted, res = WB.post_journal(_journals(spark), spark.createDataFrame([("j1",), ("j2",), ("zz",)], "journal_id string"))
    assert {r.journal_id: r.outcome for r in res.collect()} == {"j1": "OK", "j2": "ALREADY_POSTED", "zz": "NOT_FOUND"}
    lines = WB.expand_journal_lines(posted.where("journal_id = 'j1'")).collect()
    assert sorted((r.amount, r.ledger_account_id, r.balancing) for r in lines) == [
        (-10.0, "L9", True), (10.0, "L1", False)]
    draft_lines = WB.expand_journal_lines(_journals(spark).where("journal_id = 'j1'")).count()
    assert draft_lines == 1


# ------------------------------------------------------------------ G top-k

def test_top_k_per_group_with_hot_group(spark):
    rows = [("hot", i % 50, i) for i in range(5000)] + [("cold", i, i) for i in range(3)]
    df = spark.createDataFrame(rows, "g string, v int, id int")
    out = top_k_per_group(df, ["g"], [F.col("v").desc(), F.col("id")], 3).collect()
    assert sorted((r.g, r.v, r.id) for r in out) == sorted(
        [("hot", 49, 49), ("hot", 49, 99), ("hot", 49, 149), ("cold", 2, 2), ("cold", 1, 1), ("cold", 0, 0)])


def test_statement_keys_hot_group_of_equal_lines(spark):
    d = dt.date(2024, 1, 5)
    rows = [(f"id{i:05d}", "A", d, "J", "1", Decimal("5.00"), "same") for i in range(3000)]
    batch = _stm_rows(spark, rows)
    keys1 = LD.statement_keys(batch)
    assert keys1.select("line_key").distinct().count() == 3000          # all equal lines survive
    salts = keys1.select(F.split("occurrence_no", "-")[0].alias("s")).distinct().count()
    assert salts > 8                                                     # the hot group is split
    keys2 = LD.statement_keys(_stm_rows(spark, list(reversed(rows))))  # same batch, other order
    assert keys1.select("id", "line_key").subtract(keys2.select("id", "line_key")).count() == 0


def test_walking_by_key_equals_pages(spark):
    df = spark.range(0, 130).selectExpr("id % 37 AS g", "id",
                                        "CASE WHEN id % 5 > 0 THEN concat('x', id % 11) END AS s")
    after = None
    for page in (1, 2, 3):
        rows, meta = paging.paginate(df, ["g", "s"], page=page, perpage=50)
        walked = paging.next_page(df, ["g", "s"], after, 50).collect()
        assert walked == rows.collect() and meta.first().total == 130
        after = walked[-1].asDict()
    assert paging.next_page(df, ["g", "s"], after, 50).count() == 0
    assert paging.paginate(df, ["g"], perpage=1000)[0].count() == 130     # no silent bound


def test_guarded_sql_formats(spark):
    from ledgerspark.sources.sinks import EMPTY_MARKDOWN, render_rows
    spark.range(0, 3).createOrReplaceTempView("fmt_t")
    out = guarded_sql(spark, "SELECT id, 'a' AS s FROM fmt_t ORDER BY id", fmt="csv").collect()
    assert [r.value for r in out] == ['0,"a"', '1,"a"', '2,"a"']
    head, rows = render_rows(spark.sql("SELECT id FROM fmt_t WHERE id < 0"), "markdown")
    assert rows.count() == 0 and head == "| id |\n| - |" and EMPTY_MARKDOWN.startswith("| (no rows)")
    with pytest.raises(ValueError):
        render_rows(spark.sql("SELECT 1"), "xml")


def test_replace_partitions_rewrites_only_touched_months(spark, scratch):
    target_path = scratch + "/inv"
    base = spark.createDataFrame([("i1", "2024-01", 10), ("i2", "2024-01", 20), ("i3", "2024-02", 30)],
                                 "invoice_id string, month string, total int")
    base.write.partitionBy("month").parquet(target_path)
    target = spark.read.parquet(target_path)
    batch = spark.createDataFrame([("i2", "2024-01", 25, 1), ("i4", "2024-01", 40, 2)],
                                  "invoice_id string, month string, total int, seq int")
    state = LD.insert_or_replace(target.select("invoice_id", "total", "month"),
                                 batch.select("invoice_id", "total", "month", "seq"),
                                 ["invoice_id"], ["seq"], partition_cols=["month"])
    LD.replace_partitions(spark, state.select("invoice_id", "total", "month"), target_path, ["month"])
    got = sorted(tuple(r) for r in spark.read.parquet(target_path).select("invoice_id", "total", "month").collect())
    assert got == [("i1", 10, "2024-01"), ("i2", 25, "2024-01"), ("i3", 30, "2024-02"), ("i4", 40, "2024-01")]


def test_several_updates_of_one_invoice_all_count(spark):
    inv = spark.createDataFrame(
        [("u1", "1", "SENT", None, None, "d1", None)],
        "invoice_id string, invoice_number string, status string, paid_date string, "
        "payment_type string, description string, due_date date")
    none = None
    upd = spark.createDataFrame(
        [(1, "1", "mark_as_paid", none, "2024-12-18", "pt", none),
         (2, "1", "cancel_claim", none, none, none, none),
         (3, "1", "update_draft", none, none, none, {"description": "new"}),
         (4, "1", "update_draft", none, none, none, {"due_date": "2025-01-31"}),
         (5, "1", "update_draft", none, none, none, {"due_date": "not a date"}),
         (6, "1", "update_draft", none, none, none, {"colour": "red"})],
        "seq int, invoice_ref string, mode string, status string, paid_date string, "
        "payment_type string, draft_data map<string,string>")
    state, res = WB.apply_invoice_updates(inv, upd, "NOW")
    r = state.first()
    assert (r.status, r.paid_date, r.payment_type, r.description, str(r.due_date)) == (
        "PAID", "2024-12-18T12:00:00Z", "pt", "new", "2025-01-31")
    assert r.claim_cancelled and not r.payment_extended
    assert {x.seq: x.outcome for x in res.collect()} == {
        1: "OK", 2: "OK", 3: "OK", 4: "OK", 5: "VALIDATION_ERROR", 6: "VALIDATION_ERROR"}


def test_payment_types_and_included_details(spark):
    types = spark.createDataFrame([("p2", "Savings", "bank"), ("p1", "Main", "Bank of it")],
                                  "id string, title string, description string")
    assert [r.id for r in search.payment_types(types).collect()] == ["p1", "p2"]
    assert [r.id for r in search.payment_types(types, "BANK OF").collect()] == ["p1"]
    expenses = spark.createDataFrame([("e1", dt.date(2024, 1, 2), "d", "c"),
                                      ("e2", dt.date(2024, 1, 3), "d", "c")],
                                     "expense_id string, date date, description string, "
                                     "creditor_id string")
    lines = spark.createDataFrame([("e1", 1, "x"), ("e1", 2, "y")],
                                  "expense_id string, line int, description string")
    got = search.expense_search(expenses, include={"lines": lines}).orderBy("date", "lines_line")
    assert [(r.expense_id, r.lines_line, r.lines_description) for r in got.collect()] == [
        ("e1", 1, "x"), ("e1", 2, "y"), ("e2", None, None)]
