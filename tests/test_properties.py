"""Property tests: Spark parsers vs a plain-Python model of the same JavaScript semantics,
and loader idempotency on random batches."""

import datetime as dt
import re
from decimal import ROUND_HALF_UP, Decimal, InvalidOperation

from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerspark import functions as L
from ledgerspark.operators import loading as LD

PREFIX = re.compile(r"^\s*([+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?)")
CENT = Decimal("0.01")


def js_float_money(s):
    """Model of parseFloat(s) as DECIMAL(18,2); None when NaN or out of range."""
    m = PREFIX.match(s or "")
    if not m:
        return None
    try:
        v = Decimal(m.group(1)).quantize(CENT, rounding=ROUND_HALF_UP)
    except InvalidOperation:
        return None
    return v if abs(v) < Decimal(10) ** 16 else None


def model_or_zero(s):
    v = js_float_money(s)
    return Decimal("0.00") if v is None else v


def model_keep(s):
    kept = re.sub(r"[^0-9,\-]", "", s or "")
    return model_or_zero(kept.replace(",", ".", 1))


def model_is(s):
    t = (s or "").replace(".", "").replace(",", ".", 1)
    return model_or_zero(t)


amount_text = st.text(alphabet="0123456789.,- abE", max_size=12)


def run(spark, fn, values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    return [r[0] for r in df.select(fn("x")).collect()]


@settings(max_examples=15, deadline=None)
@given(st.lists(amount_text, min_size=1, max_size=80))
def test_parsers_match_js_model(spark, values):
    assert run(spark, L.parse_amount_or_zero, values) == [model_or_zero(v) for v in values]
    assert run(spark, L.parse_amount_keep, values) == [model_keep(v) for v in values]
    assert run(spark, L.parse_amount_is, values) == [model_is(v) for v in values]


line = st.tuples(st.sampled_from(["A", "B"]), st.integers(0, 3), st.sampled_from(["J1", "J2"]),
                 st.integers(-3, 3), st.sampled_from(["x", "y"]))


@settings(max_examples=10, deadline=None)
@given(st.lists(line, min_size=1, max_size=60), st.integers(0, 3))
def test_load_range_idempotent_and_keeps_equal_lines(spark, lines, split):
    base = dt.date(2024, 1, 1)
    rows = [(f"id{i:03d}", a, base + dt.timedelta(days=d), j, j, Decimal(amt), desc)
            for i, (a, d, j, amt, desc) in enumerate(lines)]
    df = spark.createDataFrame(rows, "id string, account_code string, transaction_date date, "
                                     "journal_id string, journal_number string, amount decimal(18,2), "
                                     "description string")
    everything = LD.load_range(None, df, "2024-01-01", "2024-12-31")
    assert everything.count() == len(rows)                      # equal lines all survive
    cut = (base + dt.timedelta(days=split)).isoformat()
    first = LD.load_range(None, df, "2024-01-01", cut)
    second = LD.load_range(first, df, "2024-01-01", "2024-12-31")   # overlapping reload
    assert first.count() + second.count() == len(rows)
    assert LD.load_range(everything, df, "2024-01-01", "2024-12-31").count() == 0


side = st.lists(st.tuples(st.sampled_from(["1.00", "2.00", "3.50"]), st.integers(0, 20)),
                min_size=0, max_size=40)


@settings(max_examples=10, deadline=None)
@given(side, side, st.integers(0, 5))
def test_reconcile_equals_brute_force(spark, bank_rows, doc_rows, tol):
    from test_operators import _brute_reconcile

    from ledgerspark.operators import matching as M
    base = dt.date(2024, 1, 1)
    bank = [(f"b{i:03d}", Decimal(a), base + dt.timedelta(days=d)) for i, (a, d) in enumerate(bank_rows)]
    docs = [(f"d{i:03d}", Decimal(a), base + dt.timedelta(days=d)) for i, (a, d) in enumerate(doc_rows)]
    schema = "id string, amount decimal(18,2), date date"
    got = M.reconcile_bank(spark.createDataFrame(bank, schema), spark.createDataFrame(docs, schema), tol)
    assert sorted((r.bank_id, r.document_id, r.days_apart) for r in got.collect()) == \
        _brute_reconcile(bank, docs, tol)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["hot", "hot", "hot", "a", "b"]), st.integers(0, 9)),
                min_size=1, max_size=120), st.integers(1, 4))
def test_top_k_per_group_equals_model(spark, rows, k):
    from pyspark.sql import functions as F

    from ledgerspark.operators.topk import top_k_per_group
    data = [(g, v, i) for i, (g, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "g string, v int, id int")
    got = sorted(tuple(r) for r in top_k_per_group(df, ["g"], [F.col("v").desc(), F.col("id")], k)
                 .select("g", "v", "id").collect())
    model = []
    for g in {r[0] for r in data}:
        model += sorted([r for r in data if r[0] == g], key=lambda r: (-r[1], r[2]))[:k]
    assert got == sorted(model)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["1", "2", "3", "9"]), st.integers(0, 800),
                          st.integers(-500, 500)), min_size=1, max_size=60),
       st.lists(st.sampled_from([("1", "Tekjur"), ("2", "Gjöld"), ("3", "Eignir"), ("1", "Tekjur"),
                                 ("2", "Skuldir")]), min_size=1, max_size=6))
def test_eager_aggregation_equals_naive(spark, lines, chart):
    from pyspark.sql import functions as F

    from ledgerspark.plans import ledger
    base = dt.date(2023, 1, 1)
    rows = [(f"s{i}", c, f"n{c}", "", "", base + dt.timedelta(days=d), Decimal(max(-a, 0)),
             Decimal(max(a, 0))) for i, (c, d, a) in enumerate(lines)]
    stm = spark.createDataFrame(rows, "id string, account_code string, account_name string, "
                                      "account_type string, account_subtype string, transaction_date date, "
                                      "debit decimal(18,2), credit decimal(18,2)")
    acc = spark.createDataFrame([(c, t, "s") for c, t in chart],
                                "account_number string, account_type string, account_subtype string")
    eager = ledger.gold_account_summary_by_year(stm, acc, "2023-01-01").select(
        "year", "account_code", "account_type", "transaction_count", "total_debit", "total_credit")
    j = ledger.facts_with_account(stm, acc)
    naive = j.groupBy(F.date_format("transaction_date", "yyyy").alias("year"), "account_code",
                      F.col("dim_account_type").alias("account_type")).agg(
        F.count(F.lit(1)).alias("transaction_count"), F.sum("debit").alias("total_debit"),
        F.sum("credit").alias("total_credit"))
    assert sorted(map(tuple, eager.collect())) == sorted(map(tuple, naive.collect()))
