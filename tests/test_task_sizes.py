"""Steps whose tasks or shuffles have to stay small however large the tables are."""

import datetime as dt
import os
import uuid
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerspark.operators import key_index as K, loading as LD
from ledgerspark.plans import gold_store as G, ledger as L, marts as M

LINE = ("id string, account_code string, account_name string, transaction_date date, "
        "journal_id string, journal_number string, amount decimal(18,2), description string, "
        "debit decimal(18,2), credit decimal(18,2), balance decimal(18,2)")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def line(i, account="1", journal="J", number="1", day=1, month=1, id="", amount=5):
    return (id, account, f"Account {account}", dt.date(2024, month, day), journal, number,
            Decimal(amount), "d", Decimal(i), Decimal(1), Decimal(2))


def stored_lines(spark, scratch):
    """Many lines of one account, some of others, and lines without account or date."""
    lines = [line(i, "hot", month=i % 3 + 1, day=i % 28 + 1) for i in range(300)]
    lines += [line(i, str(i % 7), month=i % 5 + 1) for i in range(60)]
    lines += [(None, None, None, dt.date(2024, 1, 1), *x[4:]) for x in lines[:3]]
    lines += [(*x[:3], None, *x[4:]) for x in lines[:3]]
    spark.createDataFrame(lines, LINE).write.parquet(f"{scratch}/lines")
    return spark.read.parquet(f"{scratch}/lines")


def dimensions(spark):
    accounts = spark.createDataFrame(
        [("hot", "Tekjur", "a", 1), ("1", "Eignir", "b", 1), ("1", "Eignir", "c", 0),
         ("2", None, None, 1), (None, "Tekjur", "a", 1)],
        "account_number string, account_type string, account_subtype string, is_active int")
    groups = spark.createDataFrame(
        [("Tekjur", None, "Revenue", None, "PL", -1)],
        "acct_type string, acct_subtype string, report_group string, report_subgroup string, "
        "statement string, sign int")
    return accounts, groups


def small_tasks(monkeypatch):
    monkeypatch.setattr(L, "TASK_BYTES", 100)
    monkeypatch.setattr(L, "LEAST_TASKS", 2)
    monkeypatch.setattr(L, "MOST_TASKS", 5)


def spread_alike(spark, scratch, monkeypatch, mart, names):
    statements, (accounts, groups) = stored_lines(spark, scratch), dimensions(spark)
    before = mart(M.fact_month(statements, accounts, groups, names))
    assert "REPARTITION_BY_NUM" not in plan(before)                    # small tables stay together
    want = rows(before)
    small_tasks(monkeypatch)
    after = mart(M.fact_month(statements, accounts, groups, names))
    assert plan(after).count("REPARTITION_BY_NUM") == 2                # lines, and sums
    assert rows(after) == want and len(want) > 4


def test_monthly_summary_deals_lines_by_size(spark, scratch, monkeypatch):
    spread_alike(spark, scratch, monkeypatch, M.v_monthly_summary, False)


def test_trial_balance_deals_lines_by_size(spark, scratch, monkeypatch):
    spread_alike(spark, scratch, monkeypatch, M.v_trial_balance_month, True)


def test_tables_of_unknown_size_are_not_dealt(spark):
    small = spark.sparkContext.parallelize([("a", 1)]).toDF("a string, b int")
    assert L.spread(small, "a") is small


def test_buckets_follow_the_rows():
    assert [K.buckets_for(n) for n in (0, 3_600_000, 36_000_000, 216_000_000)] == [4, 4, 18, 108]


def test_months_new_to_the_index_are_not_looked_up(spark, scratch):
    table = f"keys_{uuid.uuid4().hex[:8]}"
    K.create(spark, table, "line_key", f"{scratch}/index", buckets=4)
    batch = spark.range(20).select(F.col("id").cast("string").alias("line_key"),
                                   F.lit("2024-01").alias("month"))
    try:
        assert "Join" not in plan(K.unseen(batch, table, "l1"))
        assert K.load_new_rows(batch, f"{scratch}/lines", table, "l1").count() == 20
        assert "Join" not in plan(K.unseen(batch, table, "l1"))        # its own entries don't count
        assert K.unseen(batch, table, "l2").count() == 0
        assert K.unseen(batch.withColumn("month", F.lit("2024-02")), table, "l2").count() == 20
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def load(target, batch):
    return LD.load_range(target, batch, "2024-01-01", "2024-12-31")


def test_range_load_shuffles_batch_and_target_once(spark):
    """Equal lines, lines without id, account or journal, and texts that run into each other."""
    one = [line(0)] * 3 + [line(1, id="a")] * 2 + [line(2, journal="1|2", number="3"),
                                                   line(3, account=None), line(4, id=None)]
    two = [line(0)] * 5 + [line(1, id="a"), line(2, journal="1", number="2|3"), line(5, id="b"),
                           line(3, account=""), line(6, id="c"), line(6, id="c"), line(4),
                           line(7, journal="x|y", number="z"), line(7, journal="x", number="y|z")]
    target, batch = (spark.createDataFrame(x, LINE) for x in (one, two))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        new = load(target, batch)
        assert plan(new).count("Exchange hashpartitioning") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    keyed = load(LD.statement_keys(target), batch)                    # by stored keys: an anti-join
    assert new.columns == keyed.columns == ["line_key", *batch.columns, "occurrence_no"]
    keys = lambda df: rows(df.select("account_code", "journal_id", "id", "line_key"))
    assert {r[-1] for r in keys(new)} == {r[-1] for r in keys(keyed)}
    # three more equal lines of five are new (one came without an id), and b, the two of c, and
    # one of the last two, whose texts are alike
    assert len(keys(new)) == len(keys(keyed)) == 6


def test_targets_of_other_types_are_compared_by_key(spark):
    batch = spark.createDataFrame([line(0), line(1, id="a")], LINE)
    other = batch.withColumn("amount", F.col("amount").cast("decimal(20,2)"))
    assert load(other, batch).count() == 0
    assert load(other.limit(0), batch).count() == 2


def paged(spark):
    lines = [(*line(0), "w", p, k, f"w/{p}") for p in (1, 2, 3) for k in range(2)]
    lines += [(*line(9, id=f"x{p}"), "w", p, 5, f"w/{p}") for p in (1, 2, 3)]
    return spark.createDataFrame(
        lines, f"{LINE}, load_window string, page long, page_pos long, source_file string")


def test_only_lines_of_several_pages_are_joined_with_their_counts(spark):
    keyed = LD.statement_keys(paged(spark))
    p = plan(keyed)
    assert "__before" in p and "> 0)" in p.split("__before", 1)[1]
    n = F.split("occurrence_no", "-")[1].cast("int")
    assert rows(keyed.where("id = ''").select(n)) == [(i,) for i in range(1, 7)]
    assert rows(keyed.where("id <> ''").select("id", n)) == [(f"x{p}", 1) for p in (1, 2, 3)]


def test_stored_page_counts_are_text(spark):
    counts = LD.page_counts(paged(spark))
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in [*LD.STATEMENT_KEY, "id"]]
    want = paged(spark).select(F.sha2(F.to_json(F.array(*parts)), 256)).distinct()
    assert rows(counts.select("line_group").distinct()) == rows(want)
    earlier = counts.where("page = 1").groupBy("load_window", "line_group").agg(F.sum("n").alias("n"))
    keyed = LD.statement_keys(paged(spark).where("page > 1"), earlier=earlier)
    n = F.split("occurrence_no", "-")[1].cast("int")
    assert rows(keyed.where("id = ''").select(n)) == [(i,) for i in range(3, 7)]


def test_gold_sums_deal_lines_by_size(spark, scratch, monkeypatch):
    statements = stored_lines(spark, scratch)
    want = rows(G.monthly_sums(statements))
    small_tasks(monkeypatch)
    assert "REPARTITION_BY_NUM" in plan(G.monthly_sums(statements))
    assert rows(G.monthly_sums(statements)) == want


def test_large_month_of_gold_is_written_by_many_tasks(spark, scratch):
    lines = spark.range(100_000).select(
        F.col("id").cast("string").alias("account_code"), F.sha2(F.col("id").cast("string"), 256)
        .alias("account_name"), F.date_add(F.lit("2024-01-01").cast("date"),
                                     (F.col("id") % 28).cast("int")).alias("transaction_date"),
        *[F.col("id").cast("decimal(18,2)").alias(c) for c in ("debit", "credit", "balance")])
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    try:
        G.write_gold(lines, f"{scratch}/gold")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    files = [f for f in os.listdir(f"{scratch}/gold/month=2024-01") if f.endswith(".parquet")]
    assert len(files) > 1 and G.read_gold(spark, f"{scratch}/gold").count() == 100_000
