"""The key index: the same rows as the anti-join, without reading or shuffling the target."""

import os
import time
import uuid

import pytest
from pyspark.sql import functions as F

from ledgerspark.operators import key_index as K, loading as LD
from ledgerspark.session import checkpoint_dir


@pytest.fixture()
def table(spark, scratch):
    name = f"keys_{uuid.uuid4().hex[:8]}"
    K.create(spark, name, "line_key", f"{scratch}/index", buckets=8)
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def batch(spark, start, stop, month="2024-01"):
    return spark.range(start, stop).select(
        F.sha1(F.concat(F.lit(month), F.col("id").cast("string"))).alias("line_key"),
        F.col("id").alias("amount"), F.lit(month).alias("month"))


def target(spark, scratch):
    return sorted((r.month, r.amount) for r in spark.read.parquet(f"{scratch}/target").collect())


def test_loads_only_new_keys(spark, scratch, table):
    first = K.load_new_rows(batch(spark, 0, 50), f"{scratch}/target", table, "l1")
    assert first.count() == 50
    both = batch(spark, 40, 70).unionByName(batch(spark, 0, 5, "2024-02"))
    assert K.load_new_rows(both, f"{scratch}/target", table, "l2").count() == 25
    assert K.unseen(both, table).count() == 0
    assert target(spark, scratch) == [("2024-01", i) for i in range(70)] + \
        [("2024-02", i) for i in range(5)]


def test_other_loads_stay_whatever_the_session_says(spark, scratch, table):
    old = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    try:
        K.load_new_rows(batch(spark, 0, 10), f"{scratch}/target", table, "l1")
        K.load_new_rows(batch(spark, 0, 20), f"{scratch}/target", table, "l2")
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", old)
    assert spark.table(table).count() == 20
    assert target(spark, scratch) == [("2024-01", i) for i in range(20)]


def test_repeated_load_writes_the_same(spark, scratch, table, monkeypatch):
    K.load_new_rows(batch(spark, 0, 10), f"{scratch}/target", table, "l1")
    with monkeypatch.context() as m:         # lost between the two writes
        m.setattr(K, "record", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            K.load_new_rows(batch(spark, 5, 20), f"{scratch}/target", table, "l2")
    for _ in range(2):
        assert K.load_new_rows(batch(spark, 5, 20), f"{scratch}/target", table, "l2").count() == 10
    assert target(spark, scratch) == [("2024-01", i) for i in range(20)]
    assert spark.table(table).count() == 20


def test_rebuild_and_compact(spark, scratch, table):
    for i in range(3):
        K.load_new_rows(batch(spark, 0, 10 * (i + 1)), f"{scratch}/target", table, f"l{i}")
    before = {r.line_key for r in spark.table(table).collect()}
    K.compact(spark, table, ["2024-01"])
    assert {r.line_key for r in spark.table(table).collect()} == before
    assert {r.load_id for r in spark.table(table).select("load_id").distinct().collect()} == {K.BASE}
    assert K.unseen(batch(spark, 0, 31), table).count() == 1
    K.rebuild(spark, f"{scratch}/target", table)
    assert {r.line_key for r in spark.table(table).collect()} == before


def test_plan_reads_touched_months_and_does_not_shuffle_the_index(spark, scratch, table):
    for month in ("2024-01", "2024-02", "2024-03"):
        K.load_new_rows(batch(spark, 0, 200, month), f"{scratch}/target", table, f"l-{month}")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        new = K.unseen(batch(spark, 150, 300, "2024-02"), table)
        plan = new._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert new.count() == 100
    assert plan.count("Exchange hashpartitioning") == 1          # the batch alone
    assert "Bucketed: true" in plan and "target" not in plan
    assert "month#" in plan.split("PartitionFilters:")[1].split("]")[0]
    files = new._jdf.queryExecution().optimizedPlan().toString()
    assert "2024-02" in files


def test_a_load_leaves_no_copy_of_its_rows_and_nothing_it_shuffled(spark, scratch, table):
    """Only what it adds to the tables: steps of a large load would add up on the disks."""
    def copies():
        return {x for x in os.listdir(checkpoint_dir(spark)) if x.startswith("new-rows")}

    def shuffled():
        env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
        files = env.blockManager().diskBlockManager().getAllFiles()
        names = (files.apply(i).getName() for i in range(files.size()))
        return {x for x in names if x.startswith("shuffle_")}
    before, old = copies(), shuffled()
    rows = batch(spark, 0, 500).unionByName(batch(spark, 0, 500, "2024-02")).repartition(3, "month")
    K.load_new_rows(rows.where("month = '2024-01'"), f"{scratch}/target", table, "l1")
    new = K.load_new_rows(rows, f"{scratch}/target", table, "l2")
    until = time.time() + 20                         # executors delete on their own
    while shuffled() - old and time.time() < until:
        time.sleep(0.2)
    assert copies() == before and not shuffled() - old
    assert sorted(r.amount for r in new.collect()) == list(range(500))
    assert new.columns == rows.columns


def test_only_rows_of_entered_months_are_looked_up(spark, scratch, table):
    K.load_new_rows(batch(spark, 0, 50), f"{scratch}/target", table, "l1")
    both = batch(spark, 40, 60).unionByName(batch(spark, 0, 9, "2024-02"))
    fresh, looked_up = K._by_lookup(both, table, "l2")
    assert "Join" not in fresh._jdf.queryExecution().executedPlan().toString()
    assert {(r.month, r.amount) for r in fresh.collect()} == {("2024-02", i) for i in range(9)}
    assert {(r.month, r.amount) for r in looked_up.collect()} == {("2024-01", i) for i in range(50, 60)}
    assert K.unseen(both, table).count() == 19


@pytest.mark.parametrize("load_id", ["2024-02-01 10:00:00", "a=b/c"])
def test_returned_rows_are_those_of_the_load(spark, scratch, table, load_id):
    """Also of ids and months that make odd folder names, and of loads without new rows."""
    K.load_new_rows(batch(spark, 0, 10), f"{scratch}/target", table, "l1")
    rows = batch(spark, 5, 20).unionByName(batch(spark, 0, 3, "a:b"))
    for _ in range(2):
        got = K.load_new_rows(rows, f"{scratch}/target", table, load_id)
        assert sorted((r.month, r.amount) for r in got.collect()) == \
            [("2024-01", i) for i in range(10, 20)] + [("a:b", i) for i in range(3)]
    gone = batch(spark, 0, 5).join(spark.range(3).where("id > 5"), F.col("amount") == F.col("id"),
                                   "left_semi")
    for none in (batch(spark, 0, 20), gone, spark.createDataFrame([], rows.schema)):
        got = K.load_new_rows(none, f"{scratch}/target", table, f"none-{uuid.uuid4().hex}")
        assert got.count() == 0 and got.columns == rows.columns
    undated = batch(spark, 0, 4).withColumn("month", F.lit(None).cast("string"))
    assert K.load_new_rows(undated, f"{scratch}/undated", table, "undated").count() == 4


LINE = ("id string, account_code string, transaction_date date, journal_id string, "
        "journal_number string, amount decimal(18,2), description string")


def lines(spark):
    one = spark.range(300).select(
        F.when(F.col("id") % 3 > 0, (F.col("id") % 40).cast("string")).alias("id"),
        (F.col("id") % 7).cast("string").alias("account_code"),
        F.expr("date_add(date'2024-01-20', cast(id % 30 as int))").alias("transaction_date"),
        F.when(F.col("id") % 2 > 0, F.lit("")).alias("journal_id"),
        F.lit("1").alias("journal_number"), (F.col("id") % 2).cast("decimal(18,2)").alias("amount"),
        F.lit("x").alias("description"))
    return one.unionByName(one.where("account_code < 4"))


def test_lines_dealt_by_month_are_shuffled_once_and_get_the_same_keys(spark, scratch, table,
                                                                      monkeypatch):
    keyed = LD.statement_keys(LD.dealt_by_month(lines(spark)), near=["month", "month_part"])
    want = LD.statement_keys(lines(spark))
    cols = [*want.columns]
    text = lambda df: sorted(str(tuple(r)) for r in df.select(*cols).collect())
    assert text(keyed) == text(want) and keyed.select("line_key").distinct().count() > 400
    plans, append = [], K._append

    def spy(rows, *a):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return append(rows, *a)
    monkeypatch.setattr(K, "_append", spy)
    new = K.load_new_rows(keyed.drop("month_part"), f"{scratch}/target", table, "l1", dealt=True)
    assert plans[0].count("Exchange") == 1
    assert text(new) == text(want)
    assert {r.month for r in new.collect()} == {"2024-01", "2024-02"}
