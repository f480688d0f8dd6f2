"""Registry, sheet profiles and totals, renderers and exports."""

import json
import os
from decimal import Decimal

import fixtures

from ledgerspark.sources import api_json as J
from pyspark.sql import functions as F

from ledgerspark.sources import sheets, sinks


def test_account_registry(spark, scratch):
    fixtures.write_registry_json(scratch)
    rows = J.account_registry(spark, scratch).collect()
    assert [(r.branch, r.ledger, r.account_no) for r in rows] == [("0101", "26", "000123")]


def test_sheet_profile_totals_and_accounts(spark, scratch):
    fixtures.write_profile_csv(scratch)
    prof = sheets.sheet_profile_source(spark, scratch, ["Reikningur", "Account"], ["Debet"], ["Kredit"])
    tot = {os.path.basename(r.file): r for r in sheets.sheet_totals(prof).collect()}
    assert tot["a.csv"].rows == 3 and tot["a.csv"].total_debit == Decimal("105.50")
    assert tot["a.csv"].total_credit == Decimal("20.00") and tot["a.csv"].account == "0101-26-000123"
    assert tot["b.csv"].account == "010126000124"          # blanks dropped; "123" is too short
    accts = sorted(r.account_number for r in sheets.distinct_accounts(prof).collect())
    assert accts == ["0101-26-000123", "010126000124"]


def test_sheet_currency_last_hint_wins(spark, scratch):
    fixtures.write_profile_csv(scratch)
    cur = {r.file_name: r.currency for r in sheets.sheet_currency(spark, scratch).collect()}
    assert cur == {"a.csv": "ISK", "b.csv": "EUR"}


def test_renderers(spark):
    df = spark.createDataFrame([("a\"b", 1, None), ("c", None, 2.5)], "s string, i int, d double")
    assert [r.value for r in sinks.render_json(df).collect()] == ['{"s":"a\\"b","i":1}', '{"s":"c","d":2.5}']
    assert [r.value for r in sinks.render_csv(df).collect()] == ['"a\\"b",1,""', '"c","",2.5']
    assert sinks.csv_header(df) == "s,i,d"
    assert [r.value for r in sinks.render_markdown(df).collect()] == ["| a\"b | 1 |  |", "| c |  | 2.5 |"]
    assert sinks.markdown_header(df) == "| s | i | d |\n| - | - | - |"


def test_export_view(spark, scratch):
    df = spark.range(0, 20).selectExpr("id", "id % 3 AS g")
    sinks.export_view(df, scratch + "/out", where="g = 1", order_by=["id"], limit=3)
    got = sorted(json.loads(line)["id"] for f in os.listdir(scratch + "/out") if f.endswith(".json")
                 for line in open(os.path.join(scratch, "out", f)))
    assert got == [1, 4, 7]
    sinks.export_view(df, scratch + "/pq", fmt="parquet")
    assert spark.read.parquet(scratch + "/pq").count() == 20


def _sheet_rows(df):
    return sorted(tuple(str(v) for v in r) for r in df.collect())


def test_large_sheets_give_the_same_rows_in_several_tasks(spark, scratch):
    fixtures.write_sheet_csv(scratch + "/a")
    lines = ["x", "0101-26-000777 Big account", "", "", "Tilvísun,Dags,Texti,Upphæð,Staða"]
    lines += [f'r{i},{1 + i % 28:02d}.01.2024,"text, {i}","{i}","{i % 7}"' if i % 50 else ""
              for i in range(6000)]
    fixtures.write(scratch + "/a/big.csv", "\r\n".join(lines) + "\r\n")
    fixtures.write(scratch + "/a/short.csv", "only\nthree\nlines")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1000")
    try:
        blocks = sheets.numbered_lines(spark, scratch + "/a")
        got = _sheet_rows(sheets.large_statement_sheet_source(spark, scratch + "/a"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    want = _sheet_rows(sheets.statement_sheet_source(spark, scratch + "/a"))
    assert len(want) > 5000 and got == want
    numbers = blocks.where("file_name = 'big.csv'").groupBy("line_no").count()
    assert numbers.count() == len(lines) and numbers.where("count > 1").count() == 0
    parts = blocks.where("file_name = 'big.csv'").select(F.spark_partition_id().alias("p"))
    assert parts.distinct().count() > 1


def test_large_sheets_by_position(spark, scratch):
    fixtures.write_serial_sheet_csv(scratch)
    for large, source in ((True, sheets.large_statement_sheet_source),
                          (False, sheets.statement_sheet_source)):
        rows = _sheet_rows(source(spark, scratch, amount_format="is", positional=True))
        first = rows if large else first
        assert rows == first and rows
