"""Load windows of several pages, overlapping, in one or several micro-batches."""

import itertools
import json
import os
import random
from collections import Counter

import fixtures
import pytest

from ledgerspark.operators import loading as LD
from ledgerspark.sources import api_json as J
from ledgerspark.streaming import api_pages as P


def line(i="", amount=10, desc="d", date="2024-01-02"):
    return {"id": i, "accountCode": "1000", "date": date, "description": desc, "amount": amount,
            "entryId": "J1"}


def page(root, window, n, pages, lines, base=1):
    path = os.path.join(root, window, f"page-{n - 1 + base}.json")
    fixtures.write(path, json.dumps({"page": n, "pages": pages, "total": 9, "lines": lines}))
    return path


def loaded(spark, path):
    return Counter((r.id, float(r.amount), r.description)
                   for r in spark.read.parquet(path).collect())


def streamed(spark, scratch, files, per_batch, name):
    """The files dropped in this order, so many a micro-batch."""
    target, ck, drop = (os.path.join(scratch, f"{name}-{x}") for x in ("target", "ck", "in"))
    for i in range(0, len(files), per_batch):
        for source in files[i:i + per_batch]:
            to = os.path.join(drop, os.path.relpath(source, scratch))
            with open(source, encoding="utf-8") as f:
                fixtures.write(to, f.read())
        P.stream_statement_pages(spark, drop, target, ck, created_default="x").awaitTermination()
    return target, ck


@pytest.mark.parametrize("ids", [("", ""), ("a", "a"), ("a", "b")])
def test_equal_lines_on_two_pages_both_stay(spark, scratch, ids):
    files = [page(scratch, "w1", 1, 2, [line(ids[0])]), page(scratch, "w1", 2, 2, [line(ids[1])]),
             page(scratch, "w2", 1, 1, [line(ids[1])])]                # an overlapping window
    want = Counter((i, 10.0, "d") for i in ids)
    for n, (order, size) in enumerate([(files, 3), (files, 1), (files[::-1], 1)]):
        target, _ = streamed(spark, scratch, order, size, f"s{n}")
        assert loaded(spark, target) == want
    P.load_statement_pages(spark, os.path.join(scratch, "w1"), scratch + "/batch")
    P.load_statement_pages(spark, os.path.join(scratch, "w2"), scratch + "/batch")
    assert loaded(spark, scratch + "/batch") == want


def test_page_that_comes_again_adds_nothing(spark, scratch):
    files = [page(scratch, "w", n, 3, [line(), line("x")]) for n in (1, 2)]
    target, ck = streamed(spark, scratch, files, 1, "s")
    again = os.path.join(scratch, "s-in", "w", "page-1.json")
    os.utime(again, (2e9, 2e9))                          # same file, seen as new by its time only
    P.stream_statement_pages(spark, scratch + "/s-in", target, ck,
                             created_default="x").awaitTermination()
    assert loaded(spark, target) == {("", 10.0, "d"): 2, ("x", 10.0, "d"): 2}
    status = P.window_status(P.window_manifest(spark, ck)).collect()
    assert [(r.pages, r.pages_seen, r.complete) for r in status] == [(3, 2, False)]
    last = page(scratch, "w", 3, 3, [line()])
    with open(last, encoding="utf-8") as f:
        fixtures.write(os.path.join(scratch, "s-in", "w", "page-3.json"), f.read())
    P.stream_statement_pages(spark, scratch + "/s-in", target, ck,
                             created_default="x").awaitTermination()
    assert loaded(spark, target)["", 10.0, "d"] == 3
    assert P.window_status(P.window_manifest(spark, ck)).first().complete


def test_replayed_batch_changes_nothing(spark, scratch):
    """The merge run twice with one batch number, after a failure before its state was written."""
    files = [page(scratch, "w", n, 2, [line(), line()]) for n in (1, 2)]
    merge = P._merge_statements(spark, scratch + "/t", scratch + "/windows", created_default="x")
    for batch, f in enumerate(files):
        docs = J.page_files(J._read(spark, f, J.PAGE_SCHEMA))
        merge(docs, batch)
        merge(docs, batch)
    assert loaded(spark, scratch + "/t") == {("", 10.0, "d"): 4}


def test_random_windows_in_any_order_equal_the_largest_count(spark, scratch):
    """Every line is kept as often as the window that has it most often."""
    r = random.Random(4)
    files, windows = [], []
    for w in range(4):
        pages = [[line(r.choice(["", "a", "b"]), r.choice([1, 2]), r.choice("de"))
                  for _ in range(r.randrange(4))] for _ in range(r.randrange(1, 4))]
        windows.append(Counter((x["id"], float(x["amount"]), x["description"])
                               for x in itertools.chain(*pages)))
        files += [page(scratch, f"w{w}", n, len(pages), p, base=w % 2)
                  for n, p in enumerate(pages, 1)]
    want = Counter()
    for w in windows:
        want |= w
    r.shuffle(files)
    target, ck = streamed(spark, scratch, files, 3, "s")
    assert loaded(spark, target) == want
    status = P.window_status(P.window_manifest(spark, ck))
    assert status.count() == 4 and status.where("NOT complete").count() == 0


def test_window_names(spark):
    rows = [("f/page-1.json", 1, 3), ("f/page-2.json", 2, 3), ("f/page-0.json", 1, 3),
            ("f/page-1.json", 1, 1), ("f/page-7.json", 1, 3), ("f/x.json", 1, 2), ("f/y", None, None)]
    df = spark.createDataFrame(rows, "f string, page long, pages long")
    got = [r[0] for r in df.select(J.load_window(df.f, df.page, df.pages)).collect()]
    assert got == ["f/page-#0/3", "f/page-#0/3", "f/page-#-1/3", "f/page-1.json", "f/page-7.json",
                   "f/x.json", "f/y"]


def test_equal_lines_are_numbered_page_by_page(spark):
    """A line that every row of a window repeats is split by page, and no number is used twice."""
    from pyspark.sql import functions as F
    rows = spark.range(4000).select(
        F.lit("").alias("id"), F.lit("1").alias("account_code"), F.lit("J").alias("journal_id"),
        F.lit("1").alias("journal_number"), F.lit(5).cast("decimal(18,2)").alias("amount"),
        F.lit("d").alias("description"), F.lit("2024-01-01").cast("date").alias("transaction_date"),
        F.lit("w").alias("load_window"), (F.col("id") % 40).alias("page"),
        F.floor(F.col("id") / 40).alias("page_pos"),
        F.concat(F.lit("f"), F.col("id") % 40).alias("source_file"))
    keyed = LD.statement_keys(rows)
    assert keyed.select("line_key").distinct().count() == 4000
    n = keyed.select(F.split("occurrence_no", "-")[1].cast("int").alias("n"))
    assert n.agg(F.min("n"), F.max("n"), F.countDistinct("n")).first()[:] == (1, 4000, 4000)
