"""A file stream with availableNow equals the batch load, and re-runs are idempotent."""

import os

import fixtures

from ledgerspark.sources.sinks import read_silver
from ledgerspark.streaming import raw_to_silver as R


def _rows(spark, path):
    return sorted((r.id, str(r.amount)) for r in read_silver(spark, path).collect())


def test_stream_equals_batch_and_is_incremental(spark, scratch):
    fixtures.write_bank_tree(os.path.join(scratch, "raw"))
    raw = os.path.join(scratch, "raw", "accounts")
    R.stream_bank_to_silver(spark, raw, scratch + "/s_stream", scratch + "/ck").awaitTermination()
    R.batch_bank_to_silver(spark, raw, scratch + "/s_batch")
    assert _rows(spark, scratch + "/s_stream") == _rows(spark, scratch + "/s_batch")
    assert len(_rows(spark, scratch + "/s_stream")) == 4
    fixtures.write(os.path.join(raw, "0101-26-000123", "2024-06.xml"), fixtures.bank_doc(
        [fixtures._bank_row(bokunardags="2024-06-01", upphaed="5.00", tilvisun="N1", rb_bunkanr="X",
                            textalykill="T")]))
    R.stream_bank_to_silver(spark, raw, scratch + "/s_stream", scratch + "/ck").awaitTermination()
    assert len(_rows(spark, scratch + "/s_stream")) == 5
    R.batch_bank_to_silver(spark, raw, scratch + "/s_stream")       # replay: nothing new
    assert len(_rows(spark, scratch + "/s_stream")) == 5


def test_card_stream(spark, scratch):
    fixtures.write_card_tree(os.path.join(scratch, "raw"))
    R.stream_cards_to_silver(spark, os.path.join(scratch, "raw", "cards"), scratch + "/c",
                             scratch + "/ckc").awaitTermination()
    assert read_silver(spark, scratch + "/c").count() == 4          # E1, E2, two deposit keys


def test_statement_page_stream_skips_overlap(spark, scratch):
    import json

    from ledgerspark.streaming.api_pages import stream_statement_pages
    pages = os.path.join(scratch, "pages")
    fixtures.write_statement_pages(pages)
    args = (spark, pages, scratch + "/stm", scratch + "/ck_pages")
    stream_statement_pages(*args, created_default="2024-06-01").awaitTermination()
    first = spark.read.parquet(scratch + "/stm")
    assert first.count() == 3
    # the next window starts on the boundary day: a1 is delivered again, n1 is new
    again = {"page": 1, "pages": 1, "total": 2, "lines": [
        {"id": "a1", "accountCode": "1000", "accountName": "Sala", "accountType": "Tekjur",
         "accountSubType": "Rekstrartekjur", "date": "2024-01-02", "description": "Invoice 1",
         "reference": "R1", "amount": 1000, "balance": 1000, "currency": "ISK",
         "entryId": "J1", "voucher": "V1", "created": "2024-01-02T10:00:00Z"},
        {"id": "n1", "accountCode": "1000", "accountName": "Sala", "accountType": "Tekjur",
         "date": "2024-01-09", "description": "Invoice 2", "amount": 50, "entryId": "J9"}]}
    fixtures.write(os.path.join(pages, "page-next.json"), json.dumps(again))
    stream_statement_pages(*args, created_default="2024-06-01").awaitTermination()
    rows = spark.read.parquet(scratch + "/stm")
    assert rows.count() == 4
    assert rows.where("id = 'a1'").count() == 1


def test_overlapping_windows_in_one_batch(spark, scratch):
    """The same line in two page files of one micro-batch is one row; equal lines of one file
    stay apart."""
    import json

    from ledgerspark.streaming.api_pages import stream_statement_pages
    pages = os.path.join(scratch, "pages")
    line = {"id": "a1", "accountCode": "1000", "date": "2024-01-02", "description": "d",
            "amount": 10, "entryId": "J1"}
    for name, lines in (("one", [line, dict(line)]), ("two", [line, dict(line, amount=11)])):
        fixtures.write(os.path.join(pages, f"page-{name}.json"),
                       json.dumps({"page": 1, "pages": 1, "total": 2, "lines": lines}))
    stream_statement_pages(spark, pages, scratch + "/s", scratch + "/c",
                           created_default="x").awaitTermination()
    got = [float(r.amount) for r in spark.read.parquet(scratch + "/s").collect()]
    assert sorted(got) == [10.0, 10.0, 11.0]
