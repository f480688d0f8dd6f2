"""Load metrics observed by the write job, rejected files as a second sink."""

import datetime as dt
import os

import fixtures

from ledgerspark.operators import loading as LD
from ledgerspark.sources.sinks import read_silver
from ledgerspark.streaming import raw_to_silver as R


def _rows(spark, n, month=1):
    return spark.createDataFrame([(i, dt.date(2024, month, 1 + i)) for i in range(n)],
                                 "id int, transaction_date date")


def _log(spark, scratch):
    return sorted((r.operation_type, r.date_from, r.records_loaded)
                  for r in spark.read.parquet(scratch + "/log").collect())


def test_log_is_filled_by_the_write_job(spark, scratch):
    args = (scratch + "/t", scratch + "/log", "incremental")
    seen = LD.load_and_log(spark, _rows(spark, 5), *args, "2024-01-01", "2024-01-31")
    assert seen["records"] == 5 and seen["last_date"] == dt.date(2024, 1, 5)
    LD.load_and_log(spark, _rows(spark, 0), *args, "2024-02-01", "2024-02-29")
    assert _log(spark, scratch) == [("incremental", "2024-01-01", 5), ("incremental", "2024-02-01", 0)]
    LD.load_and_log(spark, _rows(spark, 3), *args, "2024-01-01", "2024-01-31")   # the entry is replaced
    assert _log(spark, scratch)[0] == ("incremental", "2024-01-01", 3)


def test_rows_are_not_counted_again(spark, scratch):
    rows = _rows(spark, 9)
    spark.sparkContext.setJobGroup("observed-load", "")
    try:
        seen = LD.append_observed(rows, scratch + "/t")
    finally:
        spark.sparkContext.setJobGroup("", "")
    assert seen["records"] == 9
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("observed-load")) == 1


def _rejects(spark, scratch):
    return sorted((os.path.basename(r.file_path), r.reject_reason)
                  for r in spark.read.parquet(scratch + "/rejects").collect())


def test_rejected_files_are_set_aside_once(spark, scratch):
    fixtures.write_bank_tree(scratch + "/raw")
    raw = scratch + "/raw/accounts"
    fixtures.write(raw + "/0101-26-000123/2024-08.xml", "<broken")
    args = (spark, raw, scratch + "/silver")
    R.stream_bank_to_silver(*args, scratch + "/ck", max_files_per_trigger=1,
                            rejects_path=scratch + "/rejects").awaitTermination()
    first, silver = _rejects(spark, scratch), read_silver(spark, scratch + "/silver").count()
    assert ("2024-08.xml", "unparsable") in first and "error_body" in {r for _, r in first}
    assert len(first) == len(set(first)) and silver == 4
    # another checkpoint reads everything again, a batch job too
    R.stream_bank_to_silver(*args, scratch + "/ck2", rejects_path=scratch + "/rejects").awaitTermination()
    R.batch_bank_to_silver(*args, rejects_path=scratch + "/rejects")
    assert _rejects(spark, scratch) == first
    assert read_silver(spark, scratch + "/silver").count() == silver


def test_rejected_card_files(spark, scratch):
    fixtures.write_card_tree(scratch + "/raw")
    fixtures.write(scratch + "/raw/cards/C9/2024-01.xml", "<LI_Villa>no</LI_Villa>")
    R.stream_cards_to_silver(spark, scratch + "/raw/cards", scratch + "/c", scratch + "/ck",
                             rejects_path=scratch + "/rejects").awaitTermination()
    assert ("2024-01.xml", "error_body") in _rejects(spark, scratch)
    assert read_silver(spark, scratch + "/c").count() == 4
