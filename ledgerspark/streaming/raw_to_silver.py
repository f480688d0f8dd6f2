"""Raw statement files -> silver tables with Structured Streaming.

"Re-run fetch/parse safely" becomes a file stream: the file source remembers which files it
has processed (in the checkpoint), so each run parses only new account-month files.
``trigger(availableNow=True)`` drains what is there and stops — a batch job with streaming
bookkeeping. Each micro-batch is merged with J2 (insert-or-ignore on the silver key) inside
``foreachBatch``: if a batch is replayed after a failure, the anti-join finds the rows the
failed attempt already committed, so the sink is effectively exactly-once. Late months are
ordinary new files; there is no event-time state to expire, hence no watermark.

Files that can't be loaded (A3) are a second sink of the same micro-batch: a reject table with one row
a file and the reason, so that nothing is lost in silence.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import month_key
from ..operators.loading import append_rows, insert_or_ignore, table_exists
from ..sources import statement_xml as X


def _file_stream(spark: SparkSession, raw_path: str, max_files: int | None) -> DataFrame:
    r = (spark.readStream.option("recursiveFileLookup", True).option("pathGlobFilter", "*.xml"))
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    files = r.text(raw_path, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("file_path"), "value")


def _existing(spark: SparkSession, path: str, like: DataFrame) -> DataFrame | None:
    """The stored table; its schema is given, as a batch without rows leaves a folder without
    files."""
    return spark.read.schema(like.schema).parquet(path) if table_exists(spark, path) else None


def _merge_batch(spark, target_path, key_cols, order_cols, date_col):
    """J2 inside foreachBatch. The silver target is month-partitioned and a row's month is
    fixed by its key (the key contains the date), so only the target months present in the
    batch are read: the batch's distinct months (bounded by the calendar, not by the data)
    become a partition filter, and the anti-join runs on (month, key)."""
    def merge(batch: DataFrame, batch_id: int) -> None:
        # rows without a date go to an explicit "unknown" month, so replays still find them
        batch = batch.withColumn("month", F.coalesce(month_key(date_col), F.lit("unknown")))
        batch = batch.persist()              # read by the months and by the merge
        target = _existing(spark, target_path, batch)
        if target is not None:
            months = [r[0] for r in batch.select("month").distinct().collect()]
            target = target.where(F.col("month").isin(months))
        new = insert_or_ignore(target, batch, key_cols, order_cols, partition_cols=["month"])
        append_rows(new, target_path, ["month"])
        batch.unpersist()
    return merge


def _set_aside(spark: SparkSession, parsed: DataFrame, rejects_path: str) -> None:
    """A3: the rejected files of a batch with their reason, once each: the table is keyed by the
    file, so a replayed batch or a new checkpoint enters none again."""
    rejected = X.rejected_files(parsed)
    new = insert_or_ignore(_existing(spark, rejects_path, rejected), rejected, ["file_path"])
    append_rows(new.withColumn("rejected_at", F.current_timestamp()), rejects_path)


def _two_sinks(spark, rows_of, merge, rejects_path):
    """Good rows to silver, rejected files to the reject table; both sinks may see a batch twice."""
    def run(parsed: DataFrame, batch_id: int) -> None:
        parsed = parsed.drop("value").persist()      # parsed once for both sinks
        merge(rows_of(parsed), batch_id)
        if rejects_path is not None:
            _set_aside(spark, parsed, rejects_path)
        parsed.unpersist()
    return run


def _start(parsed: DataFrame, run, checkpoint_path: str, available_now: bool):
    w = parsed.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint_path)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def _bank(spark, target_path, rejects_path):
    merge = _merge_batch(spark, target_path, ["id"], ["source_period", "raw_hash"], "booking_date")
    return _two_sinks(spark, X.bank_transactions, merge, rejects_path)


def _cards(spark, target_path, rejects_path):
    # the per-file occurrence window runs inside foreachBatch (a whole file is always in
    # one micro-batch, so the numbering equals the batch job's)
    merge = _merge_batch(spark, target_path, ["card_id", "entry_id"],
                         ["source_period", "raw_hash"], "date")
    return _two_sinks(spark, X.card_transactions, merge, rejects_path)


def stream_bank_to_silver(spark: SparkSession, raw_accounts_path: str, target_path: str,
                          checkpoint_path: str, available_now: bool = True,
                          max_files_per_trigger: int | None = None,
                          rejects_path: str | None = None):
    """Start the bank stream; returns the ``StreamingQuery`` (``awaitTermination()`` it).
    ``rejects_path``: table of the files that were set aside (error bodies, broken XML)."""
    files = _file_stream(spark, raw_accounts_path, max_files_per_trigger)
    return _start(X.parse_bank_files(files), _bank(spark, target_path, rejects_path),
                  checkpoint_path, available_now)


def stream_cards_to_silver(spark: SparkSession, raw_cards_path: str, target_path: str,
                           checkpoint_path: str, available_now: bool = True,
                           max_files_per_trigger: int | None = None,
                           rejects_path: str | None = None):
    """Start the card stream (key: card_id, entry_id incl. the surrogate for deposits)."""
    files = _file_stream(spark, raw_cards_path, max_files_per_trigger)
    return _start(X.parse_card_files(files), _cards(spark, target_path, rejects_path),
                  checkpoint_path, available_now)


def batch_bank_to_silver(spark: SparkSession, raw_accounts_path: str, target_path: str,
                         rejects_path: str | None = None) -> None:
    """The same load as one batch job (for comparison with the stream)."""
    parsed = X.parse_bank_files(X.read_files(spark, raw_accounts_path))
    _bank(spark, target_path, rejects_path)(parsed, 0)
