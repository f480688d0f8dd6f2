"""Invoice documents -> silver invoices and lines with Structured Streaming.

The newest document of an invoice wins, and its lines replace the stored ones as a set. Which
document is newest is a property of the document (``load_version``: its file and its place in
it), not of the time it is processed, so files may come in any order, in one or several
micro-batches, and a replayed micro-batch changes nothing.

Three tables below the target folder:

* ``headers`` and ``lines``, partitioned by the month of the invoice date;
* ``index``: invoice id -> month and version, partitioned by a bucket of the id's hash.

A merge looks its ids up in the touched buckets of the index, keeps the documents that are not older than
the stored version, and rewrites only the months where an invoice was or will be. An invoice whose
date moves it to another month is taken out of the old one. The index is written last: a micro-batch that
failed on the way finds the old index and does the same work again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.keys import month_key
from ..operators.loading import first_per_key, overwrite_partitions, staged, table_exists
from ..sources.api_json import INVOICE_PAGE_SCHEMA, invoice_documents, load_invoices

BUCKETS = 256
VERSION = ["source_file", "page_pos"]


def _bucket(invoice_id: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(invoice_id), F.lit(buckets)).cast("int")


def _read(spark: SparkSession, path: str, schema: StructType, column: str,
          values: list) -> DataFrame:
    """The partitions of a table that hold these values."""
    if not table_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).where(F.col(column).isin(values)) \
        .select(*schema.names)


def _values(df: DataFrame, column: str) -> list:
    """Distinct months or buckets: bounded by the calendar or by the number of buckets."""
    return [r[0] for r in df.select(column).distinct().collect()]


def merge_invoices(spark: SparkSession, docs: DataFrame, target_path: str, now_iso: str,
                   buckets: int = BUCKETS) -> None:
    """Merge invoice documents (``api_json.invoice_documents``) into the tables of a target.
    ``buckets`` has to stay the same for a target."""
    headers, lines = load_invoices(docs, now_iso)
    version = F.struct(*VERSION)
    newest = first_per_key(headers, ["invoice_id"], [F.col(c).desc() for c in VERSION]) \
        .withColumn("month", F.coalesce(month_key("invoice_date"), F.lit("unknown"))) \
        .withColumn("bucket", _bucket("invoice_id", buckets))
    newest = staged(newest, "invoice-documents")
    touched = _values(newest, "bucket")
    if not touched:
        return
    newest_index = newest.select("invoice_id", "month", *VERSION, "bucket")
    index = _read(spark, f"{target_path}/index", newest_index.schema, "bucket", touched)
    stored = index.select("invoice_id", F.col("month").alias("old_month"),
                          version.alias("old_version"))
    kept = newest.join(stored, "invoice_id", "left").where(
        F.col("old_version").isNull() | (version >= F.col("old_version"))).drop("old_version")
    kept = staged(kept, "invoice-kept")
    ids = kept.select("invoice_id")
    months = sorted(set(_values(kept, "month")) | {m for m in _values(kept, "old_month") if m})

    def rewrite(name: str, new: DataFrame) -> None:
        path = f"{target_path}/{name}"
        old = _read(spark, path, new.schema, "month", months)
        state = old.join(ids, "invoice_id", "left_anti").unionByName(new)
        overwrite_partitions(spark, state, path, "month", months)

    rewrite("headers", kept.drop("bucket", "old_month"))
    rewrite("lines", lines.join(kept.select("invoice_id", "month", *VERSION),
                                ["invoice_id", *VERSION]))
    entries = index.join(ids, "invoice_id", "left_anti").unionByName(
        kept.select("invoice_id", "month", *VERSION, "bucket"))
    overwrite_partitions(spark, entries, f"{target_path}/index", "bucket", touched)


def read_invoices(spark: SparkSession, target_path: str) -> DataFrame:
    return spark.read.parquet(f"{target_path}/headers").drop("month", *VERSION)


def read_invoice_lines(spark: SparkSession, target_path: str) -> DataFrame:
    return spark.read.parquet(f"{target_path}/lines").drop("month", *VERSION)


def stream_invoices(spark: SparkSession, pages_path: str, target_path: str, checkpoint_path: str,
                    now_iso: str, available_now: bool = True,
                    max_files_per_trigger: int | None = None, buckets: int = BUCKETS):
    """Start the invoice stream; returns the ``StreamingQuery``."""
    r = (spark.readStream.schema(INVOICE_PAGE_SCHEMA).option("multiLine", True)
         .option("recursiveFileLookup", True).option("pathGlobFilter", "*.json"))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)

    def merge(batch: DataFrame, batch_id: int) -> None:
        merge_invoices(spark, batch, target_path, now_iso, buckets)

    w = (invoice_documents(r.json(pages_path)).writeStream.foreachBatch(merge)
         .option("checkpointLocation", checkpoint_path))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
