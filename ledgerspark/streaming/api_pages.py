"""Accounting statement pages -> silver statements with Structured Streaming (J1 + J2/J7).

The incremental loaders pull date windows that overlap on their boundary day; as a file
stream, every dropped page file is parsed once (the checkpoint remembers processed files) and
each micro-batch is keyed (statement business key, ``loading.statement_keys``) and merged
with insert-or-ignore inside ``foreachBatch``: an overlapping window re-delivers lines whose
keys already exist, so they are skipped. The keying window runs on the static micro-batch
(windows are not allowed on the stream itself); the target is read only for the months the
batch touches.

A window may have many pages, and they may come in different micro-batches and in any order. The
folder ``windows`` in the checkpoint of the query keeps, by micro-batch,

* ``manifest``: one row a page file: load window, page, pages, lines, micro-batch;
* ``counts``: how often each line occurs in a page, only for pages of windows that were not
  complete at the end of their micro-batch. Most windows come whole, so this stays small.

A later page numbers its lines after the equal lines of the pages that came before it. Both tables
are overwritten by the number of the micro-batch, so a replayed one writes the same rows again and
reads those of earlier ones only. A new checkpoint begins with no windows, as it reads all files
again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import month_key
from ..operators.loading import (append_rows, first_per_key, insert_or_ignore, page_counts,
                                 statement_keys, table_exists)
from ..sources.api_json import (PAGE_COLUMNS, PAGE_SCHEMA, load_statements, page_files,
                                page_lines)

MANIFEST = "load_window string, page long, pages long, source_file string, lines long, batch long"
COUNTS = "line_group string, source_file string, load_window string, page long, n long, batch long"


def _pages(spark: SparkSession, path: str, max_files: int | None) -> DataFrame:
    r = (spark.readStream.schema(PAGE_SCHEMA).option("multiLine", True)
         .option("recursiveFileLookup", True).option("pathGlobFilter", "*.json"))
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return page_files(r.json(path))


def _state(spark: SparkSession, path: str, schema: str, before: int) -> DataFrame:
    """What earlier micro-batches wrote."""
    rows = (spark.read.schema(schema).parquet(path) if table_exists(spark, path)
            else spark.createDataFrame([], schema))
    return rows.where(F.col("batch") < before)


def _write_state(rows: DataFrame, path: str, batch: int) -> None:
    rows.drop("batch").write.mode("overwrite").parquet(f"{path}/batch={batch}")


def window_manifest(spark: SparkSession, checkpoint_path: str) -> DataFrame:
    """One row a page file that a stream with this checkpoint has loaded."""
    return _state(spark, f"{checkpoint_path}/windows/manifest", MANIFEST, 1 << 62)


def window_status(manifest: DataFrame) -> DataFrame:
    """Per load window: pages expected and seen, lines, and whether all pages have come."""
    return manifest.groupBy("load_window").agg(
        F.max("pages").alias("pages"), F.countDistinct("page").alias("pages_seen"),
        F.sum("lines").alias("lines"), F.max("batch").alias("last_batch")) \
        .withColumn("complete", F.coalesce(F.col("pages_seen") >= F.col("pages"), F.lit(True)))


def _merge_statements(spark: SparkSession, target_path: str, windows_path: str, **load):
    manifest_path, counts_path = f"{windows_path}/manifest", f"{windows_path}/counts"

    def merge(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()              # read by the manifest and by the lines
        files = batch.select(
            "load_window", "page", "pages", "source_file",
            F.coalesce(F.when(F.col("lines").isNotNull(), F.size("lines")), F.lit(0))
            .cast("long").alias("lines"), F.lit(batch_id).cast("long").alias("batch"))
        rows = load_statements(page_lines(batch), **load)
        # a page that comes again does not count before itself
        here = batch.select("load_window").distinct()
        earlier = _state(spark, counts_path, COUNTS, batch_id).join(here, "load_window", "left_semi") \
            .join(batch.select("load_window", "page"), ["load_window", "page"], "left_anti") \
            .groupBy("load_window", "line_group").agg(F.sum("n").alias("n"))
        # numbered within each load window, then one row per key across windows; persisted, as
        # the months and the merge both read it
        keyed = first_per_key(statement_keys(rows, earlier=earlier), ["line_key"], ["id"]) \
            .drop(*PAGE_COLUMNS)
        keyed = keyed.withColumn(
            "month", F.coalesce(month_key("transaction_date"), F.lit("unknown"))).persist()
        target = None
        if table_exists(spark, target_path):
            # a batch without lines leaves a folder without files
            target = spark.read.schema(keyed.schema).parquet(target_path)
            months = [r[0] for r in keyed.select("month").distinct().collect()]
            target = target.where(F.col("month").isin(months))
        new = insert_or_ignore(target, keyed, ["line_key"], partition_cols=["month"],
                               keys_unique=True)
        append_rows(new, target_path, ["month"])
        # the state comes last: a batch that fails before it is replayed against the old state
        known = _state(spark, manifest_path, MANIFEST, batch_id).unionByName(files)
        still_open = window_status(known.join(here, "load_window", "left_semi")) \
            .where(~F.col("complete")).select("load_window")
        _write_state(page_counts(rows).join(still_open, "load_window", "left_semi")
                     .select(*[c.split()[0] for c in COUNTS.split(", ")[:-1]]), counts_path, batch_id)
        _write_state(files, manifest_path, batch_id)
        keyed.unpersist()
        batch.unpersist()
    return merge


def stream_statement_pages(spark: SparkSession, pages_path: str, target_path: str,
                           checkpoint_path: str, typed: bool = True, available_now: bool = True,
                           max_files_per_trigger: int | None = None,
                           created_default: str | None = None):
    """Start the statement-page stream; returns the ``StreamingQuery``."""
    merge = _merge_statements(spark, target_path, f"{checkpoint_path}/windows", typed=typed,
                              created_default=created_default)
    w = (_pages(spark, pages_path, max_files_per_trigger).writeStream.foreachBatch(merge)
         .option("checkpointLocation", checkpoint_path))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def load_statement_pages(spark: SparkSession, pages_path: str, target_path: str,
                         typed: bool = True, created_default: str | None = None) -> None:
    """The same load as one batch job over all page files: every window whole."""
    from ..sources.api_json import statement_pages_source
    rows = load_statements(statement_pages_source(spark, pages_path), typed=typed,
                           created_default=created_default)
    keyed = first_per_key(statement_keys(rows), ["line_key"], ["id"]).drop(*PAGE_COLUMNS) \
        .withColumn("month", F.coalesce(month_key("transaction_date"), F.lit("unknown")))
    target = (spark.read.schema(keyed.schema).parquet(target_path)
              if table_exists(spark, target_path) else None)
    append_rows(insert_or_ignore(target, keyed, ["line_key"], partition_cols=["month"],
                                 keys_unique=True), target_path, ["month"])
