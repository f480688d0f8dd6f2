"""Sinks and renderers.

``write_silver`` is the idempotent table write: range-partitioned on (date, key) so a hot
month or account is split across many writer tasks (Spark samples the range bounds), Hive-
partitioned by month for partition pruning, and sorted by key inside each file so Parquet
min/max statistics skip row groups on account filters. ``overwrite`` uses dynamic partition
overwrite: only the months present in the batch are replaced.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import month_key


#: Bytes of a file: one is not larger than the first, and not smaller than the second unless
#: there is less to write.
FILE_BYTES, LEAST_FILE_BYTES = 128 << 20, 8 << 20
#: What ``planned_bytes`` says of tables whose size the optimizer doesn't know.
UNKNOWN_BYTES = 1 << 50


def file_count(n_bytes: int, writers: int) -> int:
    """Files for so many bytes: by size, but as many as there are writers while files stay
    reasonably large."""
    by_size = -(-n_bytes // FILE_BYTES)
    return max(1, by_size, min(writers, -(-n_bytes // LEAST_FILE_BYTES)))


def planned_bytes(df: DataFrame) -> int:
    """The size that the optimizer expects of a table's input: the bytes of the files it reads,
    without running anything."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size())]
    return min(sum(sizes), UNKNOWN_BYTES)


def write_silver(df: DataFrame, path: str, date_col: str, key_cols: list[str],
                 mode: str = "overwrite", partitions: int | None = None,
                 partition_by: str | None = "month", cluster: bool = True) -> None:
    """Write a silver table.

    ``cluster=True`` range-partitions on (date, key) (Spark samples the bounds, so a hot month
    or account is split across writers) and sorts each file, giving files with narrow
    date/account ranges whose min/max statistics prune; worth its sampling pass once a table
    spans many row groups. ``cluster=False`` spreads rows round-robin (one pass) and only
    sorts within files — for small tables.

    The number of files follows the bytes of the input (``file_count``) unless ``partitions`` says
    otherwise.

    ``partition_by="month"`` adds Hive month directories for partition pruning; use it once a
    month holds at least a row group or so (production volumes). For small tables (a month of
    a few thousand rows) ``None`` keeps one directory: listing many tiny month directories
    would cost more than it prunes.
    """
    n = partitions or file_count(planned_bytes(df), df.sparkSession.sparkContext.defaultParallelism)
    if cluster:
        out = df.repartitionByRange(n, F.col(date_col), *[F.col(k) for k in key_cols])
    else:
        out = df.repartition(n)
    if partition_by == "month":
        out = out.withColumn("month", month_key(date_col)).sortWithinPartitions(
            "month", *key_cols)
        (out.write.mode(mode).option("partitionOverwriteMode", "dynamic")
            .partitionBy("month").parquet(path))
    else:
        out.sortWithinPartitions(date_col, *key_cols).write.mode(mode).parquet(path)


def write_bucketed(df: DataFrame, table: str, key_cols: list[str], buckets: int,
                   mode: str = "overwrite") -> None:
    """A11 (co-located layout): a catalog table bucketed and sorted on ``key_cols``. Tables
    that are joined on the same key and written with the same bucket count (e.g. invoices and
    invoice lines on ``invoice_id``) join bucket-to-bucket: a sort-merge join with no exchange
    on either side, so neither table is shuffled at query time."""
    (df.write.mode(mode).bucketBy(buckets, *key_cols).sortBy(*key_cols)
       .saveAsTable(table))


def read_silver(spark, path: str, date_col: str | None = None, since: str | None = None,
                until: str | None = None) -> DataFrame:
    """Read a silver table written by ``write_silver`` (a ``month`` partition column is
    dropped again so the schema equals the declared silver schema).

    With ``date_col`` only rows from ``since`` to ``until`` (both included, each optional) are
    read: the dates are bounds of the scan, and where there are month folders their months choose
    the folders."""
    df = spark.read.parquet(path)
    for day, compare in ((since, "__ge__"), (until, "__le__")):
        if day is not None:
            df = df.where(getattr(F.col(date_col), compare)(F.lit(day).cast("date")))
            if "month" in df.columns:
                df = df.where(getattr(F.col("month"), compare)(F.lit(day[:7])))
    return df.drop("month") if "month" in df.columns else df


def render_json(df: DataFrame) -> DataFrame:
    """A12 (json): one JSON object per row (``to_json(struct(*))``)."""
    return df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("value"))


def render_csv(df: DataFrame) -> DataFrame:
    """A12 (csv): every value JSON-quoted, NULL -> ``""``, as in the source's CSV output
    (header line is ``csv_header``)."""
    parts = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        # strings, dates and times quoted and escaped, numbers and booleans bare, null -> ""
        if f.dataType.simpleString() in ("string", "date", "timestamp", "timestamp_ntz"):
            item = F.to_json(F.array(c.cast("string")))
            v = item.substr(F.lit(2), F.length(item) - 2)
        else:
            v = c.cast("string")
        parts.append(F.coalesce(v, F.lit('""')))
    return df.select(F.concat_ws(",", *parts).alias("value"))


def csv_header(df: DataFrame) -> str:
    return ",".join(df.columns)


def render_markdown(df: DataFrame) -> DataFrame:
    """A12 (markdown): ``| v1 | v2 |`` per row, NULL -> empty; the header and separator
    lines are ``markdown_header``; an empty result renders as ``| (no rows) |``."""
    cells = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in df.columns]
    return df.select(F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")).alias("value"))


def markdown_header(df: DataFrame) -> str:
    cols = df.columns
    return f"| {' | '.join(cols)} |\n| {' | '.join('-' for _ in cols)} |"


EMPTY_MARKDOWN = "| (no rows) |\n|---|"


def render_rows(df: DataFrame, fmt: str = "json") -> tuple[str | None, DataFrame]:
    """(header text or None, one rendered line per row) for json / csv / markdown. The
    lines stay a distributed DataFrame; the caller bounds them (the SQL tool's row cap) before
    joining them into one document with ``rows_to_text``. An empty markdown result renders
    as ``EMPTY_MARKDOWN``."""
    if fmt == "csv":
        return csv_header(df), render_csv(df)
    if fmt == "markdown":
        return markdown_header(df), render_markdown(df)
    if fmt == "json":
        return None, render_json(df)
    raise ValueError("format must be json, csv or markdown")


def export_view(df: DataFrame, path: str, where: str | None = None,
                order_by: list[str] | None = None, limit: int | None = None,
                fmt: str = "json") -> None:
    """Filtered / ordered / limited export of a view to JSON or Parquet files."""
    out = df
    if where:
        out = out.where(F.expr(where))
    if order_by:
        out = out.orderBy(*order_by)
    if limit is not None:
        out = out.limit(limit)
    writer = out.write.mode("overwrite")
    if fmt == "parquet":
        writer.parquet(path)
    else:
        writer.json(path)


def rows_to_text(rows: list[str], header: str | None = None) -> str:
    """Join rendered rows (already bounded by the caller's cap) into one document."""
    body = "\n".join(rows)
    return f"{header}\n{body}" if header else body


def to_json_text(records: list[dict]) -> str:
    return json.dumps(records, indent=2, default=str)
