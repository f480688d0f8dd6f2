"""Idempotent loading (J2-J7): keyed insert-or-ignore / insert-or-replace, account metadata
updates, incremental windows and the load log. Parquet has no MERGE, so each operator
computes the rows to append (or the new state of the touched partitions) as a DataFrame.

Scale notes:
* keyed de-duplication is ``row_number() = 1`` per key; Spark runs it with a partial
  WindowGroupLimit before the shuffle, so a key repeated a million times ships one row per
  map task, not a million;
* the anti-join against the target includes the target's partition columns when given, so
  dynamic partition pruning reads only the target partitions the batch touches;
* replacing partitions never reads and overwrites one path in the same job: the new state is
  first written to a staging table under the shared checkpoint folder.
"""

from __future__ import annotations

import datetime as _dt
import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.keys import month_key
from ..session import scratch_path

ISO = re.compile(r"^\d{4}-\d{2}-\d{2}$")
STATEMENT_KEY = ["account_code", "transaction_date", "journal_id", "journal_number", "amount",
                 "description"]
MONTH_PARTS = 32                   # tasks that the lines of one month are dealt to at most


def _cols(names):
    return [F.col(c) if isinstance(c, str) else c for c in names]


def with_occurrence(df: DataFrame, key_cols: list[str], order_cols: list[str | Column],
                    name: str = "occurrence_no", salt: Column | None = None) -> DataFrame:
    """Number genuinely equal rows *within one batch* in load order, so that equal lines
    survive as distinct keys while re-loading the same batch yields the same keys.

    With ``salt`` (a deterministic per-row value with a few distinct values) each group of
    equal rows is split into sub-groups numbered independently and the occurrence becomes
    ``<salt>-<n>``: still unique and stable, but a hot group of identical rows is spread
    over as many tasks as there are salt values instead of being sorted by one task.
    """
    parts = list(key_cols) + ([salt.alias("__salt")] if salt is not None else [])
    w = Window.partitionBy(*parts).orderBy(*_cols(order_cols))
    rn = F.row_number().over(w)
    if salt is None:
        return df.withColumn(name, rn)
    return df.withColumn(name, F.concat(salt, F.lit("-"), rn.cast("string")))


def first_per_key(df: DataFrame, key_cols: list[str], order_cols: list[str | Column]) -> DataFrame:
    """The first row of each key in ``order_cols`` order."""
    w = Window.partitionBy(*key_cols).orderBy(*_cols(order_cols))
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def insert_or_ignore(target: DataFrame | None, incoming: DataFrame, key_cols: list[str],
                     order_cols: list[str | Column] | None = None,
                     partition_cols: list[str] | None = None,
                     keys_unique: bool = False) -> DataFrame:
    """J2 (INSERT OR IGNORE): the incoming rows to append. The first row per key wins within
    the batch; rows whose key already exists in ``target`` are dropped. Appending the result
    twice is harmless only through this operator: a replayed batch finds its keys present.
    ``keys_unique=True`` skips the in-batch de-duplication (keys unique by construction)."""
    order_cols = order_cols or key_cols
    batch = incoming if keys_unique else first_per_key(incoming, key_cols, order_cols)
    if target is None:
        return batch
    keys = list(dict.fromkeys((partition_cols or []) + key_cols))
    existing = target.select(*keys)
    if partition_cols:           # an anti-join prunes nothing: first cut the target to the
        touched = batch.select(*partition_cols).distinct()           # partitions of the batch
        existing = existing.join(touched, partition_cols, "left_semi")
    return batch.join(existing, keys, "left_anti")


def insert_or_replace(target: DataFrame | None, incoming: DataFrame, key_cols: list[str],
                      order_cols: list[str | Column] | None = None,
                      partition_cols: list[str] | None = None) -> DataFrame:
    """J3 (INSERT OR REPLACE): the new state of the target partitions touched by the batch.
    The last incoming row per key wins and replaces the stored row. Without
    ``partition_cols`` the whole target is returned (small control tables)."""
    order_cols = order_cols or key_cols
    desc = [c.desc() if isinstance(c, Column) else F.col(c).desc() for c in order_cols]
    latest = first_per_key(incoming, key_cols, desc)
    if target is None:
        return latest
    scope = target
    if partition_cols:
        touched = latest.select(*partition_cols).distinct()
        scope = target.join(touched, partition_cols, "left_semi")
    kept = scope.join(latest.select(*key_cols), key_cols, "left_anti")
    return kept.unionByName(latest.select(*target.columns))


def _file_system(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists in its file system."""
    fs, where = _file_system(spark, path)
    return fs.exists(where)


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, where = _file_system(spark, path)
    fs.delete(where, True)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What queries of the block shuffled is deleted when each of them ends. Else it stays until
    the driver collects garbage, and steps of a load add up on the disks of the executors."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    old = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if old is None else spark.conf.set(name, old)


def _write(rows: DataFrame, path: str, partition_cols: list[str] | None) -> None:
    if partition_cols:          # few files a partition; a large one is split over tasks
        rows = rows.hint("rebalance", *partition_cols)
    w = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    (w.partitionBy(*partition_cols) if partition_cols else w).parquet(path)


def replace_partitions(spark: SparkSession, state: DataFrame, target_path: str,
                       partition_cols: list[str] | None = None) -> None:
    """Write ``state`` over ``target_path``: stage it first (the state may have been read
    from the target), then overwrite the target — only the partitions present when
    ``partition_cols`` are given (dynamic partition overwrite)."""
    staging = scratch_path(spark, f"staging-{uuid.uuid4().hex}")
    _write(state, staging, partition_cols)
    _write(spark.read.schema(state.schema).parquet(staging), target_path, partition_cols)
    delete_folder(spark, staging)


def overwrite_partitions(spark: SparkSession, state: DataFrame, target_path: str, column: str,
                         values: list) -> None:
    """``replace_partitions`` for the partitions ``values`` of one column, where ``state`` is
    their whole new content: those it has no row for are removed."""
    if not table_exists(spark, target_path):             # nothing there that state could read
        _write(state, target_path, [column])
        return
    staging = scratch_path(spark, f"staging-{uuid.uuid4().hex}")
    _write(state, staging, [column])
    rows = spark.read.schema(state.schema).parquet(staging)
    present = {r[0] for r in rows.select(column).distinct().collect()}
    _write(rows, target_path, [column])
    for value in set(values) - present:
        delete_folder(spark, f"{target_path}/{column}={value}")
    delete_folder(spark, staging)


def append_rows(rows: DataFrame, target_path: str, partition_cols: list[str] | None = None) -> None:
    w = rows.write.mode("append")
    (w.partitionBy(*partition_cols) if partition_cols else w).parquet(target_path)


def append_observed(rows: DataFrame, target_path: str, partition_cols: list[str] | None = None,
                    date_col: str = "transaction_date") -> dict:
    """Append rows and return what the write job saw of them (records, first and last date): the
    metrics are observed on the way to the files, so nothing is counted again."""
    seen = Observation(f"load-{uuid.uuid4().hex}")
    append_rows(rows.observe(seen, F.count(F.lit(1)).alias("records"),
                             F.min(date_col).alias("first_date"),
                             F.max(date_col).alias("last_date")), target_path, partition_cols)
    return seen.get


def _line_texts() -> list[Column]:
    """What makes two statement lines equal: the source key columns and the id."""
    return [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in [*STATEMENT_KEY, "id"]]


def _line_group() -> Column:
    """Digest (32 bytes) of what makes two statement lines equal."""
    return F.unhex(F.sha2(F.to_json(F.array(*_line_texts())), 256))


def _of_id() -> Column:
    return F.substring(F.sha1(F.coalesce(F.col("id").cast("string"), F.lit(""))), 1, 16)


def _key_text(last: Column) -> Column:
    return F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit(""))
                              for c in [*_cols(STATEMENT_KEY), last]])


def _numbered_by_page(b: DataFrame, group: list[str], earlier: DataFrame | None) -> DataFrame:
    """``b`` with ``__n``: the number of a line among the equal lines of its load window, over all
    its pages. Lines are numbered within their page and the counts of earlier pages are added, so
    a group of equal lines is never larger in one task than a page holds.

    ``earlier``: counts (load_window, line_group, n) of pages that came before this batch."""
    file = ["line_group", "source_file"]                 # a page is a file
    b = b.withColumn("__in_page", F.row_number().over(
        Window.partitionBy(*file).orderBy("page_pos")))
    before = Window.partitionBy(*group).orderBy("page", "source_file").rowsBetween(
        Window.unboundedPreceding, -1)
    # most lines have no equal one on an earlier page: only the others are joined
    counts = _counts(b).select(*file, F.sum("n").over(before).alias("__before")) \
        .where("__before > 0")
    out = b.where(F.col("source_file").isNotNull()).join(counts, file, "left")
    n = F.col("__in_page") + F.coalesce("__before", F.lit(0))
    if earlier is not None:
        known = earlier.withColumn("line_group", F.unhex("line_group"))
        out = out.join(known.select(*group, F.col("n").alias("__earlier")), group, "left")
        n = n + F.coalesce("__earlier", F.lit(0))
    return out.withColumn("__n", n).drop("__in_page", "__before", "__earlier")


def page_counts(batch: DataFrame) -> DataFrame:
    """Counts (line_group, source_file, load_window, page, n) of the equal lines of each page."""
    return _counts(batch.withColumn("line_group", _line_group())).withColumn(
        "line_group", F.lower(F.hex("line_group")))


def _counts(batch: DataFrame) -> DataFrame:
    return batch.groupBy("line_group", "source_file").agg(
        F.first("load_window").alias("load_window"), F.first("page").alias("page"),
        F.count("*").alias("n"))


def dealt_by_month(batch: DataFrame) -> DataFrame:
    """A batch without pages with ``month`` and ``month_part``, dealt by both. Equal lines lie in one
    task and lines of a month in ``MONTH_PARTS`` tasks at most, so numbering them (``statement_keys``
    with ``near`` the two columns) and writing them by month need no other shuffle."""
    if _has_pages(batch):
        raise ValueError("lines of pages are numbered page by page, not where they are")
    part = F.pmod(F.xxhash64(*_line_texts()), F.lit(MONTH_PARTS)).cast("int")
    return batch.withColumn("month", month_key("transaction_date")) \
        .withColumn("month_part", part).repartition("month", "month_part")


def statement_keys(batch: DataFrame, order_cols: list[str | Column] | None = None,
                   window_cols: list[str] | None = None,
                   earlier: DataFrame | None = None, near: list[str] | None = None) -> DataFrame:
    """The statement business key: the source key columns plus the
    number of a line among the equal lines (with the same id, or all without one) of its load
    window; ``line_key`` is its sha1.

    ``window_cols`` tell the load windows of a batch apart (``load_window`` or ``source_file``
    where the batch has one): lines are numbered within their window, so a line that two
    overlapping windows deliver gets the same key twice, and the caller keeps one. Where the batch
    knows page numbers, lines are numbered over all pages of a window; ``earlier`` has the counts
    of pages that came in earlier batches (``page_windows``). The order of the pages only decides
    which of several equal lines gets which number, never how many there are. A batch without pages
    that is dealt by the columns ``near``, which equal lines share, is numbered without a shuffle."""
    return _keyed(batch, order_cols, window_cols, earlier, near).drop("line_group")


def _keyed(batch: DataFrame, order_cols: list[str | Column] | None, window_cols: list[str] | None,
           earlier: DataFrame | None = None, near: list[str] | None = None) -> DataFrame:
    """``statement_keys`` with ``line_group``. Rows of a batch without pages that are dealt by the
    columns ``near``, which equal lines share, are numbered where they are."""
    if window_cols is None:
        window_cols = _window_cols(batch)
    b = batch.withColumn("line_group", _line_group())
    group = ["line_group", *window_cols]
    if _has_pages(batch):
        b = _numbered_by_page(b, group, earlier)
    else:
        b = b.withColumn("__n", F.row_number().over(
            Window.partitionBy(*(near or []), *group).orderBy(*_cols(order_cols or ["id"]))))
    b = b.withColumn("occurrence_no", F.concat(_of_id(), F.lit("-"), F.col("__n").cast("string")))
    return b.withColumn("line_key", F.sha1(_key_text(F.col("occurrence_no")))).drop("__n")


def _window_cols(batch: DataFrame) -> list[str]:
    return [c for c in ("load_window", "source_file") if c in batch.columns][:1]


def _has_pages(batch: DataFrame) -> bool:
    return {"page", "page_pos", "source_file"} <= set(batch.columns)


def update_account_meta(accounts: DataFrame, meta: DataFrame) -> DataFrame:
    """Per (branch, ledger, account_no) the latest period's non-NULL currency and status
    overwrite the stored values (COALESCE(new, old)); unknown accounts are added."""
    key = ["branch", "ledger", "account_no"]
    latest = meta.groupBy(*key).agg(
        F.max("display_number").alias("__disp"),
        F.max_by("currency", F.when(F.col("currency").isNotNull(), F.col("source_period")))
        .alias("__cur"),
        F.max_by("status", F.when(F.col("status").isNotNull(), F.col("source_period")))
        .alias("__st"))
    j = accounts.join(latest, key, "full_outer")
    return j.select(
        *key,
        F.coalesce("display_number", "__disp").alias("display_number"),
        F.coalesce("__cur", "currency").alias("currency"),
        F.coalesce("__st", "status").alias("status"),
        F.coalesce("first_seen_at", F.current_timestamp()).alias("first_seen_at"))


def next_load_window(load_log: DataFrame, statements: DataFrame, today: str,
                     operation: str = "incremental", default_days: int = 30) -> DataFrame:
    """One row (date_from, date_to, skip): start at the last ``date_to`` of this
    operation, else at the latest transaction date, else ``today - 30 d``; skip when the start
    equals today. Both inputs are reduced by global aggregates (one row each)."""
    last_log = load_log.where(F.col("operation_type") == operation).agg(
        F.max_by("date_to", "load_timestamp").alias("last_to"))
    last_tx = statements.agg(F.date_format(F.max("transaction_date"), "yyyy-MM-dd").alias("max_tx"))
    today_c = F.lit(today)
    start = F.coalesce(F.col("last_to"), F.col("max_tx"),
                       F.date_format(F.date_sub(today_c.cast("date"), default_days), "yyyy-MM-dd"))
    # both are single-row global aggregates: stack them and take one row, no join needed
    j = last_log.unionByName(last_tx, allowMissingColumns=True).agg(
        F.max("last_to").alias("last_to"), F.max("max_tx").alias("max_tx"))
    return j.select(start.alias("date_from"), today_c.alias("date_to"),
                    (start == today_c).alias("skip"))


def log_load(spark: SparkSession, load_log: DataFrame | None, operation: str, date_from: str,
             date_to: str, records: DataFrame | int, at: str | None = None) -> DataFrame:
    """Upsert the (operation, from, to) entry — also when 0 rows were loaded.
    ``records`` is a count or the loaded rows (counted by an aggregate, not on the driver)."""
    ts = at or _dt.datetime.now(_dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    if isinstance(records, DataFrame):
        n = records.agg(F.count(F.lit(1)).alias("records_loaded"))
    else:
        n = spark.range(1).select(F.lit(int(records)).cast("bigint").alias("records_loaded"))
    entry = n.select(F.lit(operation).alias("operation_type"), F.lit(date_from).alias("date_from"),
                     F.lit(date_to).alias("date_to"), "records_loaded",
                     F.lit(ts).cast("timestamp").alias("load_timestamp"))
    if load_log is None:
        return entry
    return insert_or_replace(load_log, entry, ["operation_type", "date_from", "date_to"],
                             ["load_timestamp"])


def load_and_log(spark: SparkSession, rows: DataFrame, target_path: str, log_path: str,
                 operation: str, date_from: str, date_to: str,
                 partition_cols: list[str] | None = None, at: str | None = None) -> dict:
    """Append the rows of a load and enter it in the stored log (also when there were none); the
    number of records comes from the write job. Returns the observed metrics."""
    seen = append_observed(rows, target_path, partition_cols)
    log = spark.read.parquet(log_path) if table_exists(spark, log_path) else None
    replace_partitions(spark, log_load(spark, log, operation, date_from, date_to,
                                       int(seen["records"]), at), log_path)
    return seen


def check_iso(*dates: str) -> None:
    for d in dates:
        if not ISO.match(d or ""):
            raise ValueError(f"Invalid date (YYYY-MM-DD expected): {d!r}")
        _dt.date.fromisoformat(d)


def load_range(target: DataFrame | None, batch: DataFrame, date_from: str, date_to: str,
               order_cols: list[str | Column] | None = None) -> DataFrame:
    """Manual backfill of [from, to] (ISO-checked): keyed statement rows of the batch
    inside the range that the target does not have yet."""
    check_iso(date_from, date_to)
    in_range = F.col("transaction_date").between(F.lit(date_from).cast("date"),
                                                 F.lit(date_to).cast("date"))
    b = batch.where(in_range)
    if target is not None:      # the key contains the date: only stored rows of the range matter
        target = target.where(in_range)
        if "line_key" not in target.columns:
            if _alike(target, b, order_cols):
                return _load_beside(target, b, order_cols)
            target = statement_keys(target, order_cols)
    keyed = first_per_key(statement_keys(b, order_cols), ["line_key"], order_cols or ["id"])
    return insert_or_ignore(target, keyed, ["line_key"], keys_unique=True)


def _ordered_by(order_cols: list[str | Column] | None) -> list[str]:
    return [*dict.fromkeys([*STATEMENT_KEY, "id", *(order_cols or [])])]


def _alike(target: DataFrame, batch: DataFrame, order_cols: list[str | Column] | None) -> bool:
    """Whether target and batch can be numbered in one table: no pages, and the same types of the
    columns that numbering uses."""
    if any(isinstance(c, Column) for c in order_cols or []) or _has_pages(batch) \
            or _has_pages(target) or _window_cols(target) != _window_cols(batch):
        return False
    used = _ordered_by(order_cols) + _window_cols(batch)
    types = dict(target.dtypes)
    return all(types.get(c) == t for c, t in batch.dtypes if c in used)


def _load_beside(target: DataFrame, batch: DataFrame, order_cols: list[str | Column] | None
                 ) -> DataFrame:
    """``load_range`` of a batch and a target without keys: both are numbered, each by itself, and
    compared in one table that is shuffled once, by a hash of what equal keys have in common. A
    stored row comes first among those of its key and isn't returned."""
    windows = _window_cols(batch)
    both = batch.withColumn("__stored", F.lit(False)).unionByName(
        target.select(*dict.fromkeys([*_ordered_by(order_cols), *windows]))
        .withColumn("__stored", F.lit(True)), allowMissingColumns=True)
    # equal keys have equal texts up to their number, so none is parted by this hash
    near = both.withColumn("__near", F.xxhash64(_key_text(_of_id()))).repartition("__near")
    keyed = _keyed(near, order_cols, [*windows, "__stored"], near=["__near"])
    new = insert_or_ignore(None, keyed, ["__near", "line_key"],
                           [F.col("__stored").desc(), *(order_cols or ["id"])])
    return new.where(~F.col("__stored")).select("line_key", *batch.columns, "occurrence_no")


def monthly_load_log(statements: DataFrame, operation: str = "incremental",
                     at: str | None = None) -> DataFrame:
    """A load log as produced by one load per calendar month of ``statements``; each load is
    stamped the day after its window closes (or at ``at``)."""
    m = statements.groupBy(F.trunc("transaction_date", "month").alias("m")).agg(
        F.count(F.lit(1)).alias("records_loaded"))
    ts = (F.lit(at).cast("timestamp") if at else
          F.date_add(F.last_day("m"), 1).cast("timestamp"))
    return m.select(F.lit(operation).alias("operation_type"),
                    F.date_format("m", "yyyy-MM-dd").alias("date_from"),
                    F.date_format(F.last_day("m"), "yyyy-MM-dd").alias("date_to"),
                    "records_loaded", ts.alias("load_timestamp"))
