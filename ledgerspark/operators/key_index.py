"""A key index for insert-or-ignore loads.

An anti-join against the whole target reads and shuffles every stored row to load a small batch.
The index is a table of its own with nothing but the keys: partitioned by month and load, and
bucketed by the key. A batch looks up the months it touches only (partition filter), and meets
them bucket to bucket: the batch is shuffled, the index is not, and the target isn't read at all.

A load has an id, and both tables hold its rows in partitions of their own (month, load_id), which
are overwritten as a whole. A load that failed on the way is repeated with its id: it doesn't see its
own index entries, finds the same new rows and writes them over what it left. Rows go to
the target first, so no key is ever known without its row, and the index entries are made from
what the load wrote there; ``rebuild`` makes the whole index from the target. ``compact`` joins the
loads of closed months.

On disk a load needs little beside what it adds to the tables: there is no copy of its rows, what one
step shuffled is deleted before the next, only rows of months that other loads have entered are
shuffled for the lookup, and files are zstandard (keys are hexadecimal digests, which it halves).

The key has to determine the month (statement keys contain the date), as only touched months
are looked up.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .loading import delete_folder, shuffles_dropped, staged

BUCKETS = 256
ROWS_PER_BUCKET = 2_000_000        # of the target, when its size is known beforehand
MOST_BUCKETS = 10_000
BASE = "base"                      # the load that compacted rows belong to


def create(spark: SparkSession, table: str, key: str, path: str | None = None,
           buckets: int = BUCKETS) -> None:
    """An empty index as a catalog table (below ``path`` if given, else in the warehouse)."""
    where = f"LOCATION '{path}'" if path else ""
    spark.sql(f"""
        CREATE TABLE {table} ({key} STRING, month STRING, load_id STRING) USING parquet
        OPTIONS (partitionOverwriteMode 'dynamic', compression 'zstd')
        PARTITIONED BY (month, load_id)
        CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS {where}""")


def buckets_for(rows: int, least: int = 4) -> int:
    """Buckets of an index for a target of so many rows: a bucket is one task of the lookup and of
    the write, so their number follows the rows."""
    return min(max(least, -(-rows // ROWS_PER_BUCKET)), MOST_BUCKETS)


def _buckets(spark: SparkSession, table: str) -> tuple[str, int]:
    """Key column and number of buckets."""
    described = {r.col_name: r.data_type
                 for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    return described["Bucket Columns"].strip("[]`"), int(described["Num Buckets"])


def touched_months(batch: DataFrame) -> list[str]:
    """The months of a batch: bounded by the calendar."""
    return sorted(r[0] for r in batch.select("month").distinct().collect())


def _by_lookup(batch: DataFrame, table: str, load_id: str | None
               ) -> tuple[DataFrame | None, DataFrame | None]:
    """The rows of months that no other load has entered, all of them new, and the new ones of the
    rest. None where there are no such months."""
    spark = batch.sparkSession
    key, _ = _buckets(spark, table)
    known = spark.table(table)
    if load_id is not None:
        known = known.where(F.col("load_id") != load_id)
    if known.isEmpty():
        return batch, None
    touched = touched_months(batch)
    known = known.where(F.col("month").isin(touched))
    months = touched_months(known)
    if not months:
        return batch, None
    if months == touched:
        return None, batch.join(known.select(key), key, "left_anti")
    entered = F.coalesce(F.col("month").isin(months), F.lit(False))
    return batch.where(~entered), batch.where(entered).join(known.select(key), key, "left_anti")


def unseen(batch: DataFrame, table: str, load_id: str | None = None) -> DataFrame:
    """The rows of a batch (with ``month``, keys unique) whose key no other load has."""
    fresh, looked_up = _by_lookup(batch, table, load_id)
    if fresh is None or looked_up is None:
        return looked_up if fresh is None else fresh
    return fresh.unionByName(looked_up.select(*fresh.columns))


def record(rows: DataFrame, table: str, load_id: str) -> None:
    """Enter the keys of loaded rows; a repeated load writes its partitions again."""
    spark = rows.sparkSession
    key, buckets = _buckets(spark, table)
    # dealt like the buckets: one file a bucket and month
    rows.select(key, "month", F.lit(load_id).alias("load_id")).repartition(buckets, key) \
        .write.mode("overwrite").insertInto(table)


def _folders(spark: SparkSession, path: str, months: list[str | None], load_id: str) -> list[str]:
    """Folders of a load's partitions as Spark names them."""
    names = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    part = lambda k, v: names.getPartitionPathString(k, v)
    return [f"{path}/{part('month', m)}/{part('load_id', load_id)}" for m in months]


def _append(rows: DataFrame, path: str, load_id: str) -> DataFrame:
    """Write the rows of a load to the target. Returns them as the target has them now."""
    spark, seen = rows.sparkSession, Observation(f"load-{uuid.uuid4().hex}")
    rows.withColumn("load_id", F.lit(load_id)).observe(
        seen, F.collect_set("month").alias("months"),             # bounded by the calendar
        F.count_if(F.col("month").isNull()).alias("without")) \
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .option("compression", "zstd").partitionBy("month", "load_id").parquet(path)
    months = [*(seen.get.get("months") or []), *([None] if seen.get.get("without") else [])]
    if not months:
        return spark.createDataFrame([], rows.schema)
    return spark.read.schema(rows.schema).option("basePath", path).parquet(
        *_folders(spark, path, months, load_id)).select(*rows.columns)


def load_new_rows(batch: DataFrame, target_path: str, table: str, load_id: str,
                  dealt: bool = False) -> DataFrame:
    """J2/J7 with the index: append the rows of a batch whose key is new to the target (layout
    month, load_id) and to the index. Returns the appended rows, read from the target.

    ``dealt``: rows of a month lie in few tasks (``loading.dealt_by_month``), so those that need no
    lookup are written from there."""
    with shuffles_dropped(batch.sparkSession):
        fresh, looked_up = _by_lookup(batch, table, load_id)
        parts = [x if dealt and x is fresh else x.hint("rebalance", "month")
                 for x in (fresh, looked_up) if x is not None]
        rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        new = _append(rows, target_path, load_id)
        record(new, table, load_id)
    return new


def _drop(spark: SparkSession, table: str, parts: list[tuple[str, str]]) -> None:
    """Drop partitions (month, load_id) with their files, which an external table would keep."""
    root = next(r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
                if r.col_name == "Location")
    for month, load_id in parts:
        spark.sql(f"ALTER TABLE {table} DROP PARTITION (month = '{month}', load_id = '{load_id}')")
        delete_folder(spark, f"{root}/month={month}/load_id={load_id}")


def rebuild(spark: SparkSession, target_path: str, table: str) -> None:
    """The index from the target, for instance after it was lost."""
    key, buckets = _buckets(spark, table)
    old = [tuple(r) for r in spark.table(table).select("month", "load_id").distinct().collect()]
    _drop(spark, table, old)
    spark.read.parquet(target_path).select(key, "month", "load_id").repartition(buckets, key) \
        .write.mode("overwrite").insertInto(table)


def compact(spark: SparkSession, table: str, months: list[str]) -> None:
    """One partition of many loads for each of these months; only when none of their loads can be
    repeated any more."""
    key, buckets = _buckets(spark, table)
    rows = spark.table(table).where(F.col("month").isin(months))
    loads = [tuple(r) for r in rows.select("month", "load_id").distinct().collect()]
    keys = staged(rows.select(key, "month"), "index-compaction")
    keys.select(key, "month", F.lit(BASE).alias("load_id")).repartition(buckets, key) \
        .write.mode("overwrite").insertInto(table)
    _drop(spark, table, [x for x in loads if x[1] != BASE])
