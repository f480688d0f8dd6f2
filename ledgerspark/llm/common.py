"""Helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import gc
import sys
import types
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.operators.loading import delete_folder
from ledgerspark.session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def by_value(module: str) -> None:
    """Ship the functions of ``module`` to executors by value, so that no executor has to have
    this package on its path."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


by_value(__name__)


_CACHES = "_ledgerspark_"


def give_back() -> None:
    """Return memory that a Python worker has freed to the system. Workers stay alive between
    stages, beside the JVM and each other, so what one keeps is missing elsewhere."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)          # where the C library has it
    if trim is not None:
        trim(0)


def release_caches(but: str | None = None) -> None:
    """Drop the caches of a Python worker. Workers outlive stages, so a stage that begins takes
    the memory of the caches that earlier ones left."""
    others = [m for m in sys.modules if m.startswith(_CACHES) and m != f"{_CACHES}{but}"]
    for m in others:
        del sys.modules[m]
    if others:
        gc.collect()
        give_back()


def worker_cache(name: str) -> types.ModuleType:
    """A namespace that lives as long as the Python worker, for caches that outlast one task. A
    worker keeps one of them: those of other names are dropped."""
    release_caches(but=name)
    return sys.modules.setdefault(f"{_CACHES}{name}", types.ModuleType(name))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: lineage ends here, and values
    such as row numbers are the same for every later reader, also after a lost executor. ``rows``,
    a bound of its row count, keeps small tables from being written in hundreds of files."""
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    if rows is not None:
        df = df.coalesce(max(8, rows // 100_000))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def stored_meanwhile(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """As ``stored``, for a large table that only the block reads: its files are deleted after it."""
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        delete_folder(spark, path)


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only; every other character stays."""
    return F.translate(c, UPPER, LOWER)


def total_bytes(df: DataFrame, column: str) -> int:
    """UTF-8 bytes of a text column over all rows (one small aggregate)."""
    return df.agg(F.sum(F.octet_length(column))).first()[0] or 0


def hash_mod(doc_id: str, divisor: int) -> Column:
    """crc32 of the id written as text, modulo ``divisor``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % divisor


#: Elements in a chunk of ``sums_before``.
CHUNK = 128


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, also when ``body`` uses it inside lambdas."""
    return F.transform(F.array(value), body)[0]


def sums_before(numbers: Column) -> Column:
    """For each element of an array of longs the sum of all elements before it, with work in
    proportion to its length."""
    def total(a: Column) -> Column:
        return F.aggregate(a, F.lit(0).cast("long"), lambda s, x: s + x)

    def of(numbers: Column) -> Column:
        last = F.floor((F.size(numbers) - 1) / CHUNK).cast("int")
        # one entry a chunk, so the copies that appending makes are few
        starts = F.aggregate(
            F.sequence(F.lit(0), last), F.array(F.lit(0).cast("long")),
            lambda s, k: F.concat(s, F.array(F.element_at(s, -1)
                                             + total(F.slice(numbers, k * CHUNK + 1, CHUNK)))))
        inside = lambda i: F.pmod(i, F.lit(CHUNK))                                # noqa: E731
        return let(starts, lambda s: F.transform(numbers, lambda _, i: F.get(
            s, F.floor(i / CHUNK).cast("int")) + total(
                F.slice(numbers, i - inside(i) + 1, inside(i)))))

    # bound first: inside lambdas an expression would be computed for every element
    return let(numbers, lambda n: F.when(F.size(n) > 0, of(n))
               .otherwise(F.array().cast("array<bigint>")))
