"""Configuration tables (rule tables, account groups, payment types, FX rates).

Their size is the parameter list they are built from, so it is known before any job runs:
``config_table`` checks it against ``max_rows`` and only then marks the table for broadcast,
so joins against it never shuffle the data side. Tables built from a Python list otherwise
carry no size estimate and would be joined by shuffling both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_CONFIG_ROWS = 100_000


def config_table(spark: SparkSession, rows: list, schema: str,
                 max_rows: int = MAX_CONFIG_ROWS) -> DataFrame:
    """A broadcast-marked DataFrame of ``rows``; longer lists than ``max_rows`` are joined without the hint."""
    rows = list(rows)
    table = spark.createDataFrame(rows, schema)
    return F.broadcast(table) if len(rows) <= max_rows else table
