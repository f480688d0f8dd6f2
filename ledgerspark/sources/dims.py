"""Generated dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values: the currency dimension seed ----------------------------------------------
CURRENCIES = [
    ("USD", "US Dollar", "$", 2),
    ("EUR", "Euro", "€", 2),
    ("GBP", "British Pound", "£", 2),
    ("ISK", "Icelandic Króna", "kr", 0),
]
# -----------------------------------------------------------------------------------------------


def _calendar(days: DataFrame) -> DataFrame:
    d = F.col("d")
    return days.select(
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_key"),
        F.date_format(d, "yyyy-MM-dd").alias("date"),
        F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"), F.weekofyear(d).alias("week"),
        F.dayofmonth(d).alias("day_of_month"), F.dayofweek(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.when(F.dayofweek(d).isin(1, 7), F.lit(1)).otherwise(F.lit(0)).alias("is_weekend"),
        F.lit(None).cast("int").alias("is_holiday"))


def dim_date(spark: SparkSession, date_from: str, date_to: str) -> DataFrame:
    """One row per day in [from, to] with 12 calendar columns. No holiday calendar is
    given, so ``is_holiday`` is NULL. Weeks are ISO weeks; day_of_week 1 = Sunday."""
    return _calendar(spark.range(1).select(F.explode(F.sequence(
        F.lit(date_from).cast("date"), F.lit(date_to).cast("date"))).alias("d")))


def dim_date_for(df: DataFrame, date_col: str) -> DataFrame:
    """A14 sized by data: the calendar spanning ``date_col`` of ``df`` (one tiny aggregate
    decides the range; the calendar is generated, ~365 rows per year)."""
    bounds = df.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi"))
    return _calendar(bounds.select(F.explode(F.sequence("lo", "hi")).alias("d")))


def dim_currency(spark: SparkSession) -> DataFrame:
    """The four-row currency seed."""
    return spark.createDataFrame(
        CURRENCIES, "currency_code string, currency_name string, symbol string, decimal_places int")
