"""Date parsing (B13, B14, B23). All ANSI-safe: bad input -> NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed value: spreadsheet serial day of 1970-01-01
EXCEL_EPOCH_SERIAL = 25569


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def parse_sheet_date(x) -> Column:
    """``DD.MM.YYYY`` when the text has a dot, else an ISO date (or timestamp)."""
    s = F.trim(_c(x).cast("string"))
    return F.when(s.contains("."), F.try_to_date(s, "d.M.yyyy")).otherwise(
        F.coalesce(F.try_to_date(s, "yyyy-MM-dd"),
                   F.to_date(F.try_to_timestamp(s))))


def excel_serial_date(x) -> Column:
    """Spreadsheet serial number -> date; non-numeric -> NULL (row skipped)."""
    n = _c(x).cast("string").try_cast("double")
    return F.when(n.isNotNull(),
                  F.date_add(F.lit("1970-01-01").cast("date"),
                             (F.floor(n) - EXCEL_EPOCH_SERIAL).cast("int")))


def iso_date(x) -> Column:
    """ISO ``YYYY-MM-DD`` (or longer ISO timestamp) text -> DATE; blank/bad -> NULL."""
    s = F.trim(_c(x).cast("string"))
    return F.coalesce(F.try_to_date(F.substring(s, 1, 10), "yyyy-MM-dd"))


def paid_date_norm(x, now_iso: str) -> Column:
    """A bare ``YYYY-MM-DD`` becomes noon UTC (``T12:00:00Z``); anything else is kept;
    missing -> ``now_iso`` (an explicit parameter instead of the wall clock)."""
    s = _c(x).cast("string")
    return (F.when(s.isNull() | (F.trim(s) == ""), F.lit(now_iso))
            .when(s.rlike("^\\d{4}-\\d{2}-\\d{2}$"), F.concat(s, F.lit("T12:00:00Z")))
            .otherwise(s))


def in_years(c: str | Column, first: int | str | None = None,
             last: int | str | None = None) -> Column:
    """Dates of the years ``first`` to ``last`` as a comparison with date bounds, which reaches
    the Parquet scan (a filter on ``year(c)`` does not)."""
    c = F.col(c) if isinstance(c, str) else c
    cond = c.isNotNull()
    if first is not None:
        cond = cond & (c >= F.lit(f"{int(first):04d}-01-01").cast("date"))
    if last is not None:
        cond = cond & (c < F.lit(f"{int(last) + 1:04d}-01-01").cast("date"))
    return cond
