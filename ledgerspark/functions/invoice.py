"""Invoice display helpers."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: invoice status codes and their display text -----------------------------
STATUS_DISPLAY = {
    "PAID": "Paid",
    "SENT": "Unpaid",
    "DRAFT": "Draft",
    "CANCELLED": "Cancelled",
    "CREDIT": "Credit Note",
}
# -----------------------------------------------------------------------------------------------


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def status_display(status) -> Column:
    """5-way mapping; unknown statuses are shown as they are."""
    s = _c(status)
    expr = None
    for code, text in STATUS_DISPLAY.items():
        expr = (F.when(s == code, F.lit(text)) if expr is None
                else expr.when(s == code, F.lit(text)))
    return expr.otherwise(s)


def payment_status(status, due_date, as_of: str | _dt.date) -> Column:
    """SENT and due before ``as_of`` -> Overdue; SENT and due on/after -> Due; else NULL.

    ``as_of`` replaces the wall-clock ``date('now')``; a blank due date never compares.
    """
    s = _c(status)
    d = _c(due_date)
    due = F.try_to_date(d.cast("string"), "yyyy-MM-dd")
    ref = F.lit(str(as_of)).cast("date")
    return (F.when((s == "SENT") & (due < ref), F.lit("Overdue"))
            .when((s == "SENT") & (due >= ref), F.lit("Due")))
