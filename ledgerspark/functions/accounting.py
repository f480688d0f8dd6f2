"""Account classes and the sign conventions of the reporting views.

Convention A (``gold_monthly_pl``, ``gold_balance_sheet``): revenue = credit - debit,
expenses = debit - credit, asset = debit - credit, liability/equity = credit - debit, else 0.

Convention B (``gold_*_by_year``, ``gold_monthly_pl_trend``, the default): revenue =
debit - credit, expenses = credit - debit, asset = debit - credit, anything else =
credit - debit.

Convention C (report generator): per-account ``|sum(amount)|``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: account type names as they appear in the chart of accounts ---------
TYPE_REVENUE = "Tekjur"
TYPE_EXPENSE = "Gjöld"
TYPE_ASSET = "Eignir"
TYPE_LIABILITY = "Skuldir"
TYPE_EQUITY = "Eigið fé"
# English names used by the report generator
ENGLISH_TYPES = {
    "revenue": ("Income", "Revenue"),
    "expense": ("Expense", "Cost"),
    "asset": ("Asset",),
    "liability": ("Liability",),
    "equity": ("Equity",),
}
# ---------------------------------------------------------------------------------------

ICELANDIC_TYPES = {
    "revenue": TYPE_REVENUE,
    "expense": TYPE_EXPENSE,
    "asset": TYPE_ASSET,
    "liability": TYPE_LIABILITY,
    "equity": TYPE_EQUITY,
}

PL_CLASSES = ("revenue", "expense")
BS_CLASSES = ("asset", "liability", "equity")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def account_class(account_type) -> Column:
    """Normalise an Icelandic or English account type to revenue/expense/asset/
    liability/equity, anything else (incl. NULL and '') to 'other'."""
    t = _c(account_type)
    expr = None
    for cls in ("revenue", "expense", "asset", "liability", "equity"):
        names = (ICELANDIC_TYPES[cls],) + ENGLISH_TYPES[cls]
        cond = t.isin(*names)
        expr = F.when(cond, F.lit(cls)) if expr is None else expr.when(cond, F.lit(cls))
    return expr.otherwise(F.lit("other"))


def types_of(*classes: str) -> list[str]:
    """All type names (both languages) that normalise to any of ``classes``."""
    out: list[str] = []
    for cls in classes:
        out.append(ICELANDIC_TYPES[cls])
        out.extend(ENGLISH_TYPES[cls])
    return out


def balance_b(cls, debit, credit) -> Column:
    """Convention B signed balance from (already aggregated) debit and credit."""
    cls, d, c = _c(cls), _c(debit), _c(credit)
    return (F.when(cls == "revenue", d - c)
            .when(cls == "expense", c - d)
            .when(cls == "asset", d - c)
            .otherwise(c - d))


def balance_a(cls, debit, credit) -> Column:
    """Convention A balance-sheet balance: asset debit-normal, liability/equity
    credit-normal, anything else 0."""
    cls, d, c = _c(cls), _c(debit), _c(credit)
    return (F.when(cls == "asset", d - c)
            .when(cls.isin("liability", "equity"), c - d)
            .otherwise(F.lit(0)))


def revenue_a(cls, debit, credit) -> Column:
    cls, d, c = _c(cls), _c(debit), _c(credit)
    return F.when(cls == "revenue", c - d).otherwise(F.lit(0))


def expenses_a(cls, debit, credit) -> Column:
    cls, d, c = _c(cls), _c(debit), _c(credit)
    return F.when(cls == "expense", d - c).otherwise(F.lit(0))


def revenue_b(cls, debit, credit) -> Column:
    cls, d, c = _c(cls), _c(debit), _c(credit)
    return F.when(cls == "revenue", d - c).otherwise(F.lit(0))


def expenses_b(cls, debit, credit) -> Column:
    cls, d, c = _c(cls), _c(debit), _c(credit)
    return F.when(cls == "expense", c - d).otherwise(F.lit(0))
