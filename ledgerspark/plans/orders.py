"""The documented order of the reporting views.

Views are DataFrames without an order, as sorting is the reader's business and costs a shuffle;
``in_documented_order`` adds the order that the documentation of a view states, with the
remaining key columns behind it so that ties have one order too. Before a ``limit`` Spark keeps only
the first rows of each task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values: view -> (columns of its order, then the tie-breakers); "-" is descending -----
ORDERS = {
    "gold_account_summary_by_year": (["year", "account_code"], ["account_name", "account_type",
                                                                "account_subtype"]),
    "gold_income_statement_by_year": (["year", "account_code"], ["account_name", "account_type",
                                                                 "account_subtype"]),
    "gold_balance_sheet_by_year": (["year", "account_code"], ["account_name", "account_type",
                                                              "account_subtype"]),
    "gold_income_summary_by_year": (["year"], []),
    "gold_balance_summary_by_year": (["year"], []),
    "gold_chart_of_accounts": (["account_code"], ["account_name"]),
    "gold_monthly_pl_trend": (["month", "account_type"], ["account_subtype"]),
    "gold_invoice_monthly": (["-month"], ["currency"]),
    "gold_customer_invoices": (["-total_amount"], ["customer_id", "currency"]),
    "invoice_status_stats": (["-count"], ["status"]),
}
# ---------------------------------------------------------------------------------------------------


def in_documented_order(view: str, df: DataFrame) -> DataFrame:
    """The rows of a view in its documented order; columns it does not have break no ties."""
    if view not in ORDERS:
        raise ValueError(f"no order is documented for {view}")
    by, ties = ORDERS[view]
    names = by + [c for c in ties if c in df.columns]
    return df.orderBy(*[F.col(c[1:]).desc() if c[0] == "-" else F.col(c).asc() for c in names])
