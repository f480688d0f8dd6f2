"""Bank and card gold views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import month_key


def gold_bank_monthly(bank: DataFrame) -> DataFrame:
    """Branch, ledger, account, booking month -> inflow, outflow, net, count."""
    a = F.col("amount")
    return bank.groupBy("branch", "ledger", "account_no",
                        month_key("booking_date").alias("month")).agg(
        F.sum(F.when(a > 0, a).otherwise(F.lit(0))).alias("inflow"),
        F.sum(F.when(a < 0, -a).otherwise(F.lit(0))).alias("outflow"),
        F.sum(a).alias("net"),
        F.count(F.lit(1)).alias("tx_count"),
    )


def gold_card_monthly(cards: DataFrame) -> DataFrame:
    """Card, month -> deposits, withdrawals, net, count. Withdrawals are stored negative
    (see the card source), so unlike the source's view this one is not always 0."""
    a = F.col("amount")
    return cards.groupBy("card_id", month_key("date").alias("month")).agg(
        F.sum(F.when(a > 0, a).otherwise(F.lit(0))).alias("deposits"),
        F.sum(F.when(a < 0, -a).otherwise(F.lit(0))).alias("withdrawals"),
        F.sum(a).alias("net"),
        F.count(F.lit(1)).alias("tx_count"),
    )
