"""Currency detection and conversion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values: default conversion rates to ISK used by the company roll-ups ----------
DEFAULT_FX_TO_ISK = {"EUR": 150.0, "GBP": 175.0}
# every other currency (ISK, USD, ...) converts at 1
# -------------------------------------------------------------------------------------------


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def currency_from_name(name) -> Column:
    """GBP / EUR mentioned in the file name, else ISK."""
    n = _c(name)
    return (F.when(n.contains("GBP"), F.lit("GBP"))
            .when(n.contains("EUR"), F.lit("EUR"))
            .otherwise(F.lit("ISK")))


def currency_from_type(account_type, file_name) -> Column:
    """A foreign-currency account (type mentions 'erlend' or 'foreign'): copy ``(2)`` is
    GBP, copy ``(3)`` is EUR; otherwise ISK."""
    t = F.lower(F.coalesce(_c(account_type), F.lit("")))
    f = F.coalesce(_c(file_name), F.lit(""))
    foreign = t.contains("erlend") | t.contains("foreign")
    return (F.when(foreign & f.contains("(2)"), F.lit("GBP"))
            .when(foreign & f.contains("(3)"), F.lit("EUR"))
            .otherwise(F.lit("ISK")))


def currency_hint_from_text(row_text) -> Column:
    """B18 (per row): GBP/£, then EUR/€, then ISK/kr. anywhere in the row text; else NULL.

    The per-file decision is the hint of the *last* row that has one — aggregate with
    ``max_by(hint, row_no)`` over rows where the hint is not NULL.
    """
    t = _c(row_text)
    return (F.when(t.contains("GBP") | t.contains("£"), F.lit("GBP"))
            .when(t.contains("EUR") | t.contains("€"), F.lit("EUR"))
            .when(t.contains("ISK") | t.contains("kr."), F.lit("ISK")))


def fx_rates(spark: SparkSession, rates: dict[str, float] | None = None) -> DataFrame:
    """Rate table (currency, rate_to_isk). Its size is the parameter dict: safe to broadcast."""
    from ..config import config_table
    rates = DEFAULT_FX_TO_ISK if rates is None else rates
    return config_table(spark, sorted(rates.items()), "currency string, rate_to_isk double")


def fx_to_isk(df: DataFrame, amount_cols: list[str], rates: DataFrame,
              currency_col: str = "currency", suffix: str = "_isk") -> DataFrame:
    """Add ``<col>_isk`` = col x rate (rate 1 for currencies not in the table). Amounts and
    rates (six decimals) are multiplied as decimals, so sums of the result are exact.

    Rates from ``fx_rates`` are a configuration table whose size was checked against its cap
    and which is marked for broadcast, so the fact side is never shuffled for this lookup.
    """
    r = rates.select(F.col("currency").alias("__fx_cur"), "rate_to_isk")
    out = df.join(r, df[currency_col] == r["__fx_cur"], "left")
    rate = F.coalesce(F.col("rate_to_isk"), F.lit(1.0)).cast("decimal(12,6)")
    for c in amount_cols:
        out = out.withColumn(c + suffix, (F.col(c).cast("decimal(18,2)") * rate).cast("decimal(28,6)"))
    return out.drop("__fx_cur", "rate_to_isk")
