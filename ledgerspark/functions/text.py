"""Text extraction helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed value: account number layout branch(4)-ledger(2)-account(6)
ACCOUNT_NUMBER_PATTERN = "(\\d{4}-\\d{2}-\\d{6})"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def account_number_from_text(x) -> Column:
    """The first ``bbbb-ll-nnnnnn`` in the text, else ''."""
    return F.regexp_extract(F.coalesce(_c(x), F.lit("")), ACCOUNT_NUMBER_PATTERN, 1)


def account_name_from_text(x) -> Column:
    """The text after the account number, trimmed, else ''."""
    return F.trim(F.regexp_extract(F.coalesce(_c(x), F.lit("")),
                                   "\\d{4}-\\d{2}-\\d{6}\\s+(.+)", 1))


def digits_and_dashes(x) -> Column:
    """Keep digits and dashes (account number discovery, A10)."""
    return F.regexp_replace(F.coalesce(_c(x).cast("string"), F.lit("")), "[^0-9-]", "")
