"""Keys, hashes, flags and calendar keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _text(x) -> Column:
    """Value as the source would print it into a key: missing -> ''."""
    return F.coalesce(_c(x).cast("string"), F.lit(""))


def js_number_text(x) -> Column:
    """A decimal as JavaScript prints a number: no trailing zeros, no trailing dot
    (``1234.50`` -> ``1234.5``, ``100.00`` -> ``100``)."""
    t = _c(x).cast("string")
    return F.when(t.contains("."), F.regexp_replace(F.regexp_replace(t, "0+$", ""), "\\.$", "")
                  ).otherwise(t)


def bank_tx_id(branch, ledger, account_no, booking_date, amount, batch, reference,
               text_key) -> Column:
    """sha1 over ``branch|ledger|acct|booking_date|amount|batch|reference|text_key``.

    NULL parts become '' (``concat_ws`` would silently drop them and shift the fields).
    """
    parts = [branch, ledger, account_no, booking_date, js_number_text(amount), batch, reference,
             text_key]
    pieces = []
    for i, p in enumerate(parts):
        if i:
            pieces.append(F.lit("|"))
        pieces.append(_text(p))
    return F.sha1(F.concat(*pieces))


def raw_hash(*cols) -> Column:
    """sha1 of the row's source block, rendered as JSON."""
    return F.sha1(F.to_json(F.struct(*[_c(c) for c in cols])))


def first_nonempty(*cols, default=None) -> Column:
    """JavaScript ``a || b || default`` — NULL and '' both fall through."""
    parts = [F.nullif(_c(c).cast("string"), F.lit("")) for c in cols]
    if default is not None:
        parts.append(F.lit(default))
    return F.coalesce(*parts)


def active_flag(x) -> Column:
    """Anything but an explicit false (or 0) is active (1)."""
    c = _c(x)
    s = F.lower(c.cast("string"))
    return F.when(s.isin("false", "0"), F.lit(0)).otherwise(F.lit(1))


def account_display(branch, ledger, account_no) -> Column:
    """``branch-ledger-account``."""
    return F.concat_ws("-", _c(branch), _c(ledger), _c(account_no))


def month_key(d) -> Column:
    """``YYYY-MM``."""
    return F.date_format(_c(d), "yyyy-MM")


def year_key(d) -> Column:
    """``YYYY``."""
    return F.date_format(_c(d), "yyyy")


def quarter_key(d) -> Column:
    """``YYYY-Qn``."""
    return F.concat(F.date_format(_c(d), "yyyy"), F.lit("-Q"), F.quarter(_c(d)).cast("string"))


def text_prefix_key(x, n: int) -> Column:
    """First ``n`` characters, trimmed; empty -> NULL (the caller drops it)."""
    k = F.trim(F.substring(F.coalesce(_c(x), F.lit("")), 1, n))
    return F.when(k != "", k)


def clean_title(x) -> Column:
    """Keep letters, digits and spaces; spaces -> ``_``."""
    kept = F.regexp_replace(_c(x), "[^\\p{L}\\p{N} ]", "")
    return F.regexp_replace(kept, " ", "_")
