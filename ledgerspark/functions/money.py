"""Amount parsing and money arithmetic.

Every parser is ANSI-safe: malformed text becomes NULL (or 0 where the source treats a
missing value as zero) through ``try_cast`` instead of raising.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import MONEY


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def to_money(x) -> Column:
    """Cast any numeric/string column to DECIMAL(18,2); unparsable -> NULL."""
    return _c(x).try_cast(MONEY)


def parse_amount_xml(x) -> Column:
    """B1: statement XML amount; the first ``,`` becomes ``.``; missing/bad -> NULL."""
    c = _c(x)
    fixed = F.regexp_replace(F.trim(c), "^([^,]*),", "$1.")
    return F.when(c.isNull() | (F.trim(c) == ""), F.lit(None).cast(MONEY)).otherwise(
        fixed.try_cast(MONEY))


# JavaScript ``parseFloat``: the longest numeric prefix after leading blanks, else NaN.
_JS_FLOAT_PREFIX = "^\\s*([+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?)"


def js_parse_float(x, kind=MONEY) -> Column:
    """``parseFloat(x)`` as DECIMAL(18,2), or as ``kind``; NaN -> NULL."""
    s = _c(x).cast("string")
    prefix = F.regexp_extract(s, _JS_FLOAT_PREFIX, 1)
    return F.when(prefix != "", F.coalesce(prefix.try_cast(kind),
                                           prefix.try_cast("double").try_cast(kind)))


def parse_quantity(x) -> Column:
    """Quantities, unit prices and percentages: as B2, with ten decimal places."""
    kind = "decimal(28,10)"
    return F.coalesce(js_parse_float(x, kind), F.lit(0).cast(kind))


def _first_comma_to_dot(s: Column) -> Column:
    # JS ``str.replace(',', '.')`` replaces the first occurrence only
    return F.regexp_replace(s, "^([^,]*),", "$1.")


def parse_amount_or_zero(x) -> Column:
    """B2: ``parseFloat(x || 0)`` — missing, empty or unparsable -> 0."""
    return F.coalesce(js_parse_float(x), F.lit(0).cast(MONEY))


def parse_amount_keep(x) -> Column:
    """Keep only digits, comma and minus, first comma -> dot; invalid -> 0.

    As in the source, a ``1234.5`` cell loses its dot and becomes ``12345``.
    """
    kept = F.regexp_replace(_c(x).cast("string"), "[^0-9,\\-]", "")
    return F.coalesce(js_parse_float(_first_comma_to_dot(kept)), F.lit(0).cast(MONEY))


def parse_amount_is(x) -> Column:
    """Icelandic number format ``1.234,50`` (drop dots, comma -> dot); invalid -> 0."""
    s = _first_comma_to_dot(F.regexp_replace(_c(x).cast("string"), "\\.", ""))
    return F.coalesce(js_parse_float(s), F.lit(0).cast(MONEY))


def parse_amount_en(x) -> Column:
    """Keep digits, dot and minus; unparsable -> NULL (the caller skips such rows)."""
    s = F.regexp_replace(_c(x).cast("string"), "[^0-9.\\-]", "")
    return js_parse_float(s)


def debit_of(amount) -> Column:
    """B6 (debit side): amount < 0 -> |amount|, else 0."""
    a = _c(amount)
    return F.when(a < 0, -a).otherwise(F.lit(0).cast(MONEY)).cast(MONEY)


def credit_of(amount) -> Column:
    """B6 (credit side): amount > 0 -> amount, else 0."""
    a = _c(amount)
    return F.when(a > 0, a).otherwise(F.lit(0).cast(MONEY)).cast(MONEY)


def to_millions(x) -> Column:
    """Value in millions."""
    return _c(x).cast("double") / F.lit(1000000.0)


def percent_change(a, b) -> Column:
    """(b - a) / a * 100, and 0 when a is 0."""
    a, b = _c(a).cast("double"), _c(b).cast("double")
    return F.when(a != 0, (b - a) / a * 100.0).otherwise(F.lit(0.0))


def js_round(x, digits: int = 0) -> Column:
    """JavaScript ``Math.round`` (half towards +infinity), unlike SQL ``round`` (half away)."""
    scale = 10 ** digits
    return F.floor(_c(x).cast("double") * scale + 0.5) / scale


def money_sum(x) -> Column:
    """Exact sum of a money column, returned as DOUBLE for presentation."""
    return F.sum(_c(x).cast(MONEY)).cast("double")


CENTS = "decimal(38,0)"


def whole_div(x: Column, y: Column) -> Column:
    """Quotient of whole numbers, cut toward zero."""
    return F.call_function("div", x.cast(CENTS), y.cast(CENTS))


def money_avg(x) -> Column:
    """Average of a money column rounded half-up to cents, computed exactly.

    ``sum`` in cents and ``count`` are whole numbers (DECIMAL(38), so no sum overflows), and
    ``(2|s| + n) div 2n`` is the exact half-up rounding of ``s / n``; ``div`` divides whole
    numbers, unlike ``/``, which would go through DOUBLE.
    """
    c = _c(x).cast(MONEY)
    cents = (F.sum(c) * 100).cast(CENTS)
    n = F.count(c)
    size = whole_div(F.abs(cents) * 2 + n, F.nullif(n * 2, F.lit(0)))
    rounded = F.when(cents < 0, -size).otherwise(size)
    return F.when(n > 0, rounded / F.lit(100.0))
