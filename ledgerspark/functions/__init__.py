"""Scalar column helpers. All are built-in Spark expressions (JVM-side, codegen'd)."""

from .accounting import (account_class, balance_a, balance_b, expenses_a, expenses_b,  # noqa: F401
                         revenue_a, revenue_b, types_of)
from .currency import (currency_from_name, currency_from_type,  # noqa: F401
                       currency_hint_from_text, fx_rates, fx_to_isk)
from .dates import excel_serial_date, iso_date, paid_date_norm, parse_sheet_date  # noqa: F401
from .invoice import payment_status, status_display  # noqa: F401
from .keys import (account_display, active_flag, bank_tx_id, clean_title,  # noqa: F401
                   first_nonempty, month_key, quarter_key, raw_hash, text_prefix_key, year_key)
from .money import (credit_of, debit_of, js_parse_float, js_round, money_avg,  # noqa: F401
                    money_sum, parse_amount_en, parse_amount_is, parse_amount_keep,
                    parse_amount_or_zero, parse_amount_xml, percent_change, to_millions,
                    to_money)
from .text import account_name_from_text, account_number_from_text, digits_and_dashes  # noqa: F401
