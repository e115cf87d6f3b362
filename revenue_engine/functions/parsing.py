"""Row-level parsing: multi-layout dates (T1), amounts (T2), verdict."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted date layouts, tried in this order, so day-first
# wins when a value fits both dd/MM/yyyy and MM/dd/yyyy. All fields are
# zero-padded and nothing is trimmed.
DATE_LAYOUTS = (
    ("yyyy-MM-dd", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"),
    ("dd/MM/yyyy", r"^[0-9]{2}/[0-9]{2}/[0-9]{4}\z"),
    ("MM/dd/yyyy", r"^[0-9]{2}/[0-9]{2}/[0-9]{4}\z"),
    ("yyyy/MM/dd", r"^[0-9]{4}/[0-9]{2}/[0-9]{2}\z"),
    ("dd-MM-yyyy", r"^[0-9]{2}-[0-9]{2}-[0-9]{4}\z"),
)

# Decimal float text: optional sign, digits with optional point (or a
# leading point), optional exponent. No blanks, separators, hex or words.
# Deviation, recorded on purpose: NaN / Inf spellings and hex floats are
# rejected, and so is any value that overflows a double.
AMOUNT_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z"

# Reject reasons in the order the checks run.
REASON_DATE = "invalid_date"
REASON_REVENUE = "invalid_revenue"
REASON_CURRENCY = "empty_currency"
REASON_RATE = "no_rate"
REASONS = (REASON_DATE, REASON_REVENUE, REASON_CURRENCY, REASON_RATE)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_date(s) -> Column:
    """First layout that parses strictly; NULL when none does.

    The regex guard makes the width of every field exact; ``try_to_date``
    then rejects impossible calendar dates such as 2026-02-30.
    """
    s = _col(s)
    return F.coalesce(*[
        F.when(s.rlike(rx), F.try_to_date(s, fmt)) for fmt, rx in DATE_LAYOUTS
    ])


def parse_amount(s) -> Column:
    """Strict float parse; NULL for anything that is not finite decimal text."""
    s = _col(s)
    v = F.when(s.rlike(AMOUNT_PATTERN), s.try_cast("double"))
    return F.when(~F.isnan(v) & (F.abs(v) <= F.lit(1.7976931348623157e308)), v)


def reject_reason(revenue_date, original_value, currency, rate=None) -> Column:
    """First failing check in the order date, revenue, currency, rate."""
    chain = (F.when(_col(revenue_date).isNull(), F.lit(REASON_DATE))
             .when(_col(original_value).isNull(), F.lit(REASON_REVENUE))
             .when(F.coalesce(_col(currency), F.lit("")) == "", F.lit(REASON_CURRENCY)))
    if rate is not None:
        chain = chain.when(_col(rate).isNull(), F.lit(REASON_RATE))
    return chain
