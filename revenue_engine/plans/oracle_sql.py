"""DuckDB SQL idioms that mirror the Spark column functions exactly."""

from __future__ import annotations

from revenue_engine.functions.parsing import AMOUNT_PATTERN, DATE_LAYOUTS

_STRPTIME = {"yyyy-MM-dd": "%Y-%m-%d", "dd/MM/yyyy": "%d/%m/%Y", "MM/dd/yyyy": "%m/%d/%Y",
             "yyyy/MM/dd": "%Y/%m/%d", "dd-MM-yyyy": "%d-%m-%Y"}


def sql_parse_date(expr: str) -> str:
    parts = [f"case when regexp_full_match({expr}, '{rx.strip('^$')}') "
             f"then try_strptime({expr}, '{_STRPTIME[fmt]}') end" for fmt, rx in DATE_LAYOUTS]
    return f"cast(coalesce({', '.join(parts)}) as date)"


def sql_parse_amount(expr: str) -> str:
    v = f"case when regexp_full_match({expr}, '{AMOUNT_PATTERN.strip('^$')}') then try_cast({expr} as double) end"
    return f"case when isfinite({v}) then {v} end"


def sql_reason(date_expr: str, value_expr: str, currency_expr: str, rate_expr: str | None = None) -> str:
    s = (f"case when {date_expr} is null then 'invalid_date' "
         f"when {value_expr} is null then 'invalid_revenue' "
         f"when coalesce({currency_expr}, '') = '' then 'empty_currency' ")
    if rate_expr is not None:
        s += f"when {rate_expr} is null then 'no_rate' "
    return s + "end"


# Parsed and classified fixture rows; the base for most oracle queries.
PARSED_CTE = f"""
parsed as (
  select r.*, {sql_parse_date('date_s')} as revenue_date,
         {sql_parse_amount('revenue_s')} as original_value,
         coalesce(currency_s, '') as currency
  from fx_raw_revenue r
),
classified as (
  select p.*, x.rate_to_usd,
         {sql_reason('p.revenue_date', 'p.original_value', 'p.currency', 'x.rate_to_usd')} as reason
  from parsed p left join fx_rates x
    on x.currency = p.currency and x.rate_date = p.revenue_date
   and p.revenue_date is not null and p.original_value is not null and p.currency <> ''
)"""
