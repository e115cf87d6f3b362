"""Deterministic fixture views derived from the driver tables.

The driver tables hold no sources, files, rates or raw CSV rows, so these
views derive them. The SQL text is portable: Spark registers it as temp
views and the DuckDB oracles paste the same text as CTEs, so both sides
start from identical inputs. The clock is fixed at ``AS_OF``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

AS_OF = "2024-06-01 12:00:00"

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
               "lineitem", "events", "documents", "embeddings", "pages",
               "benchmark", "labels", "conversations")

# Fixed values of the fixture: base rates (USD per unit) and API rates
# (units per USD, ZZZ zero and USD wrong on purpose).
FIXTURE_BASE_RATES = (("USD", "1.0"), ("EUR", "1.08"), ("GBP", "1.27"), ("INR", "0.012"), ("JPY", "0.0067"))
FIXTURE_API_RATES = (("USD", "1.5"), ("EUR", "0.9"), ("GBP", "0.8"), ("JPY", "150.0"), ("ZZZ", "0.0"))
_RATE_DAYS = "(select distinct cast(o_orderdate as date) as rate_date from orders)"


def _fx_rates_sql() -> str:
    """Every order day except the 29th × the base currencies (a UNION ALL per
    currency rather than a cross join with a VALUES list; same rows)."""
    branches = "\n  union all ".join(
        f"select '{c}' as currency, cast({b} as double) as base, rate_date from {_RATE_DAYS} d"
        for c, b in FIXTURE_BASE_RATES)
    return f"""
select currency, rate_date, base * (1 + cast(day(rate_date) as double) / 1000) as rate_to_usd
from ({branches}) x
where day(rate_date) <> 29"""


def _fx_rate_api_sql() -> str:
    """Two fetches: the first for every order day, the second for days 1-10."""
    branches = "\n  union all ".join(
        f"select {f} as fetch_seq, rate_date, '{c}' as currency, cast({r} as double) as api_rate from {_RATE_DAYS} d"
        + ("" if f == 1 else " where day(rate_date) <= 10")
        for f in (1, 2) for c, r in FIXTURE_API_RATES)
    return f"""
select fetch_seq, rate_date, currency, api_rate * (1 + cast(fetch_seq as double) / 100) as api_rate
from ({branches}) x"""


FX_SQL: dict[str, str] = {
    "fx_sources": """
select concat('src-', lpad(cast(n_nationkey as string), 2, '0')) as source_id,
       lower(n_name) as name,
       concat('https://feeds.example.com/', lower(n_name), '.csv') as download_url,
       case when n_nationkey % 9 = 8 then 'excel' else 'csv' end as file_type,
       '00:00:00' as schedule_time,
       n_nationkey % 5 <> 4 as active
from nation""",
    "fx_raw_revenue": """
select o_orderkey,
       concat('src-', lpad(cast(c_nationkey as string), 2, '0')) as source_id,
       cast(date_trunc('month', o_orderdate) as date) as file_date,
       cast(1 + row_number() over (partition by c_nationkey, date_trunc('month', o_orderdate) order by o_orderkey) as bigint) as line_number,
       case o_orderkey % 11
         when 1 then concat(lpad(cast(day(o_orderdate) as string), 2, '0'), '/', lpad(cast(month(o_orderdate) as string), 2, '0'), '/', cast(year(o_orderdate) as string))
         when 2 then concat(lpad(cast(month(o_orderdate) as string), 2, '0'), '/', lpad(cast(day(o_orderdate) as string), 2, '0'), '/', cast(year(o_orderdate) as string))
         when 3 then concat(cast(year(o_orderdate) as string), '/', lpad(cast(month(o_orderdate) as string), 2, '0'), '/', lpad(cast(day(o_orderdate) as string), 2, '0'))
         when 4 then concat(lpad(cast(day(o_orderdate) as string), 2, '0'), '-', lpad(cast(month(o_orderdate) as string), 2, '0'), '-', cast(year(o_orderdate) as string))
         when 5 then concat(cast(year(o_orderdate) as string), '-', cast(month(o_orderdate) as string), '-', cast(day(o_orderdate) as string))
         when 6 then 'n/a'
         else concat(cast(year(o_orderdate) as string), '-', lpad(cast(month(o_orderdate) as string), 2, '0'), '-', lpad(cast(day(o_orderdate) as string), 2, '0'))
       end as date_s,
       case when o_orderkey % 13 = 0 then 'abc'
            when o_orderkey % 17 = 0 then ''
            when o_orderkey % 19 = 0 then concat(' ', cast(cast(o_totalprice as decimal(18,2)) as string))
            else cast(cast(o_totalprice as decimal(18,2)) as string) end as revenue_s,
       case o_orderkey % 7 when 0 then 'USD' when 1 then 'EUR' when 2 then 'GBP' when 3 then 'INR'
            when 4 then 'JPY' when 5 then '' else 'XXX' end as currency_s,
       case when o_orderkey % 29 = 3 then concat(o_orderpriority, chr(10), '"second", line') else o_orderpriority end as product
from orders join customer on o_custkey = c_custkey""",
    "fx_rates": _fx_rates_sql(),
    "fx_rate_api": _fx_rate_api_sql(),
    "fx_files": """
select concat(source_id, '/', cast(file_date as string)) as file_id, source_id, file_date,
       case h % 10 when 6 then 'failed' when 7 then 'processing' when 8 then 'downloaded' when 9 then 'downloaded' else 'completed' end as status,
       md5(concat(source_id, cast(file_date as string))) as checksum,
       cast('2024-06-01 12:00:00' as timestamp) - interval '1' minute * (h % 61) as created_at
from (select source_id, file_date, year(file_date) * 12 + month(file_date) * 7 + cast(substring(source_id, 5, 2) as int) * 31 as h
      from (select distinct concat('src-', lpad(cast(c_nationkey as string), 2, '0')) as source_id,
                   cast(date_trunc('month', o_orderdate) as date) as file_date
            from orders join customer on o_custkey = c_custkey) a) b""",
    "fx_file_events": """
select file_id, 'downloaded' as status, 1 as seq from fx_files
union all select file_id, 'processing' as status, 2 as seq from fx_files where status <> 'downloaded'
union all select file_id, status, 3 as seq from fx_files where status in ('completed', 'failed')""",
}

# Views that other views read; registration and CTE order follow this.
FX_DEPENDS = {"fx_file_events": ("fx_files",)}


def register_base_tables(spark: SparkSession, sf_dir: str, names=BASE_TABLES) -> None:
    for name in names:
        spark.read.parquet(f"{sf_dir}/{name}.parquet").createOrReplaceTempView(name)


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Resolve one fixture view against the tables in ``sf_dir``."""
    register_base_tables(spark, sf_dir, ("nation", "customer", "orders"))
    for dep in FX_DEPENDS.get(name, ()):
        spark.sql(FX_SQL[dep]).createOrReplaceTempView(dep)
    return spark.sql(FX_SQL[name])


def with_fixtures(sql: str, *names: str, ctes: str = "") -> str:
    """Prefix ``sql`` with the CTEs for the named fixture views (DuckDB side).

    ``ctes`` holds further ``name as (...)`` definitions placed after them.
    """
    ordered: list[str] = []
    for n in names:
        for dep in FX_DEPENDS.get(n, ()):
            if dep not in ordered:
                ordered.append(dep)
        if n not in ordered:
            ordered.append(n)
    parts = [f"{n} as ({FX_SQL[n]}\n)" for n in ordered]
    if ctes.strip():
        parts.append(ctes.strip())
    return "with " + ",\n".join(parts) + "\n" + sql.strip()
