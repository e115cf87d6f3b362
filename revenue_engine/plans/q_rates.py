"""Queries over the exchange-rate path: payload scan, inversion, upserts."""

from __future__ import annotations

from pyspark.sql import functions as F

from revenue_engine.fixtures import fixture, with_fixtures
from revenue_engine.operators import rates as rt
from revenue_engine.operators import versions as vs
from revenue_engine.plans.catalog import query
from revenue_engine.session import scratch_path
from revenue_engine.sources import rate_payloads as rp

# Oracle form of ``incoming_rates`` over fx_rate_api.
INCOMING_CTE = """
incoming as (
  select currency, rate_date, cast(1 as double) / api_rate as rate_to_usd, cast(fetch_seq as bigint) as seq, 0 as sub
  from fx_rate_api where api_rate <> 0
  union all
  select distinct 'USD' as currency, rate_date, cast(1 as double) as rate_to_usd, cast(fetch_seq as bigint) as seq, 1 as sub
  from fx_rate_api
)"""


@query("rate_payload_scan", with_fixtures("""
select fetch_seq, rate_date, currency, api_rate from fx_rate_api""", "fx_rate_api"))
def q_rate_payload_scan(spark, sf_dir):
    """S4+T8: API payloads landed as JSON lines, read back, validated and exploded."""
    api = fixture(spark, sf_dir, "fx_rate_api")
    root = scratch_path(spark, "rate-payloads")
    rp.write_payloads(rp.encode_payloads(api), root)
    return rp.explode_rates(rp.read_rate_payloads(spark, root))


@query("invert_rates", with_fixtures("""
select fetch_seq, rate_date, currency, cast(1 as double) / api_rate as rate_to_usd
from fx_rate_api where api_rate <> 0""", "fx_rate_api"))
def q_invert_rates(spark, sf_dir):
    """USD per unit = 1 / API rate; zero rates skipped."""
    return rt.invert_rates(fixture(spark, sf_dir, "fx_rate_api"))


@query("upsert_rates", with_fixtures("""
select currency, rate_date, arg_max(rate_to_usd, seq * 2 + sub) as rate_to_usd
from (select currency, rate_date, rate_to_usd, cast(-1 as bigint) as seq, 0 as sub from fx_rates
      union all select * from incoming) a
group by currency, rate_date""", "fx_rates", "fx_rate_api", ctes=INCOMING_CTE))
def q_upsert_rates(spark, sf_dir):
    """L1+L2: the stored rate table after applying every fetch in order, USD forced to 1.0, read back."""
    path = scratch_path(spark, "rate-table")
    vs.write(rt.rate_table(path), fixture(spark, sf_dir, "fx_rates"))
    rt.merge_rates(spark, path, rt.incoming_rates(fixture(spark, sf_dir, "fx_rate_api")))
    return vs.read(spark, rt.rate_table(path))


@query("upsert_touched_rates", with_fixtures("""
select currency, rate_date, arg_max(rate_to_usd, seq * 2 + sub) as rate_to_usd
from (select currency, rate_date, rate_to_usd, cast(-1 as bigint) as seq, 0 as sub from fx_rates
      where rate_date in (select rate_date from incoming where seq = 2)
      union all select * from incoming where seq = 2) a
group by currency, rate_date""", "fx_rates", "fx_rate_api", ctes=INCOMING_CTE))
def q_upsert_touched_rates(spark, sf_dir):
    """L1: the second fetch applied to only the rate_date partitions it touches."""
    current = fixture(spark, sf_dir, "fx_rates")
    api = fixture(spark, sf_dir, "fx_rate_api").where(F.col("fetch_seq") == 2)
    incoming = rt.incoming_rates(api)
    return rt.upsert_rates(rt.touched_partitions(current, incoming), incoming)


@query("insert_absent_rates", with_fixtures("""
select currency, rate_date, rate_to_usd from fx_rates
union all
select i.currency, i.rate_date, arg_min(i.rate_to_usd, i.seq) from incoming i
where i.sub = 0
  and not exists (select 1 from fx_rates r where r.currency = i.currency and r.rate_date = i.rate_date)
group by i.currency, i.rate_date""",
    "fx_rates", "fx_rate_api", ctes=INCOMING_CTE))
def q_insert_absent_rates(spark, sf_dir):
    """L3: seed the rates of all fetches with ON CONFLICT DO NOTHING semantics; the first fetch of a key wins."""
    current = fixture(spark, sf_dir, "fx_rates").select("currency", "rate_date", "rate_to_usd")
    seed = (rt.incoming_rates(fixture(spark, sf_dir, "fx_rate_api"))
            .where(F.col("sub") == 0))
    return rt.insert_absent(current, seed)


@query("rate_load_stats", with_fixtures("""
select fetch_seq, rate_date, cast(count(*) as bigint) as rates_received,
       cast(count(*) filter (where api_rate <> 0) + 1 as bigint) as rates_upserted,
       cast(count(*) filter (where api_rate = 0) as bigint) as rates_skipped
from fx_rate_api group by fetch_seq, rate_date""", "fx_rate_api"))
def q_rate_load_stats(spark, sf_dir):
    """A3: per fetch, rates received, upserted (plus the base row) and skipped."""
    return rt.rate_load_stats(fixture(spark, sf_dir, "fx_rate_api"))
