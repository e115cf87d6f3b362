"""Queries over the revenue sink: full file ingest and conditional delete."""

from __future__ import annotations

from pyspark.sql import functions as F

from revenue_engine.fixtures import AS_OF, fixture, with_fixtures
from revenue_engine.operators import ledger as lg
from revenue_engine.operators import maintenance as mt
from revenue_engine.operators import versions as vs
from revenue_engine.plans.catalog import query
from revenue_engine.plans.oracle_sql import PARSED_CTE
from revenue_engine.plans.q_files import landed_root, with_keys
from revenue_engine.session import scratch_path
from revenue_engine.sources import landing as ld

REVENUES_ORACLE = f"""
select sha256(concat_ws('|', c.source_id, cast(c.file_date as varchar), cast(c.line_number as varchar))) as revenue_id,
       c.source_id, c.file_date, concat(c.source_id, '/', cast(c.file_date as varchar)) as file_id, c.line_number,
       c.revenue_date, c.original_value, c.currency, '{AS_OF}' as created_at,
       c.original_value * c.rate_to_usd as usd_value,
       replace(replace(replace(json_object('currency', c.currency_s, 'date', c.date_s, 'product', c.product,
                                           'revenue', c.revenue_s)::varchar,
               '&', '\\u0026'), '<', '\\u003c'), '>', '\\u003e') as raw_payload
from classified c join fx_files f on f.source_id = c.source_id and f.file_date = c.file_date
where c.reason is null and f.status <> 'failed'"""


def as_result(revenues):
    return revenues.withColumn("created_at", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss"))


def ingest_landed(spark, sf_dir, table_path):
    """Scan the landed files, convert, and load the accepted rows of completed files."""
    rows, blocks = ld.scan_landed_csv(spark, landed_root(spark, sf_dir))
    rates = fixture(spark, sf_dir, "fx_rates")
    classified = mt.classify_payload_rows(with_keys(rows), rates)
    done = with_keys(ld.file_outcomes(blocks).where(F.col("status") == lg.COMPLETED))
    mt.write_revenues(mt.revenue_rows(classified, AS_OF), table_path, done)
    ld.drop_scan(rows, blocks)
    return as_result(mt.read_revenues(spark, table_path))


@query("load_revenues", with_fixtures(REVENUES_ORACLE, "fx_raw_revenue", "fx_rates", "fx_files",
                                      ctes=PARSED_CTE))
def q_load_revenues(spark, sf_dir):
    """S7+L11: landed files → verdicts → USD → partition-atomic load, read back."""
    return ingest_landed(spark, sf_dir, scratch_path(spark, "revenues"))


@query("replay_load_revenues", with_fixtures(REVENUES_ORACLE, "fx_raw_revenue", "fx_rates", "fx_files",
                                             ctes=PARSED_CTE))
def q_replay_load_revenues(spark, sf_dir):
    """Loading the same files twice leaves the table unchanged (no duplicates)."""
    path = scratch_path(spark, "revenues-replay")
    ingest_landed(spark, sf_dir, path)
    return ingest_landed(spark, sf_dir, path)


@query("delete_where", with_fixtures("""
select file_id, source_id, file_date, status from fx_files
where not coalesce(status = 'failed' and file_date < date '1998-01-01', false)""", "fx_files"))
def q_delete_where(spark, sf_dir):
    """DELETE FROM files WHERE status = 'failed' AND file_date < 1998-01-01, on a stored table, read back."""
    table = vs.Table(scratch_path(spark, "files-table"), "file_id string, source_id string, file_date date, status string", ("file_id",))
    vs.write(table, fixture(spark, sf_dir, "fx_files"))
    vs.delete(spark, table, (F.col("status") == lg.FAILED) & (F.col("file_date") < F.lit("1998-01-01").cast("date")))
    return vs.read(spark, table)
