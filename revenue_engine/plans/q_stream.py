"""Streaming queries run to completion with ``availableNow`` and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from revenue_engine.fixtures import AS_OF, fixture, with_fixtures
from revenue_engine.operators import convert as cv
from revenue_engine.operators import ledger as lg
from revenue_engine.operators import maintenance as mt
from revenue_engine.plans.catalog import query
from revenue_engine.plans.oracle_sql import PARSED_CTE
from revenue_engine.plans.q_files import landed_root, with_keys
from revenue_engine.plans.q_sinks import REVENUES_ORACLE, as_result
from revenue_engine.session import scratch_path, stored
from revenue_engine.streaming import ingest as si


@query("stream_ingest", with_fixtures(REVENUES_ORACLE, "fx_raw_revenue", "fx_rates", "fx_files",
                                      ctes=PARSED_CTE))
def q_stream_ingest(spark, sf_dir):
    """R1+R2+R3: the landing folder as a file stream, converted per micro-batch."""
    table, _ = ingested(spark, sf_dir)
    return as_result(mt.read_revenues(spark, table))


def ingested(spark, sf_dir):
    """Run the stream over the landed files: paths of the revenue table and of the event log."""
    root = landed_root(spark, sf_dir)
    table, events = scratch_path(spark, "stream-revenues"), scratch_path(spark, "stream-events")
    rates_path = scratch_path(spark, "stream-rates")
    fixture(spark, sf_dir, "fx_rates").write.parquet(rates_path)
    q = si.start_ingest(spark, root, lambda: spark.read.parquet(rates_path), table, scratch_path(spark, "stream-ckpt"), with_keys,
                        max_files_per_trigger=1000, available_now=True, events_path=events, loaded_at=AS_OF)
    q.awaitTermination()
    return table, events


@query("stream_ledger", with_fixtures("""
select file_id, case when status = 'failed' then 'failed' else 'completed' end as status, cast(3 as bigint) as n_events
from fx_files""", "fx_files"))
def q_stream_ledger(spark, sf_dir):
    """L7+L8: the event log the ingest wrote, as the current status and number of events of every file."""
    events = si.read_events(spark, ingested(spark, sf_dir)[1])
    n = events.groupBy("file_id").agg(F.count(F.lit(1)).alias("n_events"))
    return lg.current_status(events).select("file_id", "status").join(n, "file_id")


@query("stream_file_stats", with_fixtures("""
select source_id, file_date, cast(count(*) filter (where reason is null) as bigint) as total_rows,
       cast(count(*) filter (where reason is not null) as bigint) as skipped_rows
from classified group by source_id, file_date""", "fx_raw_revenue", "fx_rates", ctes=PARSED_CTE))
def q_stream_file_stats(spark, sf_dir):
    """Running accepted and skipped rows per file over a stream of raw rows (equals A1)."""
    raw, out = scratch_path(spark, "stream-raw"), scratch_path(spark, "stream-stats")
    rows = fixture(spark, sf_dir, "fx_raw_revenue")
    rows.repartition(8, "o_orderkey").write.parquet(raw)  # every file's rows arrive in several micro-batches
    rates = stored(fixture(spark, sf_dir, "fx_rates"), "stream-stats-rates")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 4).parquet(raw)
    q = si.start_file_stats(spark, stream, lambda df: cv.classify_rows(df, rates), out, scratch_path(spark, "stream-stats-ckpt"),
                            available_now=True)
    q.awaitTermination()
    return si.read_file_stats(spark, out)


@query("stream_status_counts", with_fixtures("""
select status, cast(count(*) as bigint) as n_files from fx_files group by status""", "fx_files"))
def q_stream_status_counts(spark, sf_dir):
    """Running files-per-status over a stream of file records (equals A2)."""
    files_root = scratch_path(spark, "stream-files")
    files = fixture(spark, sf_dir, "fx_files").select("file_id", "source_id", "file_date", "status")
    files.write.parquet(files_root)
    out = scratch_path(spark, "stream-status")
    q = si.start_status_counts(spark, files_root, "file_id string, source_id string, file_date date, status string",
                               out, scratch_path(spark, "stream-status-ckpt"), available_now=True)
    q.awaitTermination()
    return spark.read.parquet(out)
