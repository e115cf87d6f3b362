"""Queries over the file ledger, sources and job records."""

from __future__ import annotations

from pyspark.sql import functions as F

from revenue_engine.fixtures import AS_OF, fixture, register_base_tables, with_fixtures
from revenue_engine.functions.paths import path_file_date, path_source_name
from revenue_engine.operators import ledger as lg
from revenue_engine.operators.convert import file_stats
from revenue_engine.operators.ordering import global_row_number
from revenue_engine.plans.catalog import query
from revenue_engine.plans.q_convert import classified
from revenue_engine.sources.jobs import decode_jobs, encode_jobs

# Fixed parameter: the "today" of the due check — the last day of the data.
DUE_DAY = "2001-08-01"
TS_FMT_SPARK, TS_FMT_SQL = "yyyy-MM-dd HH:mm:ss", "%Y-%m-%d %H:%M:%S"
CUTOFF_SQL = f"timestamp '{AS_OF}' - interval '{lg.STUCK_MINUTES}' minute"
PATH_SQL = ("concat('/data/', s.name, '/', strftime(f.file_date, '%Y-%m-%d'), '.', s.file_type)")
PENDING_CTE = """
cur as (select file_id, arg_max(status, seq) as status from fx_file_events group by file_id),
pending as (
  select f.* from fx_files f
  where f.file_id in (select file_id from cur where status = 'downloaded')
    and f.file_id not in (select file_id from fx_file_events where status = 'completed')
)"""


def _files(spark, sf_dir):
    return fixture(spark, sf_dir, "fx_files")


def _events(spark, sf_dir):
    return fixture(spark, sf_dir, "fx_file_events")


def _sources(spark, sf_dir):
    return fixture(spark, sf_dir, "fx_sources")


def _pending(spark, sf_dir):
    return lg.pending_files(_files(spark, sf_dir), _events(spark, sf_dir))


@query("active_sources", with_fixtures("""
select source_id, name, download_url, file_type, schedule_time, active from fx_sources where active = true""",
                                       "fx_sources"))
def q_active_sources(spark, sf_dir):
    """Sources with ``active = TRUE``."""
    return lg.active_sources(_sources(spark, sf_dir))


@query("stuck_files", with_fixtures(f"""
select file_id, source_id, file_date, status, checksum, strftime(created_at, '{TS_FMT_SQL}') as created_at
from fx_files where status = 'processing' and created_at < {CUTOFF_SQL}""", "fx_files"))
def q_stuck_files(spark, sf_dir):
    """L4: processing files older than 30 minutes at the fixed clock, oldest first."""
    return (lg.stuck_files(_files(spark, sf_dir), AS_OF)
            .withColumn("created_at", F.date_format("created_at", TS_FMT_SPARK)))


@query("stuck_count", with_fixtures(f"""
select cast(count(*) as bigint) as n_stuck from fx_files
where status = 'processing' and created_at < {CUTOFF_SQL}""", "fx_files"))
def q_stuck_count(spark, sf_dir):
    """A4: number of stuck files in one reconciler run."""
    return lg.stuck_count(_files(spark, sf_dir), AS_OF)


@query("requeue_stuck", with_fixtures(f"""
select f.file_id, f.source_id, f.file_date, 'downloaded' as status,
       cast(e.last_seq + 1 as bigint) as seq,
       json_object('file_id', f.file_id, 'source_id', f.source_id, 'file_path', {PATH_SQL})::varchar as job_json
from fx_files f
join fx_sources s on s.source_id = f.source_id
join (select file_id, max(seq) as last_seq from fx_file_events group by file_id) e on e.file_id = f.file_id
where f.status = 'processing' and f.created_at < {CUTOFF_SQL}""", "fx_files", "fx_file_events", "fx_sources"))
def q_requeue_stuck(spark, sf_dir):
    """Stuck files back to downloaded (next status event) with their job JSON."""
    return lg.requeue_stuck(_files(spark, sf_dir), _events(spark, sf_dir), _sources(spark, sf_dir), AS_OF)


@query("current_status", with_fixtures("""
select file_id, arg_max(status, seq) as status, max(seq) as seq from fx_file_events group by file_id""",
                                       "fx_file_events"))
def q_current_status(spark, sf_dir):
    """Current status = the event with the highest sequence."""
    return lg.current_status(_events(spark, sf_dir))


@query("files_by_status", with_fixtures("""
select status, cast(count(*) as bigint) as n_files from fx_files group by status""", "fx_files"))
def q_files_by_status(spark, sf_dir):
    """A2: files per status."""
    return lg.files_by_status(_files(spark, sf_dir))


@query("pending_files", with_fixtures("""
select file_id, source_id, file_date, status, checksum from pending""",
                                      "fx_files", "fx_file_events", ctes=PENDING_CTE))
def q_pending_files(spark, sf_dir):
    """Downloaded files that never completed (the completed-file guard)."""
    return _pending(spark, sf_dir).select("file_id", "source_id", "file_date", "status", "checksum")


@query("backlog_depth", with_fixtures("""
select source_id, cast(count(*) as bigint) as n_pending from pending group by source_id""",
                                      "fx_files", "fx_file_events", ctes=PENDING_CTE))
def q_backlog_depth(spark, sf_dir):
    """A5: jobs waiting per source."""
    return lg.backlog_depth(_pending(spark, sf_dir))


@query("backlog_order", with_fixtures(f"""
select cast(row_number() over (order by created_at, file_id) as bigint) as position, file_id,
       strftime(created_at, '{TS_FMT_SQL}') as created_at
from pending""", "fx_files", "fx_file_events", ctes=PENDING_CTE))
def q_backlog_order(spark, sf_dir):
    """FIFO: pending files by (created_at, file_id) with their queue position."""
    p = _pending(spark, sf_dir).select("file_id", "created_at")
    return (global_row_number(p, ["created_at", "file_id"])
            .select("position", "file_id", F.date_format("created_at", TS_FMT_SPARK).alias("created_at")))


@query("health_metrics", with_fixtures(f"""
select cast(count(*) as bigint) as n_files,
       cast(count(*) filter (where status = 'completed') as bigint) as n_completed,
       cast(count(*) filter (where status = 'failed') as bigint) as n_failed,
       cast(count(*) filter (where status = 'processing' and created_at < {CUTOFF_SQL}) as bigint) as n_stuck,
       (select cast(count(*) as bigint) from pending) as backlog,
       cast(count(*) filter (where status = 'failed') as double) / count(*) as failed_share,
       (select count(*) from pending) > {lg.BACKLOG_TARGET} as backlog_alert,
       count(*) filter (where status = 'processing' and created_at < {CUTOFF_SQL}) > 0 as stuck_alert
from fx_files""", "fx_files", "fx_file_events", ctes=PENDING_CTE))
def q_health_metrics(spark, sf_dir):
    """Failure share, stuck files and backlog against the target of 100."""
    return lg.health_metrics(_files(spark, sf_dir), _pending(spark, sf_dir), AS_OF)


@query("sources_due", with_fixtures(f"""
select source_id, name, date '{DUE_DAY}' as file_date from fx_sources s
where active = true
  and not exists (select 1 from fx_files f where f.source_id = s.source_id and f.file_date = date '{DUE_DAY}')""",
                                    "fx_sources", "fx_files"))
def q_sources_due(spark, sf_dir):
    """Active sources without a file for the day."""
    return lg.sources_due(_sources(spark, sf_dir), _files(spark, sf_dir), DUE_DAY)


@query("orphan_files", with_fixtures("""
select f.file_id, f.source_id, f.file_date from fx_files f
where not exists (select 1 from fx_sources s where s.source_id = f.source_id)""", "fx_files", "fx_sources"))
def q_orphan_files(spark, sf_dir):
    """Files whose source does not exist (referential check)."""
    return lg.orphan_files(_files(spark, sf_dir), _sources(spark, sf_dir)).select("file_id", "source_id", "file_date")


REQUESTS_SQL = """
select distinct lower(n_name) as name, cast(date_trunc('month', o_orderdate) as date) as file_date
from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey"""


@query("register_files_by_name", with_fixtures(f"""
select concat(s.source_id, '/', cast(r.file_date as varchar)) as file_id, s.source_id, r.file_date,
       concat('/data/', r.name, '/', strftime(r.file_date, '%Y-%m-%d'), '.', s.file_type) as local_path,
       'downloaded' as status
from ({REQUESTS_SQL}) r
join (select name, min(source_id) as source_id, arg_min(file_type, source_id) as file_type
      from fx_sources group by name) s on s.name = r.name""", "fx_sources"))
def q_register_files_by_name(spark, sf_dir):
    """INSERT … SELECT … FROM sources WHERE name = … — ledger rows by source name."""
    register_base_tables(spark, sf_dir, ("orders", "customer", "nation"))
    requests = spark.sql(REQUESTS_SQL)
    return lg.register_by_name(requests, _sources(spark, sf_dir))


CANDIDATES_SQL = """
select concat('src-', lpad(cast(c_nationkey as string), 2, '0')) as source_id,
       cast(date_trunc('month', o_orderdate + interval '1' month) as date) as file_date,
       o_orderkey as arrival, md5(cast(o_orderkey as string)) as checksum
from orders join customer on o_custkey = c_custkey"""


@query("register_files", with_fixtures(f"""
select concat(c.source_id, '/', cast(c.file_date as varchar)) as file_id, c.source_id, c.file_date,
       min(arrival) as winner, arg_min(c.checksum, arrival) as checksum, cast(count(*) as bigint) as n_candidates,
       case when bool_or(f.file_id is not null) then 'already_registered' else 'registered' end as outcome
from ({CANDIDATES_SQL}) c
left join fx_files f on f.source_id = c.source_id and f.file_date = c.file_date
group by c.source_id, c.file_date""", "fx_files"))
def q_register_files(spark, sf_dir):
    """Unique (source, day) registration, first arrival wins; known keys reported."""
    register_base_tables(spark, sf_dir, ("orders", "customer"))
    return lg.register_files(spark.sql(CANDIDATES_SQL), _files(spark, sf_dir), "arrival")


@query("planned_paths", with_fixtures(f"""
select f.file_id, {PATH_SQL} as local_path,
       regexp_extract({PATH_SQL}, '([^/]+)/([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}})\\.([^./]+)$', 1) as path_source_name,
       cast(try_strptime(regexp_extract({PATH_SQL}, '([^/]+)/([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}})\\.([^./]+)$', 2), '%Y-%m-%d') as date) as path_file_date
from fx_files f join fx_sources s on s.source_id = f.source_id""", "fx_files", "fx_sources"))
def q_planned_paths(spark, sf_dir):
    """Landing path per file and the (name, day) recovered from it."""
    f = lg.with_landing_path(_files(spark, sf_dir), _sources(spark, sf_dir))
    return f.select("file_id", F.col("file_path").alias("local_path"),
                    path_source_name("file_path").alias("path_source_name"),
                    path_file_date("file_path").alias("path_file_date"))


@query("job_payload_roundtrip", with_fixtures(f"""
select p.file_id, p.source_id, {PATH_SQL.replace('f.', 'p.')} as file_path,
       json_object('file_id', p.file_id, 'source_id', p.source_id, 'file_path', {PATH_SQL.replace('f.', 'p.')})::varchar as job_json,
       p.file_id as job_file_id, p.source_id as job_source_id, {PATH_SQL.replace('f.', 'p.')} as job_file_path,
       cast(null as varchar) as job_error
from pending p join fx_sources s on s.source_id = p.source_id""",
    "fx_files", "fx_file_events", "fx_sources", ctes=PENDING_CTE))
def q_job_payload_roundtrip(spark, sf_dir):
    """Pending files encoded as job JSON and decoded back."""
    p = lg.with_landing_path(_pending(spark, sf_dir), _sources(spark, sf_dir))
    jobs = encode_jobs(p.select("file_id", "source_id", "file_path"))
    return decode_jobs(jobs)


NN_SQL = """
select '{t}' as table_name, '{c}_not_null' as constraint_name, cast({k} as varchar) as key, cast(1 as bigint) as n_rows
from {v} where {c} is null"""


def _nn(t, v, k, cols):
    return "\nunion all".join(NN_SQL.format(t=t, v=v, k=k, c=c) for c in cols)


APPENDED_RATES_CTE = """
appended as (
  select currency, rate_date, rate_to_usd from fx_rates
  union all
  select currency, rate_date, cast(1 as double) / api_rate from fx_rate_api where api_rate <> 0
)"""


@query("constraint_violations", with_fixtures(f"""
select 'sources' as table_name, 'sources_pk' as constraint_name, source_id as key, cast(count(*) as bigint) as n_rows
from fx_sources group by source_id having count(*) > 1
union all
select 'files', 'files_pk', file_id, cast(count(*) as bigint) from fx_files group by file_id having count(*) > 1
union all
select 'files', 'files_source_date_unique', concat_ws('|', source_id, cast(file_date as varchar)), cast(count(*) as bigint)
from fx_files group by source_id, file_date having count(*) > 1
union all
select 'exchange_rates', 'exchange_rates_pk', concat_ws('|', currency, cast(rate_date as varchar)), cast(count(*) as bigint)
from appended group by currency, rate_date having count(*) > 1
union all {_nn('sources', 'fx_sources', 'source_id', ['source_id', 'name', 'download_url', 'file_type', 'schedule_time'])}
union all {_nn('files', 'fx_files', 'file_id', ['file_id', 'source_id', 'file_date', 'status'])}
union all {_nn('exchange_rates', 'appended', "concat_ws('|', currency, cast(rate_date as varchar))", ['currency', 'rate_date', 'rate_to_usd'])}
union all
select 'files', 'status_domain', file_id, cast(1 as bigint) from fx_files
where status not in ('downloaded', 'processing', 'completed', 'failed')""",
    "fx_sources", "fx_files", "fx_rates", "fx_rate_api", ctes=APPENDED_RATES_CTE))
def q_constraint_violations(spark, sf_dir):
    """NOT NULL / PK / UNIQUE / status-domain audit.

    The rate table is audited as it would stand after appending all fetches
    without an upsert, which breaks its primary key.
    """
    from revenue_engine.operators.rates import invert_rates
    api = fixture(spark, sf_dir, "fx_rate_api")
    appended = (fixture(spark, sf_dir, "fx_rates").select("currency", "rate_date", "rate_to_usd")
                .unionByName(invert_rates(api).select("currency", "rate_date", "rate_to_usd")))
    return lg.constraint_violations(_sources(spark, sf_dir), _files(spark, sf_dir), appended)


@query("throughput", with_fixtures("""
select f.file_id, cast(5 * (10 + month(f.file_date)) as double) as seconds, cast(count(*) as bigint) as rows,
       count(*) / cast(5 * (10 + month(f.file_date)) as double) as rows_per_sec
from fx_files f join fx_raw_revenue r on r.source_id = f.source_id and r.file_date = f.file_date
where f.status in ('completed', 'failed') group by f.file_id, f.file_date""", "fx_files", "fx_raw_revenue"))
def q_throughput(spark, sf_dir):
    """Time and rows per second of every ended file; an event's time follows from created_at and seq."""
    files = _files(spark, sf_dir).select("file_id", "source_id", "file_date", "created_at")
    pause = F.col("seq") * F.col("seq") * (F.month("file_date") + 10)
    events = (_events(spark, sf_dir).join(files, "file_id")
              .withColumn("at", F.timestamp_seconds(F.unix_timestamp("created_at") + pause)))
    stats = (classified(spark, sf_dir).transform(file_stats)
             .join(files, ["source_id", "file_date"]).select("file_id", "total_rows", "skipped_rows"))
    return lg.throughput(events, stats).select("file_id", "seconds", "rows", "rows_per_sec")
