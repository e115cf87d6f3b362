"""File ledger: registration, status history, stuck detection, reports.

The ledger is ``files(file_id, source_id, file_date, status, checksum,
created_at)`` plus an append-only ``file_events(file_id, status, seq)``
history; the current status of a file is its event with the highest seq.
Every clock is a parameter (``as_of``), never the wall clock.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revenue_engine.functions.identity import file_key
from revenue_engine.functions.paths import landing_path
from revenue_engine.operators.joins import lookup_join

# File states and the reconciler threshold.
DOWNLOADED, PROCESSING, COMPLETED, FAILED = "downloaded", "processing", "completed", "failed"
STATUSES = (DOWNLOADED, PROCESSING, COMPLETED, FAILED)
STUCK_MINUTES = 30
BACKLOG_TARGET = 100
LANDING_DIR = "/data"


def _ts(as_of) -> F.Column:
    return F.lit(as_of).cast("timestamp") if isinstance(as_of, str) else as_of


def active_sources(sources: DataFrame) -> DataFrame:
    """``WHERE active = TRUE`` (NULL is not active)."""
    return sources.where(F.col("active") == F.lit(True))


def current_status(events: DataFrame) -> DataFrame:
    """The status of the highest ``seq`` per file (partial aggregation map-side)."""
    return events.groupBy("file_id").agg(F.max_by("status", "seq").alias("status"),
                                         F.max("seq").alias("seq"))


def status_event(files: DataFrame, status: str, events: DataFrame) -> DataFrame:
    """Append-only status update — the next event for each given file."""
    last = events.groupBy("file_id").agg(F.max("seq").alias("_last"))
    return (files.select("file_id").join(last, "file_id", "left")
            .select("file_id", F.lit(status).alias("status"),
                    (F.coalesce(F.col("_last"), F.lit(0)) + 1).alias("seq")))


def stuck_files(files: DataFrame, as_of, minutes: int = STUCK_MINUTES) -> DataFrame:
    """L4: processing files registered more than ``minutes`` before ``as_of``, oldest first."""
    cutoff = _ts(as_of) - F.expr(f"interval {int(minutes)} minutes")
    return (files.where((F.col("status") == PROCESSING) & (F.col("created_at") < cutoff))
            .orderBy("created_at", "file_id"))


def with_landing_path(files: DataFrame, sources: DataFrame, base_dir: str = LANDING_DIR) -> DataFrame:
    """``<dir>/<source name>/<yyyy-MM-dd>.<file_type>`` from the source row."""
    src = sources.select(F.col("source_id").alias("_sid"), F.col("name").alias("_name"),
                         F.col("file_type").alias("_ftype"))
    j = lookup_join(files, src, files["source_id"] == src["_sid"], "left")
    return (j.withColumn("file_path", landing_path(base_dir, "_name", "file_date", "_ftype"))
            .drop("_sid", "_name", "_ftype"))


def requeue_stuck(files: DataFrame, events: DataFrame, sources: DataFrame, as_of,
                  minutes: int = STUCK_MINUTES, base_dir: str = LANDING_DIR) -> DataFrame:
    """Stuck files back to ``downloaded`` (next event) with their job record."""
    from revenue_engine.sources.jobs import encode_jobs
    stuck = stuck_files(files, as_of, minutes).select("file_id", "source_id", "file_date")
    ev = status_event(stuck, DOWNLOADED, events)
    out = with_landing_path(stuck, sources, base_dir).join(ev, "file_id")
    return encode_jobs(out).select("file_id", "source_id", "file_date", "status", "seq", "job_json")


def register_files(candidates: DataFrame, ledger: DataFrame, arrival_col: str) -> DataFrame:
    """One registration per (source_id, file_date), first arrival wins.

    Duplicates inside the batch lose to the earliest arrival (``min_by``
    runs as a partial aggregate, so a hot key never gathers its rows in one
    task); keys already in the ledger are reported, not registered.
    """
    groups = (candidates.groupBy("source_id", "file_date")
              .agg(F.min(arrival_col).alias("winner"),
                   F.min_by("checksum", F.col(arrival_col)).alias("checksum"),
                   F.count(F.lit(1)).alias("n_candidates")))
    known = ledger.select(F.col("source_id").alias("_s"), F.col("file_date").alias("_d"),
                          F.lit(True).alias("_known"))
    j = lookup_join(groups, known, (groups["source_id"] == known["_s"]) & (groups["file_date"] == known["_d"]),
                    "left")
    return j.select(file_key("source_id", "file_date").alias("file_id"), "source_id", "file_date",
                    "winner", "checksum", "n_candidates",
                    F.when(F.col("_known"), F.lit("already_registered"))
                    .otherwise(F.lit("registered")).alias("outcome"))


def register_by_name(requests: DataFrame, sources: DataFrame, base_dir: str = LANDING_DIR) -> DataFrame:
    """Ledger rows for (source name, file_date) requests; one source per name."""
    one = (sources.groupBy("name")
           .agg(F.min_by(F.struct("source_id", "file_type"), "source_id").alias("_s"))
           .select("name", "_s.source_id", "_s.file_type"))
    j = requests.join(one, "name")
    return j.select(file_key("source_id", "file_date").alias("file_id"), "source_id", "file_date",
                    landing_path(base_dir, "name", "file_date", "file_type").alias("local_path"),
                    F.lit(DOWNLOADED).alias("status"))


def sources_due(sources: DataFrame, files: DataFrame, day) -> DataFrame:
    """Active sources without a file for ``day``."""
    d = F.lit(day).cast("date") if isinstance(day, str) else day
    have = files.where(F.col("file_date") == d).select("source_id")
    return (active_sources(sources).join(have, "source_id", "left_anti")
            .select("source_id", "name", d.alias("file_date")))


def pending_files(files: DataFrame, events: DataFrame) -> DataFrame:
    """Files whose current status is ``downloaded`` and that never completed."""
    cur = current_status(events).where(F.col("status") == DOWNLOADED).select("file_id")
    done = events.where(F.col("status") == COMPLETED).select("file_id")
    return files.join(cur, "file_id", "left_semi").join(done, "file_id", "left_anti")


def orphan_files(files: DataFrame, sources: DataFrame) -> DataFrame:
    """Files whose ``source_id`` is not in ``sources``."""
    return files.join(sources.select("source_id"), "source_id", "left_anti")


def files_by_status(files: DataFrame) -> DataFrame:
    """A2: ``SELECT status, COUNT(*) GROUP BY status``."""
    return files.groupBy("status").agg(F.count(F.lit(1)).alias("n_files"))


def stuck_count(files: DataFrame, as_of, minutes: int = STUCK_MINUTES) -> DataFrame:
    """A4: number of stuck files."""
    return stuck_files(files, as_of, minutes).agg(F.count(F.lit(1)).alias("n_stuck"))


def backlog_depth(pending: DataFrame) -> DataFrame:
    """A5: jobs waiting, per source."""
    return pending.groupBy("source_id").agg(F.count(F.lit(1)).alias("n_pending"))


def health_metrics(files: DataFrame, pending: DataFrame, as_of, minutes: int = STUCK_MINUTES,
                   backlog_target: int = BACKLOG_TARGET) -> DataFrame:
    """Failure share, stuck count and backlog against its target, in one row."""
    cutoff = _ts(as_of) - F.expr(f"interval {int(minutes)} minutes")
    # One pass over both inputs: tag and union, then a single aggregate.
    rows = (files.select("status", "created_at", F.lit(False).alias("_pending"))
            .unionByName(pending.select(F.lit(None).cast("string").alias("status"),
                                        F.lit(None).cast("timestamp").alias("created_at"),
                                        F.lit(True).alias("_pending"))))
    is_file = ~F.col("_pending")
    stuck = is_file & (F.col("status") == PROCESSING) & (F.col("created_at") < cutoff)
    return (rows.agg(F.count_if(is_file).alias("n_files"),
                     F.count_if(is_file & (F.col("status") == COMPLETED)).alias("n_completed"),
                     F.count_if(is_file & (F.col("status") == FAILED)).alias("n_failed"),
                     F.count_if(stuck).alias("n_stuck"),
                     F.count_if(F.col("_pending")).alias("backlog"))
            .withColumn("failed_share", F.when(F.col("n_files") > 0,
                                               F.col("n_failed").cast("double") / F.col("n_files")))
            .withColumn("backlog_alert", F.col("backlog") > backlog_target)
            .withColumn("stuck_alert", F.col("n_stuck") > 0))


def table_violations(df: DataFrame, table: str, key, not_null, unique, checks=()) -> DataFrame:
    """Violated checks of one table, in one scan.

    Each row gives an array of what it violates by itself, or could violate
    with others: ``key`` names it, ``not_null`` lists columns, ``unique`` pairs
    of (name, columns), ``checks`` pairs of (name, condition that must not be
    TRUE). The entries are exploded and counted together, map-side first; an
    entry of a unique key is a violation where it counts more than one row.
    Nulls in a unique key form a value, as in a grouping.
    """
    def entry(name, k, alone):
        return F.struct(F.lit(name).alias("constraint_name"), k.alias("key"), F.lit(alone).alias("alone"))

    def joined(cols):
        return F.concat_ws("|", *[F.col(c).cast("string") for c in cols])

    keys = F.array(*[F.col(c).cast("string") for _, cols in unique for c in cols])  # for grouping: concat_ws drops nulls
    place, at = {}, 0
    for name, cols in unique:
        place[name] = F.slice(keys, at + 1, len(cols))
        at += len(cols)
    none = F.array().cast("array<string>")
    found = ([F.when(F.col(c).isNull(), entry(f"{c}_not_null", joined(key), True)) for c in not_null]
             + [F.when(cond, entry(name, joined(key), True)) for name, cond in checks])
    rows = df.select(F.array_compact(F.array(
        *[F.when(e.isNotNull(), F.struct(e.alias("e"), none.alias("k"))) for e in found],
        *[F.struct(entry(name, joined(cols), False).alias("e"), place[name].alias("k")) for name, cols in unique])).alias("all"))
    each = rows.select(F.explode("all").alias("x")).select("x.e.*", "x.k")
    counted = each.groupBy("constraint_name", "key", "k", "alone").agg(F.count(F.lit(1)).alias("n"))
    out = counted.where(F.col("alone") | (F.col("n") > 1))
    # Rows violating alone are listed one by one, repeated keys with their number of rows.
    times = F.when(F.col("alone"), F.col("n")).otherwise(F.lit(1)).cast("int")
    return (out.withColumn("_", F.explode(F.array_repeat(F.lit(1), times)))
            .select(F.lit(table).alias("table_name"), "constraint_name", "key",
                    F.when(F.col("alone"), F.lit(1)).otherwise(F.col("n")).cast("long").alias("n_rows")))


def constraint_violations(sources: DataFrame, files: DataFrame, rates: DataFrame) -> DataFrame:
    """Declared NOT NULL, PRIMARY KEY, UNIQUE and status-domain checks, one scan per table.

    One row per violated (table, constraint, key); duplicate keys are found
    by a grouped count (partial aggregation), never by pairing rows.
    """
    return (table_violations(sources, "sources", ["source_id"],
                             ["source_id", "name", "download_url", "file_type", "schedule_time"], [("sources_pk", ["source_id"])])
            .unionByName(table_violations(files, "files", ["file_id"], ["file_id", "source_id", "file_date", "status"],
                                          [("files_pk", ["file_id"]), ("files_source_date_unique", ["source_id", "file_date"])],
                                          [("status_domain", ~F.col("status").isin(*STATUSES))]))
            .unionByName(table_violations(rates, "exchange_rates", ["currency", "rate_date"], ["currency", "rate_date", "rate_to_usd"],
                                          [("exchange_rates_pk", ["currency", "rate_date"])])))


def throughput(events: DataFrame, stats: DataFrame) -> DataFrame:
    """Per file, processing time and rows per second.

    ``events`` carries ``file_id, status, at`` (the time each status was
    recorded); ``stats`` carries ``file_id, total_rows, skipped_rows``
    (``operators.convert.file_stats``). Time runs from the last
    ``processing`` event to the first ``completed`` or ``failed`` after it.
    """
    start = (events.where(F.col("status") == PROCESSING)
             .groupBy("file_id").agg(F.max("at").alias("started_at")))
    ends = events.where(F.col("status").isin(COMPLETED, FAILED)).select("file_id", F.col("at").alias("_end"))
    finished = (start.join(ends, "file_id").where(F.col("_end") >= F.col("started_at"))
                .groupBy("file_id", "started_at").agg(F.min("_end").alias("finished_at")))
    secs = F.unix_micros(F.col("finished_at").cast("timestamp")) - F.unix_micros(F.col("started_at").cast("timestamp"))
    rows = F.col("total_rows") + F.col("skipped_rows")
    return (finished.join(stats, "file_id")
            .select("file_id", "started_at", "finished_at", (secs / 1e6).alias("seconds"),
                    rows.alias("rows"),
                    F.when(secs > 0, rows / (secs / 1e6)).alias("rows_per_sec")))
