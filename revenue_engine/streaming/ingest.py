"""Continuous file ingest.

R1  The landing folder is a file-source stream of paths (``binaryFile``
    with only ``path`` and time selected, so no content is read by the
    source); ``maxFilesPerTrigger`` bounds the work per micro-batch
    (back-pressure). Each micro-batch runs the batch scan over its new files.
R2  The rate table is read inside ``foreachBatch``, so rates loaded after
    the stream started are seen by later micro-batches.
R3  Exactly once per file and first wins per (source, day): keyed state holds
    the file that took a key, across micro-batches; a later file of the key is
    reported as a duplicate and not loaded. The sink replaces whole keys, and
    outcomes and ledger events are written by epoch, replacing what an
    interrupted run of that epoch left, so a repeated micro-batch or a replay
    with a fresh checkpoint leaves one result per file.
R4  Running file counts per status, and running row counts per file: a
    stateful aggregate in update mode, whose changed rows replace theirs in a
    stored table.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from revenue_engine.functions.identity import file_key
from revenue_engine.operators import convert as cv
from revenue_engine.operators import ledger as lg
from revenue_engine.operators import maintenance as mt
from revenue_engine.operators import versions as vs
from revenue_engine.session import drop_stored, stored
from revenue_engine.sources import landing as ld

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have this package

# Outcomes of files that are not scanned, and the events of a file's life.
DUPLICATE, BAD_PATH = "duplicate", "unparsable_path"
OUTCOME_SCHEMA = ("file_path string, source_id string, file_date date, status string, reason string, n_data_rows long, "
                  "first_bad_line long, winner string, epoch long")
EVENT_SCHEMA = "file_id string, status string, seq long, epoch long"
DECISION_SCHEMA = "file_path string, source_id string, file_date date, winner string"


def landed_paths_stream(spark: SparkSession, root: str, max_files_per_trigger: int = 1000) -> DataFrame:
    return (spark.readStream.format("binaryFile")
            .schema("path string, modificationTime timestamp, length long, content binary")
            .option("recursiveFileLookup", "true")
            .option("maxFilesPerTrigger", max_files_per_trigger)
            .load(root).select(F.col("path").alias("file_path"), F.col("modificationTime").alias("modified_at")))


def _first_of_key(key, batches, state):
    """The file that holds the key: the one in the state, else the earliest given (by time, then path)."""
    files = pd.concat(list(batches)).sort_values(["modified_at", "file_path"])
    winner = state.get[0] if state.exists else files["file_path"].iloc[0]
    state.update((winner,))
    yield files.assign(winner=winner)[["file_path", "source_id", "file_date", "winner"]]


def first_wins(files: DataFrame) -> DataFrame:
    """L6 on a stream of (file_path, modified_at, source_id, file_date): every file with the file that holds its key.

    The state has one path for each (source, day) ever seen, in the state
    store of the checkpoint. Paths without a key are keys of their own.
    """
    key = F.when(F.col("source_id").isNull() | F.col("file_date").isNull(), F.col("file_path")).otherwise(
        F.concat_ws("|", "source_id", "file_date"))
    return (files.select("file_path", "modified_at", "source_id", "file_date", key.alias("_key"))
            .groupBy("_key").applyInPandasWithState(_first_of_key, DECISION_SCHEMA, "winner string", "append",
                                                    GroupStateTimeout.NoTimeout))


def literal_path(path: str) -> str:
    """``path`` with its glob characters escaped, so that a read takes it as it is."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def ingest_batch(spark: SparkSession, decided: DataFrame, rates: DataFrame, table_path: str,
                 with_keys: Callable[[DataFrame], DataFrame], outcomes_path: str | None = None,
                 events_path: str | None = None, epoch: int = 0, loaded_at=None) -> None:
    """The batch ingest of newly landed files, each with the file that holds its key (``first_wins``)."""
    decided = stored(decided, "ingest-files")
    has_key = F.col("source_id").isNotNull() & F.col("file_date").isNotNull()
    taken = decided.where(has_key & (F.col("file_path") == F.col("winner")))
    paths = [r.file_path for r in taken.select("file_path").collect()]  # at most maxFilesPerTrigger
    outcome = (decided.where(~has_key | (F.col("file_path") != F.col("winner")))
               .select("file_path", "source_id", "file_date", F.lit(lg.FAILED).alias("status"),
                       F.when(has_key, F.lit(DUPLICATE)).otherwise(F.lit(BAD_PATH)).alias("reason"),
                       F.lit(0).cast("long").alias("n_data_rows"), F.lit(None).cast("long").alias("first_bad_line"), "winner"))
    if paths:
        rows, blocks = ld.scan_landed_csv(spark, [literal_path(p) for p in paths])
        scanned = ld.file_outcomes(blocks, taken).join(taken, "file_path")
        outcome = stored(scanned.select(*outcome.columns).unionByName(outcome), "ingest-outcomes")
        done = outcome.where(F.col("status") == lg.COMPLETED)
        classified = mt.classify_payload_rows(with_keys(rows), rates)
        mt.write_revenues(mt.revenue_rows(classified, loaded_at), table_path, done)
        ld.drop_scan(rows, blocks)
    outcome = outcome.withColumn("epoch", F.lit(epoch).cast("long"))
    if outcomes_path is not None:
        by_epoch(outcome, outcomes_path)
    if events_path is not None:
        by_epoch(load_events(outcome), events_path)
    drop_stored(decided, outcome)


def load_events(outcomes: DataFrame) -> DataFrame:
    """What a load adds to the ledger's event log: downloaded, processing, then the end, for each file it took."""
    steps = F.array(F.struct(F.lit(lg.DOWNLOADED).alias("status"), F.lit(1).alias("n")),
                    F.struct(F.lit(lg.PROCESSING).alias("status"), F.lit(2).alias("n")),
                    F.struct(F.col("status"), F.lit(3).alias("n")))
    return (outcomes.where(F.col("file_path") == F.col("winner")).where("source_id is not null and file_date is not null")
            .select(file_key("source_id", "file_date").alias("file_id"), "epoch", F.explode(steps).alias("e"))
            .select("file_id", F.col("e.status").alias("status"), (F.col("epoch") * 3 + F.col("e.n")).cast("long").alias("seq"), "epoch"))


def by_epoch(df: DataFrame, path: str) -> None:
    """Replace the rows of the epochs in ``df``; a repeated micro-batch leaves no second copy."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("epoch").parquet(path)


def read_outcomes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(OUTCOME_SCHEMA).parquet(path)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(EVENT_SCHEMA).parquet(path)


def start_ingest(spark: SparkSession, landing_root: str, rates_loader: Callable[[], DataFrame],
                 table_path: str, checkpoint: str, with_keys: Callable[[DataFrame], DataFrame],
                 outcomes_path: str | None = None, max_files_per_trigger: int = 1000,
                 available_now: bool = False, processing_time: str = "1 minute", events_path: str | None = None, loaded_at=None):
    """Start the continuous ingest; returns the ``StreamingQuery``.

    Only the micro-batch's file names (at most ``max_files_per_trigger``)
    reach the driver; the rows are scanned, converted and written by tasks.
    """
    def run(batch: DataFrame, epoch_id: int) -> None:
        ingest_batch(batch.sparkSession, batch, rates_loader(), table_path, with_keys, outcomes_path, events_path, epoch_id, loaded_at)

    files = with_keys(landed_paths_stream(spark, landing_root, max_files_per_trigger))
    writer = first_wins(files).writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()


FILE_STATS_SCHEMA = "source_id string, file_date date, total_rows long, skipped_rows long"


def start_file_stats(spark: SparkSession, rows: DataFrame, classify: Callable[[DataFrame], DataFrame], out_path: str,
                     checkpoint: str, available_now: bool = False, processing_time: str = "1 minute"):
    """Accepted and skipped rows of every file as running totals over a stream of raw ``rows``.

    ``classify`` gives each row its ``reason``. The totals live in the state
    store; a micro-batch hands on only the files it changed, and their rows
    replace the earlier ones, so repeating it changes nothing.
    """
    totals = cv.file_stats(classify(rows))
    table = vs.Table(out_path, FILE_STATS_SCHEMA, ("source_id", "file_date"))

    def run(batch: DataFrame, epoch_id: int) -> None:
        vs.write(table, batch)

    writer = totals.writeStream.outputMode("update").foreachBatch(run).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()


def read_file_stats(spark: SparkSession, path: str) -> DataFrame:
    return vs.read(spark, vs.Table(path, FILE_STATS_SCHEMA, ("source_id", "file_date")))


def start_status_counts(spark: SparkSession, files_root: str, schema: str, out_path: str, checkpoint: str,
                        available_now: bool = False, processing_time: str = "1 minute"):
    """Files per status as a running aggregate, rewritten whole each batch.

    The aggregate has one row per status, so complete mode keeps bounded
    state and the rewrite per batch is tiny.
    """
    counts = (spark.readStream.schema(schema).parquet(files_root)
              .groupBy("status").agg(F.count(F.lit(1)).alias("n_files")))

    def run(batch: DataFrame, epoch_id: int) -> None:
        batch.write.mode("overwrite").parquet(out_path)

    writer = (counts.writeStream.outputMode("complete").foreachBatch(run)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()
