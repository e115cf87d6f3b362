"""Revenue table: build, atomic per-file load, read back, conditional delete."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revenue_engine.functions.identity import file_key, revenue_id
from revenue_engine.functions.payload import raw_payload_json
from revenue_engine.operators import versions as vs
from revenue_engine.operators.convert import classify_rows
from revenue_engine.sources.landing import payload_field

KEYS = ("source_id", "file_date")
REVENUE_SCHEMA = ("revenue_id string, source_id string, file_date date, file_id string, line_number bigint, revenue_date date, "
                  "original_value double, currency string, usd_value double, raw_payload string, created_at timestamp")
REVENUE_COLUMNS = tuple(f.split()[0] for f in REVENUE_SCHEMA.split(", "))


def revenue_table(path: str) -> vs.Table:
    return vs.Table(path, REVENUE_SCHEMA, KEYS)


def classify_payload_rows(rows: DataFrame, rates: DataFrame, **kw) -> DataFrame:
    """Scanned rows (``payload`` map) → verdict, rate and USD value per row."""
    raw = (rows.withColumn("date_s", payload_field("date"))
           .withColumn("revenue_s", payload_field("revenue"))
           .withColumn("currency_s", payload_field("currency")))
    return classify_rows(raw, rates, **kw)


def revenue_rows(classified: DataFrame, loaded_at=None) -> DataFrame:
    """Accepted rows in the revenue table's shape, with deterministic ids; ``created_at`` is the clock given."""
    return (classified.where(F.col("reason").isNull())
            .select(revenue_id().alias("revenue_id"), "source_id", "file_date",
                    file_key("source_id", "file_date").alias("file_id"), "line_number",
                    "revenue_date", "original_value", "currency", "usd_value",
                    raw_payload_json(F.col("payload")).alias("raw_payload"),
                    F.lit(loaded_at).cast("timestamp").alias("created_at")))


def write_revenues(revenues: DataFrame, table_path: str, files: DataFrame | None = None) -> None:
    """L11+S7: replace exactly the rows of the given files (source_id, file_date), in one step.

    ``files`` names every file the load speaks for, so one that has no
    accepted row any more is cleared; without it, the files that occur in the
    rows. A reader sees the table before or after the load. Rows are not
    shuffled, and a task writes one file, however many files it read.
    """
    vs.write(revenue_table(table_path), revenues, files)


def read_revenues(spark: SparkSession, table_path: str) -> DataFrame:
    """The newest state of the revenue table."""
    return vs.read(spark, revenue_table(table_path))


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    """``DELETE … WHERE predicate`` as the rows that remain.

    SQL deletes a row only when the predicate is TRUE; rows where it is
    FALSE or NULL stay, hence the NULL-safe complement.
    """
    return df.where(~F.coalesce(predicate, F.lit(False)))
