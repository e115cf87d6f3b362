"""Rate payload scan (S4) with strict date validation.

A payload is one API response ``{"base": .., "date": "yyyy-MM-dd",
"rates": {"EUR": 0.92, ...}}`` where each rate is units of currency per USD.
Fetches land as JSON lines under ``<root>/fetch_seq=<n>/``; the fetch
number orders them for last-write-wins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PAYLOAD_SCHEMA = "base string, date string, rates map<string,double>"


def read_rate_payloads(spark: SparkSession, root: str) -> DataFrame:
    """Payload rows ``(fetch_seq, base, date, rates)`` from JSON-lines files."""
    return (spark.read.schema(PAYLOAD_SCHEMA + ", fetch_seq int")
            .option("mode", "PERMISSIVE").json(root))


def parse_rate_payloads(text: DataFrame, json_col: str = "payload") -> DataFrame:
    """The same rows from JSON text already in a DataFrame column."""
    p = F.from_json(F.col(json_col), PAYLOAD_SCHEMA)
    return text.select("*", p.alias("_p")).select(
        *[c for c in text.columns if c != json_col], "_p.base", "_p.date", "_p.rates")


def with_payload_date(payloads: DataFrame) -> DataFrame:
    """``rate_date`` is the strictly parsed ``date``; NULL rejects the payload."""
    d = F.when(F.col("date").rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.try_to_date("date", "yyyy-MM-dd"))
    return payloads.withColumn("rate_date", d)


def rejected_payloads(payloads: DataFrame) -> DataFrame:
    return with_payload_date(payloads).where(F.col("rate_date").isNull())


def explode_rates(payloads: DataFrame, keys=("fetch_seq",), keep_empty: bool = False) -> DataFrame:
    """One row per (payload, currency) of the valid payloads.

    With ``keep_empty`` a payload without rates gives one row with a null
    currency, so that its base row and counters are not lost downstream.
    """
    valid = with_payload_date(payloads).where(F.col("rate_date").isNotNull())
    return valid.select(*keys, "rate_date",
                        (F.explode_outer if keep_empty else F.explode)("rates").alias("currency", "api_rate"))


def encode_payloads(api_rows: DataFrame, keys=("fetch_seq",), base: str = "USD") -> DataFrame:
    """Inverse of ``explode_rates``: one JSON payload per (keys, rate_date).

    A payload holds one currency per entry, so each group is bounded by the
    number of currencies.
    """
    rates = F.map_from_entries(F.collect_list(F.struct("currency", "api_rate")))
    return (api_rows.groupBy(*keys, "rate_date")
            .agg(rates.alias("rates"))
            .select(*keys, F.to_json(F.struct(F.lit(base).alias("base"),
                                              F.date_format("rate_date", "yyyy-MM-dd").alias("date"),
                                              F.col("rates"))).alias("payload")))


def write_payloads(payloads: DataFrame, root: str) -> None:
    """Land payload text as JSON lines, one folder per fetch."""
    payloads.select("fetch_seq", F.col("payload").alias("value")).write.partitionBy("fetch_seq").text(root)
