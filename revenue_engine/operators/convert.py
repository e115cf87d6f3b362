"""Row verdicts, exact-date rate lookup and USD conversion."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revenue_engine.functions.parsing import (
    REASON_RATE, parse_amount, parse_date, reject_reason,
)
from revenue_engine.operators.joins import DEFAULT_MAX_BROADCAST_ROWS, lookup_join


def parse_fields(raw: DataFrame, date_col="date_s", revenue_col="revenue_s",
                 currency_col="currency_s") -> DataFrame:
    """Add ``revenue_date``, ``original_value``, ``currency`` and the pre-lookup reason."""
    return (raw
            .withColumn("revenue_date", parse_date(date_col))
            .withColumn("original_value", parse_amount(revenue_col))
            .withColumn("currency", F.coalesce(F.col(currency_col), F.lit("")))
            .withColumn("_pre_reason", reject_reason("revenue_date", "original_value", "currency")))


def classify_rows(raw: DataFrame, rates: DataFrame, date_col="date_s", revenue_col="revenue_s",
                  currency_col="currency_s", max_broadcast_rows=DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Every raw row with its parsed fields, rate, USD value and ``reason``.

    ``reason`` is NULL for accepted rows and otherwise names the first
    failing check (date, revenue, currency, rate). The rate lookup is an
    exact equality on (currency, rate_date = revenue_date); ``rates`` must
    hold one row per key (see ``operators.rates.upsert_rates``).
    """
    parsed = parse_fields(raw, date_col, revenue_col, currency_col)
    lookup = rates.select("currency", F.col("rate_date").alias("revenue_date"),
                          F.col("rate_to_usd").cast("double").alias("rate_to_usd"))
    joined = lookup_join(parsed, lookup, ["currency", "revenue_date"], "left", max_broadcast_rows)
    return (joined
            .withColumn("reason", F.coalesce(F.col("_pre_reason"),
                                             F.when(F.col("rate_to_usd").isNull(), F.lit(REASON_RATE))))
            .withColumn("usd_value", F.when(F.col("reason").isNull(),
                                            F.col("original_value") * F.col("rate_to_usd")))
            .drop("_pre_reason"))


ACCEPTED_COLUMNS = ("source_id", "file_date", "line_number", "revenue_date", "original_value",
                    "currency", "rate_to_usd", "usd_value")


def accepted_rows(classified: DataFrame, columns=ACCEPTED_COLUMNS) -> DataFrame:
    return classified.where(F.col("reason").isNull()).select(*columns)


def rejected_rows(classified: DataFrame, raw_columns=("date_s", "revenue_s", "currency_s")) -> DataFrame:
    """Skipped rows with line number and reason (the reference logs one warning each)."""
    return (classified.where(F.col("reason").isNotNull())
            .select("source_id", "file_date", "line_number", "reason", *raw_columns))


def convert_to_usd(raw: DataFrame, rates: DataFrame, **kw) -> DataFrame:
    """Flagship: accepted rows converted to USD (``usd = value * rate``)."""
    return accepted_rows(classify_rows(raw, rates, **kw))


def file_stats(classified: DataFrame, keys=("source_id", "file_date")) -> DataFrame:
    """A1: per file, accepted rows (``total_rows``) and skipped rows.

    A plain ``groupBy``: the partial aggregate runs map-side, so a file that
    holds a third of all rows still shuffles one row per task.
    """
    return (classified.groupBy(*keys)
            .agg(F.count_if(F.col("reason").isNull()).alias("total_rows"),
                 F.count_if(F.col("reason").isNotNull()).alias("skipped_rows")))


def rejects_by_reason(classified: DataFrame, keys=("source_id",)) -> DataFrame:
    """Skipped rows counted per key and reason."""
    return (classified.where(F.col("reason").isNotNull())
            .groupBy(*keys, "reason").agg(F.count(F.lit(1)).alias("n_rows")))


def missing_rates(classified: DataFrame) -> DataFrame:
    """(currency, date) pairs that rows needed but the rate table lacks."""
    return (classified.where(F.col("reason") == REASON_RATE)
            .groupBy("currency", F.col("revenue_date").alias("rate_date"))
            .agg(F.count(F.lit(1)).alias("n_rows")))
