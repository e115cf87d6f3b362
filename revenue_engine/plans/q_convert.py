"""Queries over the conversion core: verdicts, rate join, per-file stats."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revenue_engine.fixtures import fixture, with_fixtures
from revenue_engine.operators import convert as cv
from revenue_engine.plans.catalog import query
from revenue_engine.plans.oracle_sql import PARSED_CTE, sql_parse_amount, sql_parse_date


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = fixture(spark, sf_dir, "fx_raw_revenue")
    rates = fixture(spark, sf_dir, "fx_rates")
    return cv.classify_rows(raw, rates)


def _oracle(body: str) -> str:
    return with_fixtures(body, "fx_raw_revenue", "fx_rates", ctes=PARSED_CTE)


@query("convert_to_usd", _oracle("""
select source_id, file_date, line_number, revenue_date, original_value, currency, rate_to_usd,
       original_value * rate_to_usd as usd_value
from classified where reason is null"""))
def q_convert_to_usd(spark, sf_dir):
    """Flagship J1+T6: accepted rows with the exact-date rate and USD value."""
    return cv.accepted_rows(classified(spark, sf_dir))


# Fixed parameters of the documented ad-hoc queries (the reference's docs
# filter on "today"; the fixture clock's data ends in 2001, so a date inside
# the data range is used).
REPORT_DATE = "1997-07-15"


@query("parse_dates", with_fixtures(f"""
select o_orderkey, date_s, {sql_parse_date('date_s')} as revenue_date
from fx_raw_revenue""", "fx_raw_revenue"))
def q_parse_dates(spark, sf_dir):
    """Five zero-padded layouts, day-first before month-first, strict calendar."""
    from revenue_engine.functions.parsing import parse_date
    raw = fixture(spark, sf_dir, "fx_raw_revenue")
    return raw.select("o_orderkey", "date_s", parse_date("date_s").alias("revenue_date"))


@query("parse_amounts", with_fixtures(f"""
select o_orderkey, revenue_s, {sql_parse_amount('revenue_s')} as original_value
from fx_raw_revenue""", "fx_raw_revenue"))
def q_parse_amounts(spark, sf_dir):
    """Strict float text, no trimming or separators."""
    from revenue_engine.functions.parsing import parse_amount
    raw = fixture(spark, sf_dir, "fx_raw_revenue")
    return raw.select("o_orderkey", "revenue_s", parse_amount("revenue_s").alias("original_value"))


@query("row_verdicts", _oracle("""
select source_id, file_date, line_number, reason from classified"""))
def q_row_verdicts(spark, sf_dir):
    """T3+T4: every row with its first failing check (NULL = accepted)."""
    return classified(spark, sf_dir).select("source_id", "file_date", "line_number", "reason")


@query("rejected_rows", _oracle("""
select source_id, file_date, line_number, reason, date_s, revenue_s, currency_s
from classified where reason is not null"""))
def q_rejected_rows(spark, sf_dir):
    """T4: skipped rows with line number, reason and raw fields."""
    return cv.rejected_rows(classified(spark, sf_dir))


@query("file_stats", _oracle("""
select source_id, file_date,
       cast(count(*) filter (where reason is null) as bigint) as total_rows,
       cast(count(*) filter (where reason is not null) as bigint) as skipped_rows
from classified group by source_id, file_date"""))
def q_file_stats(spark, sf_dir):
    """A1: per file accepted (total_rows) and skipped rows."""
    return cv.file_stats(classified(spark, sf_dir))


@query("rejects_by_reason", _oracle("""
select source_id, reason, cast(count(*) as bigint) as n_rows
from classified where reason is not null group by source_id, reason"""))
def q_rejects_by_reason(spark, sf_dir):
    """Skipped rows per source and reason."""
    return cv.rejects_by_reason(classified(spark, sf_dir))


@query("missing_rates", _oracle("""
select currency, revenue_date as rate_date, cast(count(*) as bigint) as n_rows
from classified where reason = 'no_rate' group by currency, revenue_date"""))
def q_missing_rates(spark, sf_dir):
    """(currency, date) pairs needed by valid rows but absent from the rates."""
    return cv.missing_rates(classified(spark, sf_dir))


@query("raw_payload", _oracle("""
select source_id, file_date, line_number,
       replace(replace(replace(json_object('currency', currency_s, 'date', date_s, 'product', product,
                                           'revenue', revenue_s)::varchar,
               '&', '\\u0026'), '<', '\\u003c'), '>', '\\u003e') as raw_payload
from classified where reason is null"""))
def q_raw_payload(spark, sf_dir):
    """T5: accepted rows with all present columns as one JSON object (keys sorted)."""
    from revenue_engine.functions.payload import raw_payload_json
    c = classified(spark, sf_dir).where(F.col("reason").isNull())
    m = F.create_map(F.lit("date"), F.col("date_s"), F.lit("revenue"), F.col("revenue_s"),
                     F.lit("currency"), F.col("currency_s"), F.lit("product"), F.col("product"))
    return c.select("source_id", "file_date", "line_number", raw_payload_json(m).alias("raw_payload"))


@query("revenue_ids", _oracle("""
select sha256(concat_ws('|', source_id, cast(file_date as varchar), cast(line_number as varchar))) as revenue_id,
       source_id, file_date, line_number
from classified where reason is null"""))
def q_revenue_ids(spark, sf_dir):
    """Deterministic row ids, stable under replay."""
    from revenue_engine.functions.identity import revenue_id
    c = classified(spark, sf_dir).where(F.col("reason").isNull())
    return c.select(revenue_id().alias("revenue_id"), "source_id", "file_date", "line_number")


@query("revenues_on_date", _oracle(f"""
select source_id, file_date, line_number, revenue_date, original_value, currency, rate_to_usd,
       original_value * rate_to_usd as usd_value
from classified where reason is null and revenue_date = date '{REPORT_DATE}'"""))
def q_revenues_on_date(spark, sf_dir):
    """Revenues of one day."""
    return (cv.accepted_rows(classified(spark, sf_dir))
            .where(F.col("revenue_date") == F.lit(REPORT_DATE).cast("date")))


@query("verify_conversion", _oracle(f"""
select currency, original_value, cast(round(cast(original_value * rate_to_usd as decimal(38, 6)), 2) as decimal(18, 2)) as usd_rounded,
       product, line_number, source_id
from classified where reason is null and revenue_date >= date '{REPORT_DATE}' - interval 30 day
                                     and revenue_date <= date '{REPORT_DATE}'"""))
def q_verify_conversion(spark, sf_dir):
    """Currency, value, USD rounded to cents and the payload's product; newest first."""
    c = classified(spark, sf_dir).where(
        F.col("reason").isNull()
        & F.col("revenue_date").between(F.date_sub(F.lit(REPORT_DATE).cast("date"), 30),
                                        F.lit(REPORT_DATE).cast("date")))
    return (c.select("currency", "original_value",
                     F.round(F.col("usd_value").cast("decimal(38,6)"), 2).cast("decimal(18,2)").alias("usd_rounded"),
                     "product", "line_number", "source_id", "revenue_date")
            .orderBy(F.col("revenue_date").desc(), F.col("source_id"), F.col("line_number").desc())
            .drop("revenue_date"))


@query("rates_on_date", with_fixtures(f"""
select currency, rate_date, rate_to_usd from fx_rates where rate_date = date '{REPORT_DATE}'""", "fx_rates"))
def q_rates_on_date(spark, sf_dir):
    """The rates stored for one day."""
    return (fixture(spark, sf_dir, "fx_rates")
            .where(F.col("rate_date") == F.lit(REPORT_DATE).cast("date"))
            .select("currency", "rate_date", "rate_to_usd"))
