"""Exchange-rate table maintenance."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revenue_engine.operators import versions as vs
from revenue_engine.session import drop_stored, stored

BASE_CURRENCY = "USD"


def invert_rates(api_rows: DataFrame, keys=("fetch_seq",)) -> DataFrame:
    """``rate_to_usd = 1 / api_rate``; zero rates are skipped, negatives pass.

    ``try_divide`` keeps the division safe wherever the optimizer places it
    relative to the filter (ANSI mode raises on a zero divisor).
    """
    return (api_rows.where(F.col("api_rate") != 0)
            .select(*keys, "rate_date", "currency",
                    F.try_divide(F.lit(1.0), F.col("api_rate")).alias("rate_to_usd")))


def incoming_rates(api_rows: DataFrame, seq_col: str = "fetch_seq") -> DataFrame:
    """Rows a fetch upserts, in write order.

    ``seq`` orders fetches; within one fetch the API's rows come first
    (``sub`` 0) and the forced base row ``(USD, 1.0)`` last (``sub`` 1), so
    it overrides whatever the API said about the base currency (L2).
    """
    inv = invert_rates(api_rows, (seq_col,)).select(
        "currency", "rate_date", "rate_to_usd", F.col(seq_col).cast("long").alias("seq"),
        F.lit(0).alias("sub"))
    base = (api_rows.select(F.col(seq_col).cast("long").alias("seq"), "rate_date").distinct()
            .select(F.lit(BASE_CURRENCY).alias("currency"), "rate_date",
                    F.lit(1.0).alias("rate_to_usd"), "seq", F.lit(1).alias("sub")))
    return inv.unionByName(base)


def upsert_rates(current: DataFrame, incoming: DataFrame) -> DataFrame:
    """L1: ``ON CONFLICT (currency, rate_date) DO UPDATE`` — last write wins.

    ``incoming`` carries ``seq``/``sub`` (see ``incoming_rates``); existing
    rows rank below every incoming row. A ``groupBy`` with ``max_by`` keeps
    one row per key with partial aggregation map-side; no key can hold more
    than one row per write, so there is no skew to split.
    """
    old = current.select("currency", "rate_date", F.col("rate_to_usd").cast("double"),
                         F.lit(-1).cast("long").alias("seq"), F.lit(0).alias("sub"))
    allrows = old.unionByName(incoming.select("currency", "rate_date", "rate_to_usd", "seq", "sub"))
    order = F.col("seq") * 2 + F.col("sub")
    return (allrows.groupBy("currency", "rate_date")
            .agg(F.max_by("rate_to_usd", order).alias("rate_to_usd")))


def touched_partitions(current: DataFrame, incoming: DataFrame) -> DataFrame:
    """Only the ``rate_date`` partitions an upsert rewrites."""
    dates = incoming.select("rate_date").distinct()
    return current.join(dates, "rate_date", "left_semi")


def rate_table(path: str) -> vs.Table:
    return vs.Table(path, "currency string, rate_date date, rate_to_usd double", ("rate_date",))


def merge_rates(spark: SparkSession, path: str, incoming: DataFrame) -> None:
    """L1 on a stored table: the days that ``incoming`` names are upserted and replaced in one step.

    Other days are neither read nor rewritten; a concurrent writer of the table makes this one fail whole.
    """
    table, base = rate_table(path), vs.snapshot(spark, rate_table(path))
    incoming = stored(incoming, "rates-incoming")
    current = touched_partitions(vs.read(spark, table, base), incoming)
    vs.write(table, upsert_rates(current, incoming), incoming, base)
    drop_stored(incoming)


def insert_absent(current: DataFrame, seed: DataFrame, keys=("currency", "rate_date")) -> DataFrame:
    """L3: ``ON CONFLICT DO NOTHING`` — seed rows whose key is absent are appended.

    Seed rows that repeat a key among themselves keep the first by ``seq``
    when present, else the smallest.
    """
    cols = current.columns
    new = seed.join(current.select(*keys), list(keys), "left_anti")
    rest = F.struct(*[c for c in cols if c not in keys])
    one = F.min_by(rest, "seq") if "seq" in seed.columns else F.min(rest)
    new = new.groupBy(*keys).agg(one.alias("_v")).select(*keys, "_v.*")
    return current.unionByName(new.select(*cols))


def rate_load_stats(api_rows: DataFrame, keys=("fetch_seq", "rate_date")) -> DataFrame:
    """A3: per fetch, rates received and rows upserted (non-zero rates plus the base row)."""
    # A payload without rates has one row with a null currency; a null rate reads as 0.
    rate = F.coalesce("api_rate", F.lit(0.0))
    return (api_rows.groupBy(*keys)
            .agg(F.count("currency").alias("rates_received"),
                 (F.count_if(rate != 0) + F.lit(1)).alias("rates_upserted"),
                 F.count_if(F.col("currency").isNotNull() & (rate == 0)).alias("rates_skipped")))
