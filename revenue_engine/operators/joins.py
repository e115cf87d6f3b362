"""Lookup joins with a checked broadcast and a shuffle fallback."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revenue_engine.session import stored

# A lookup side is broadcast only when it is within both bounds.
DEFAULT_MAX_BROADCAST_ROWS = 2_000_000
MAX_BROADCAST_BYTES = 256 << 20
# A key is frequent if it holds more than this share of a shuffle partition's even part of the rows.
FREQUENT = 0.5
SALTS = 16


def fits_broadcast(small: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """True when ``small`` is within both bounds, counted over all its rows (partial sums, no rows are moved)."""
    width = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in small.columns])))
    r = small.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()
    return r["n"] <= max_rows and r["bytes"] <= max_bytes


def split_join(big: DataFrame, small: DataFrame, on: list[str], how: str = "left", salts: int = SALTS) -> DataFrame:
    """A shuffle join in which the rows of frequent keys are dealt over ``salts`` partitions.

    A count per key (pre-aggregated in the tasks) finds the frequent keys:
    fewer than two for each shuffle partition, whatever the data. Only their
    rows of ``small`` are repeated, once for each salt; all other keys are
    joined as they are. Same rows as a plain join.
    """
    if how not in ("left", "inner"):
        raise ValueError("rows of the repeated side must not be kept for themselves")
    parts = int(big.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = big.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n")).first()[0] or 0
    frequent = stored(counts.where(F.col("_n") > max(1.0, FREQUENT * total / parts)).select(*on, F.lit(True).alias("_hot")), "join-frequent")
    hot = F.broadcast(frequent)  # under 2 * parts rows
    salt = F.when(F.col("_hot"), F.pmod(F.monotonically_increasing_id(), F.lit(salts))).otherwise(F.lit(0)).cast("int")
    left = big.join(hot, on, "left").withColumn("_salt", salt).drop("_hot")
    every = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = small.join(hot, on, "left").withColumn("_salt", F.explode(every)).drop("_hot")
    return left.join(right.hint("shuffle_merge"), [*on, "_salt"], how).drop("_salt")


def lookup_join(big: DataFrame, small: DataFrame, on, how: str = "left",
                max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Join a large fact side to a lookup side.

    When the lookup side passes the size check it is broadcast, so the fact
    side is never shuffled. Otherwise it is a shuffle join that splits
    frequent keys, where ``on`` names columns and the fact side can be counted
    beforehand, as a stream cannot. All ways give the same rows.
    """
    if fits_broadcast(small, max_rows):
        return big.join(F.broadcast(small), on, how)
    if not big.isStreaming and isinstance(on, (list, tuple)) and all(isinstance(c, str) for c in on):
        return split_join(big, small, list(on), how)
    return big.join(small, on, how)
