"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revenue_engine.session import scratch_path

# ASCII white space, the separators of every word rule in this subpackage.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the cluster-shared folder and read it back.

    Cuts the lineage at a durable copy, so a lost executor costs a re-read
    and never a recomputation, and gives the optimizer true sizes. Shuffle
    files of the write are deleted with its end.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_path = path
    for made in _SCOPES:
        made.add(path)
    return out


def drop_stored(df: DataFrame) -> None:
    """Delete the folder behind a ``stored`` table that nothing reads any more."""
    _delete(df.sparkSession, getattr(df, "_stored_path", None))


def _delete(spark: SparkSession, path: str | None) -> None:
    if path:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


_SCOPES: list[set[str]] = []


def stored_alone(spark: SparkSession, make: Callable[[], DataFrame], name: str) -> DataFrame:
    """``make()`` as a ``stored`` table; every table stored on the way to it is deleted once it is written.

    A failure deletes them as well.
    """
    made: set[str] = set()
    _SCOPES.append(made)
    kept = None
    try:
        out = stored(make(), name)
        kept = out._stored_path
        return out
    finally:
        _SCOPES.remove(made)
        for path in made - {kept}:
            _delete(spark, path)


@contextlib.contextmanager
def arrow_batches(spark: SparkSession, size: int):
    """Jobs run inside hand rows of large binaries to Python workers in batches of about ``size`` bytes."""
    with setting(spark, "spark.sql.execution.arrow.maxBytesPerBatch", str(size)):
        yield


@contextlib.contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """Jobs run inside see ``value`` for ``key``."""
    old = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, old)


def word_count(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def connected_components(edges: DataFrame, name: str) -> DataFrame:
    """(node, root) for every node of the undirected ``edges`` (a, b): long.

    Alternating large-star and small-star steps; every step is a grouped
    minimum joined back on its key, so the centre of a large component is
    spread by the skew join. Each round is written to the shared folder.
    Ends when a round changes nothing. The root is the smallest node.
    """
    cur = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                 .where("u <> v").distinct(), f"{name}-edges")
    seen = _signature(cur)
    while seen[0]:
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        large = stored(large, f"{name}-large")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        rest = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        nxt = stored(low.withColumnRenamed("m", "v").unionByName(rest).distinct(), f"{name}-small")
        drop_stored(cur)
        drop_stored(large)
        now = _signature(nxt)
        cur = nxt
        if now == seen:
            break
        seen = now
    roots = cur.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return cur.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _signature(edges: DataFrame) -> tuple[int, int]:
    # Wrapping sum of row hashes: equal edge sets give equal signatures.
    r = edges.agg(F.count(F.lit(1)).alias("n"),
                  F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return (r["n"], int(r["s"] or 0))
