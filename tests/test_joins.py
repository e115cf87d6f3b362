"""Lookup joins beyond the broadcast bound: same rows, frequent keys split."""

from collections import Counter

from pyspark.sql import functions as F

from revenue_engine.operators import joins as jn


def test_frequent_keys_are_split(spark):
    n = 40_000
    key = F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise((F.col("id") * 2654435761 % 5000).cast("int"))
    big = spark.range(n).select("id", F.when(F.col("id") % 1001 != 5, key).alias("k"))
    small = spark.range(4000).select(F.col("id").cast("int").alias("k"), (F.col("id") * 10).alias("v"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = jn.split_join(big, small, ["k"], salts=16)
        sizes = [r["n"] for r in got.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
        plain = [r["n"] for r in big.join(small.hint("shuffle_merge"), ["k"], "left")
                 .groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
        want = Counter(map(tuple, big.join(small, ["k"], "left").select("id", "k", "v").collect()))
        assert Counter(map(tuple, got.select("id", "k", "v").collect())) == want
        inner = jn.split_join(big, small, ["k"], "inner").select("id", "k", "v")
        assert inner.count() == sum(1 for r in want if r[2] is not None)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    median = sorted(sizes)[len(sizes) // 2]
    assert max(plain) > 3 * sorted(plain)[len(plain) // 2] and max(sizes) < 3 * median


def test_both_bounds_are_checked(spark):
    wide = spark.range(50).select("id", F.repeat(F.lit("x"), 1000).alias("s"))
    assert jn.fits_broadcast(wide, 50, 100_000) and not jn.fits_broadcast(wide, 49) and not jn.fits_broadcast(wide, 50, 40_000)
