"""Distributed global ordering without funnelling rows into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def global_row_number(df: DataFrame, order_cols, name: str = "position",
                      num_partitions: int | None = None) -> DataFrame:
    """1-based position of every row in the total order ``order_cols``.

    ``row_number()`` over an unpartitioned window would pull every row into
    a single task. Instead the rows are range-partitioned and sorted within
    each partition, each partition's row count is computed, and a prefix
    sum over those counts (one row per partition, so the broadcast is
    bounded by the partition count) gives every partition its offset.
    The tagged rows are checkpointed so the counts and the positions come
    from the same materialisation even if a task is retried.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cols = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    tagged = (df.repartitionByRange(n, *cols).sortWithinPartitions(*cols)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_mid", F.monotonically_increasing_id()))
    from revenue_engine.session import shared_dir
    shared_dir(spark)
    tagged = tagged.checkpoint(eager=True)
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_m0"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    return (tagged.join(F.broadcast(offsets.select("_pid", "_off", "_m0")), "_pid")
            .withColumn(name, F.col("_off") + F.col("_mid") - F.col("_m0") + 1)
            .drop("_pid", "_mid", "_off", "_m0"))
