"""Session construction and shared-folder helpers."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. Timestamps in the ledger are wall-clock
# values without zone, so the session zone is pinned to UTC.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Building a map from repeated keys keeps the last one, as a JSON object
    # decoded into a map does and as a CSV header with a repeated name does.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "revenue_engine", extra: dict | None = None) -> SparkSession:
    """Session for tests and local runs; on a cluster the caller passes its own."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = "8g"
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_session_settings(spark)
    return spark


def ensure_session_settings(spark: SparkSession) -> None:
    """Apply runtime SQL settings the operators depend on (idempotent)."""
    for k in ("spark.sql.session.timeZone", "spark.sql.sources.partitionOverwriteMode",
              "spark.sql.mapKeyDedupPolicy"):
        spark.conf.set(k, BASE_CONF[k])


@contextlib.contextmanager
def listing_parallelism(spark: SparkSession):
    """Size Spark's file listing job to the cluster.

    By default more than 32 folders are listed by a Spark job with up to
    10,000 tasks — one per folder of a per-source, per-day landing tree,
    which costs far more than the listing itself. Here the job has two tasks
    per core. Listing happens when the DataFrame is created; the previous
    setting is restored after.
    """
    conf = {
        "spark.sql.sources.parallelPartitionDiscovery.parallelism":
            str(max(8, 2 * spark.sparkContext.defaultParallelism)),
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    Read from the session; where it is unset, a local run creates a folder
    and registers it, so reliable ``checkpoint()`` works, and any other master
    is an error, since its executors share no local folder.
    """
    sc = spark.sparkContext
    cur = sc.getCheckpointDir()
    if cur:
        return cur
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="revenue-engine-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder."""
    base = shared_dir(spark)
    return os.path.join(base, "tables", f"{name}-{uuid.uuid4().hex[:12]}")


def stored(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage at a durable copy (a lost executor re-reads it) and gives the optimizer true sizes.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", codec).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored = (path,)
    return out


def drop_stored(*frames: DataFrame) -> None:
    """Delete the scratch tables behind ``frames``, once what was made of them is written."""
    for df in frames:
        for path in getattr(df, "_stored", ()):
            jpath = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            jpath.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(jpath, True)
