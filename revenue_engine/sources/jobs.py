"""Job records (S6): pending-file jobs as JSON and back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

JOB_SCHEMA = "file_id string, source_id string, file_path string"


def encode_jobs(files: DataFrame, path_col: str = "file_path") -> DataFrame:
    """``job_json`` = ``{"file_id":..,"source_id":..,"file_path":..}``."""
    return files.withColumn("job_json", F.to_json(F.struct(
        "file_id", "source_id", F.col(path_col).alias("file_path"))))


def decode_jobs(jobs: DataFrame, json_col: str = "job_json") -> DataFrame:
    """Decoded job fields; ``job_error`` is set for malformed or incomplete records."""
    j = F.from_json(F.col(json_col), JOB_SCHEMA)
    out = jobs.withColumn("_j", j)
    bad = (F.col("_j").isNull() | F.col("_j.file_id").isNull() | F.col("_j.source_id").isNull()
           | F.col("_j.file_path").isNull())
    return (out.select(*[c for c in jobs.columns], F.col("_j.file_id").alias("job_file_id"),
                       F.col("_j.source_id").alias("job_source_id"),
                       F.col("_j.file_path").alias("job_file_path"),
                       F.when(bad, F.lit("malformed_job")).alias("job_error")))
