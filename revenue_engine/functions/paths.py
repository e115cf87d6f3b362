"""Landing paths (T9): ``<dir>/<source name>/<yyyy-MM-dd>.<file_type>``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PATH_PATTERN = r"([^/]+)/([0-9]{4}-[0-9]{2}-[0-9]{2})\.([^./]+)$"


def landing_path(base_dir: str, name, file_date, file_type) -> Column:
    c = lambda x: F.col(x) if isinstance(x, str) else x
    return F.concat(F.lit(base_dir.rstrip("/") + "/"), c(name), F.lit("/"),
                    F.date_format(c(file_date), "yyyy-MM-dd"), F.lit("."), c(file_type))


def path_source_name(path) -> Column:
    return F.regexp_extract(F.col(path) if isinstance(path, str) else path, PATH_PATTERN, 1)


def path_file_date(path) -> Column:
    p = F.col(path) if isinstance(path, str) else path
    return F.try_to_date(F.regexp_extract(p, PATH_PATTERN, 2), "yyyy-MM-dd")


# Partition-folder layout written by Spark: ``.../source_id=<id>/file_date=<day>/<part file>``.
HIVE_PATTERN = r"source_id=([^/]+)/file_date=([0-9]{4}-[0-9]{2}-[0-9]{2})/[^/]+$"


def hive_source_id(path) -> Column:
    return F.regexp_extract(F.col(path) if isinstance(path, str) else path, HIVE_PATTERN, 1)


def hive_file_date(path) -> Column:
    p = F.col(path) if isinstance(path, str) else path
    return F.try_to_date(F.regexp_extract(p, HIVE_PATTERN, 2), "yyyy-MM-dd")
