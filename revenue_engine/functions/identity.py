"""Deterministic identities (T10): replaying a file yields the same ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def file_key(source_id, file_date) -> Column:
    """Ledger id of the file of one source and day: ``<source_id>/<yyyy-MM-dd>``."""
    return F.concat_ws("/", F.col(source_id) if isinstance(source_id, str) else source_id,
                       (F.col(file_date) if isinstance(file_date, str) else file_date).cast("string"))


def revenue_id(source_id="source_id", file_date="file_date", line_number="line_number") -> Column:
    """SHA-256 hex of ``source_id|file_date|line_number``."""
    cols = [F.col(c) if isinstance(c, str) else c for c in (source_id, file_date, line_number)]
    return F.sha2(F.concat_ws("|", *[c.cast("string") for c in cols]), 256)
