"""Cleaning and packing of vector tables for the search operators."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def clean_vectors(df: DataFrame, allow_zero: bool, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(id, v: array<double>): rows that take part, one for each id.

    Out go null ids and vectors, and vectors that are empty or hold a null or
    non-finite component; all-zero ones too unless ``allow_zero``. Rows that
    repeat an id count once, with the smallest of their vectors.
    """
    v = F.col(f"`{vec_col}`").cast("array<double>")

    def finite(x):
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    out = (df.select(F.col(f"`{id_col}`").cast("long").alias("id"), v.alias("v"))
           .where("id is not null and v is not null and size(v) > 0").where(F.forall("v", finite)))
    if not allow_zero:
        out = out.where(F.exists("v", lambda x: x != 0))
    return out.groupBy("id").agg(F.min("v").alias("v"))


def matrix(column, dim: int, dtype="<f8") -> np.ndarray:
    """Rows of packed vectors as one matrix."""
    return np.frombuffer(b"".join(column), dtype=dtype).reshape(-1, dim)


def padded(column, dim: int) -> np.ndarray:
    """Rows of lists as one matrix; shorter vectors are filled with zeros."""
    out = np.zeros((len(column), dim))
    for i, v in enumerate(column):
        out[i, :len(v)] = v
    return out
