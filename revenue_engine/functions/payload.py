"""Raw payload (T5): every present CSV column as one JSON object."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sorted_map(m) -> Column:
    m = F.col(m) if isinstance(m, str) else m
    return F.map_from_entries(F.array_sort(F.map_entries(m)))


def raw_payload_json(m) -> Column:
    """JSON text with keys in sorted order and HTML-safe escapes.

    Matches the common encoding of a string map: keys sorted, and the
    characters < > & plus U+2028 / U+2029 written as \\u escapes. These
    characters can only occur inside JSON strings, so replacing them in
    the finished text is exact.
    """
    j = F.to_json(sorted_map(m))
    for ch, esc in (("&", "\\u0026"), ("<", "\\u003c"), (">", "\\u003e"),
                    ("\u2028", "\\u2028"), ("\u2029", "\\u2029")):
        j = F.replace(j, F.lit(ch), F.lit(esc))
    return j
