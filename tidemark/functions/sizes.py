"""Broadcasts only after a look at the size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SMALL_ROWS = 1_000_000
SMALL_BYTES = 128 * 1024 * 1024


def small_side(df: DataFrame, max_rows: int = SMALL_ROWS, max_bytes: int = SMALL_BYTES) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``max_rows`` rows of at most ``max_bytes``
    together (measured as text), else ``df`` itself. For tables only.

    One pass that ends after ``max_rows + 1`` rows, however large the table. Use it where the plan must
    not depend on statistics; elsewhere Spark's own threshold does.
    """
    size = F.sum(F.octet_length(F.to_json(F.struct(*df.columns))))
    rows, size = df.limit(max_rows + 1).agg(F.count(F.lit(1)), size).first()
    return F.broadcast(df) if rows <= max_rows and (size or 0) <= max_bytes else df
