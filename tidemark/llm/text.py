"""Words, keys and Arrow batches shared by the text operators.

A word is a run of bytes other than space and tab to carriage return. ``bytes.split()`` breaks at
exactly these six bytes, and ``bytes.lower()`` changes A-Z only, so words are cut on the UTF-8
bytes of a text.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Batches = Iterator[pa.RecordBatch]

#: Bytes between words, for SQL patterns.
WHITE = r"[ \t\n\x0B\f\r]"


BATCH_BYTES = "8m"


def small_batches(spark: SparkSession, size: str = BATCH_BYTES) -> None:
    """Hand texts to Python in batches of 8 MB rather than 64: an executor holds several of them per core. A setting of the
    session, for jobs over long texts; results do not depend on it."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def trim() -> None:
    """Give the memory that was freed back to the system. A Python worker stays for later tasks, and so would its memory."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not the GNU C library
        pass


def utf8(batch: pa.RecordBatch, column: str = "text") -> Iterator[bytes]:
    """The texts of a batch as bytes, a few at a time; null is empty."""
    values = batch.column(column)
    if not pa.types.is_binary(values.type):
        values = values.cast(pa.binary())
    for at in range(0, len(values), 256):
        for value in values.slice(at, 256).to_pylist():
            yield value or b""


def row_key(df: DataFrame) -> Column:
    """A 64-bit key of a document row. Equal rows have equal keys."""
    return F.xxhash64("doc_id", "source", "text")


def crc_mod(column: str, n: int) -> Column:
    """crc32 of the column as text, modulo ``n``; that of the empty text for null."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % n


def without(df: DataFrame, names: Iterable[str]) -> list[str]:
    """Columns of ``df`` other than ``names``: an operator's own columns win over those it is given."""
    gone = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in gone]


def fields(df: DataFrame, names: Iterable[str]) -> list[T.StructField]:
    return [T.StructField(n, df.schema[n].dataType, True) for n in names]


def arrow_map(df: DataFrame, work: Callable[[pa.RecordBatch], dict[str, pa.Array | np.ndarray]],
              kept: list[str], added: str) -> DataFrame:
    """``df`` with its columns ``kept`` and the columns ``added`` (a DDL string) that ``work`` makes
    of each batch."""
    extra = T.StructType.fromDDL(added)
    schema = T.StructType(fields(df, kept) + list(extra.fields))

    def run(batches: Batches) -> Batches:
        for batch in batches:
            made = work(batch)
            arrays = [batch.column(c) for c in kept] + [pa.array(made[f.name]) for f in extra.fields]
            yield pa.RecordBatch.from_arrays(arrays, [*kept, *(f.name for f in extra.fields)])

    return df.mapInArrow(run, schema)
