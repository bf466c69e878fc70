"""Keys dealt to groups.

A call into Python and a look into its state cost about as much as some dozen rows. A group therefore holds a share of the keys, its
bucket, instead of one key, and its state is kept by page, a share of the keys of the bucket: a call reads and writes a page once, and only
the pages of its keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PAGES = 16

_PLAIN = (T.StringType, T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_EXACT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
          "ignoreNullFields": "false"}


def id_type(kind: T.DataType) -> T.DataType:
    """Type of the ``id`` of keys of a type."""
    return kind if isinstance(kind, _PLAIN) else T.StringType()


def _id(key: Column, kind: T.DataType) -> Column:
    """A key as Python can tell it from others: the key itself, or its JSON, in which NaN equals itself as in groupings."""
    if isinstance(kind, _PLAIN):
        return key
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        key = key + F.lit(0).cast(kind)  # 0.0 for -0.0
    return F.when(key.isNotNull(), F.to_json(F.struct(key.alias("key")), _EXACT))


def key_of(id: Column, kind: T.DataType) -> Column:
    """The key with an ``id``."""
    if isinstance(kind, _PLAIN):
        return id
    return F.from_json(id, T.StructType([T.StructField("key", kind)]), _EXACT)["key"]


def dealt(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """``df`` with ``id``, ``page`` and ``bucket`` of the key in place of the column ``key``."""
    id = _id(F.col(key), df.schema[key].dataType)
    mixed = F.xxhash64("id")
    rest = [c for c in df.columns if c != key]
    return df.select(id.alias("id"), *rest).select(
        "id", F.pmod(F.shiftright(mixed, 32), F.lit(PAGES)).cast("int").alias("page"), *rest,
        F.pmod(mixed, F.lit(buckets)).cast("int").alias("bucket"))


def plain(value):
    """A value as state takes it: rows within become tuples."""
    if isinstance(value, dict):
        return tuple(plain(v) for v in value.values())
    if isinstance(value, tuple):
        return tuple(plain(v) for v in value)
    return [plain(v) for v in value] if isinstance(value, list) else value
