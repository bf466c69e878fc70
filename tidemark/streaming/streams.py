"""Sources, watermarks and combining of streams. Works on tables as well."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def event_stream(spark: SparkSession, path: str, schema: str | T.StructType, ts: str,
                 separator: str = ",", event_time: str = "et", max_files: int | None = None) -> DataFrame:
    """Lines of text files as typed rows; ``ts`` holds epoch seconds and becomes the event time
    ``event_time``. ``schema`` is declared, never inferred."""
    reader = spark.readStream.schema(schema).option("sep", separator)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.csv(path).withColumn(event_time, F.timestamp_millis(F.col(ts) * 1000))


def table_stream(spark: SparkSession, folder: str, name: str, schema: str | T.StructType,
                 max_files: int | None = None) -> DataFrame:
    """A parquet table, one file or a folder of them, read as a stream of its files."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    # a pattern, because a plain path must be a folder
    return reader.parquet(f"{folder.rstrip('/')}/{name}[.]parquet")


def watermark(df: DataFrame, ts: str, delay: str = "0 seconds") -> DataFrame:
    """Bounded out-of-orderness; a delay of zero expects time never to run back. A wall-clock
    column is read in the session time zone, as watermarks need an instant."""
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        df = df.withColumn(ts, F.col(ts).cast("timestamp"))
    return df.withWatermark(ts, delay)


def union_streams(*inputs: DataFrame, schema: str | T.StructType) -> DataFrame:
    """All rows of all inputs, each cast to ``schema`` first; duplicates are kept."""
    fields = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    typed = [df.select(*[F.col(f.name).cast(f.dataType) for f in fields]) for df in inputs]
    result = typed[0]
    for df in typed[1:]:
        result = result.unionByName(df)
    return result


def connect_map(first: DataFrame, second: DataFrame, map_first: Sequence[Column],
                map_second: Sequence[Column]) -> DataFrame:
    """Two differently typed inputs, each mapped by its own expressions to one output type."""
    return first.select(*map_first).unionByName(second.select(*map_second))
