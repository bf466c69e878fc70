"""Parquet tables: plain, partitioned by day, and published in versions.

A published table keeps each load in a folder of its own, ``load=<name>/<by>=<value>``, that is never changed. Which load holds the rows
of a partition is said by the newest line of ``_pointer``, written when the load is complete. Readers follow it, so a
writer that stops between any two steps leaves the table as it was, and may be run again; what it writes may be read from
the table it replaces. One writer at a time. Loads that the newest line no longer names are left to the owner of the folder to clear.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.dates import Day, iso

POINTER = "version long, by string, loads map<string,string>, kind string"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def read_days(spark: SparkSession, path: str, first: Day, last: Day, dt: str = "dt") -> DataFrame:
    """Days ``first..last`` of a table partitioned by day, plain or published; other folders are not listed as input."""
    newest = _newest(spark, path)
    inside = F.col(dt).between(F.lit(iso(first)), F.lit(iso(last)))
    if newest is not None:
        return _rows(spark, path, newest, lambda day: iso(first) <= day <= iso(last))
    return spark.read.parquet(path).withColumn(dt, F.col(dt).cast("string")).where(inside)


def overwrite_partitions(df: DataFrame, path: str, by: str) -> None:
    """Replace exactly the partitions present in ``df`` of a plain table; running it twice changes nothing.

    The rebalance lets adaptive execution write one file for a small report and several for a
    large one, without folding the computation before it into one task.
    """
    (
        df.hint("rebalance", F.col(by))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(by).parquet(path)
    )


def _newest(spark: SparkSession, path: str):
    """The newest line of a published table's pointer, None where there is no such table."""
    try:
        lines = spark.read.schema(POINTER).json(f"{path.rstrip('/')}/_pointer")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return lines.orderBy(F.desc("version")).first()


def _rows(spark: SparkSession, path: str, newest, wanted=lambda value: True) -> DataFrame:
    root = path.rstrip("/")
    schema = T.StructType.fromJson(json.loads(newest["kind"]))
    parts = [f"{root}/load={load}/{newest['by']}={value}" for value, load in sorted(newest["loads"].items()) if wanted(value)]
    if not parts:
        return spark.createDataFrame([], schema)
    stored = T.StructType([*schema.fields, T.StructField("load", T.StringType())])
    return spark.read.schema(stored).option("basePath", root).parquet(*parts).select(*schema.names)


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """A published table as of its newest version."""
    newest = _newest(spark, path)
    if newest is None:
        raise ValueError(f"no published table at {path}")
    return _rows(spark, path, newest)


def _load(df: DataFrame, path: str, by: str) -> dict[str, str]:
    """Write a load; the partitions it has, each with the name of the load."""
    name = uuid.uuid4().hex
    folder = f"{path.rstrip('/')}/load={name}"
    df.hint("rebalance", F.col(by)).write.partitionBy(by).parquet(folder)
    written = df.sparkSession.read.schema(df.schema).parquet(folder)
    return {r[0]: name for r in written.select(F.col(by).cast("string")).distinct().collect()}


def _point(spark: SparkSession, path: str, version: int, by: str, loads: dict[str, str], schema: T.StructType) -> None:
    """Add a line to the pointer: one small file that appears as a whole."""
    line = spark.createDataFrame([(version, by, loads, schema.json())], POINTER)
    line.coalesce(1).write.mode("append").json(f"{path.rstrip('/')}/_pointer")


def replace_partitions(df: DataFrame, path: str, by: str, values: Sequence[str]) -> None:
    """Make ``df`` the content of exactly the partitions ``values`` of a published table, also of those it has no rows for, in
    one step for its readers."""
    spark = df.sparkSession
    newest = _newest(spark, path)
    df = df.withColumn(by, F.col(by).cast("string")).where(F.col(by).isin(list(values)))
    loads = {v: load for v, load in (newest["loads"] if newest else {}).items() if v not in values} | _load(df, path, by)
    _point(spark, path, newest["version"] + 1 if newest else 0, by, loads, df.schema)


def swap_table(df: DataFrame, path: str, by: str) -> None:
    """Make ``df`` the whole content of a published table, partitioned by ``by``, in one step for its readers."""
    newest = _newest(df.sparkSession, path)
    df = df.withColumn(by, F.col(by).cast("string"))
    _point(df.sparkSession, path, newest["version"] + 1 if newest else 0, by, _load(df, path, by), df.schema)


def publish(mart: DataFrame, path: str, day: Day) -> None:
    """Load one day of a mart into a published table. Earlier days stay as they are; a rerun replaces the day, also by nothing."""
    replace_partitions(mart.withColumn("dt", F.lit(iso(day))), path, "dt", [iso(day)])
