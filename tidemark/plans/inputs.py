"""Warehouse-shaped inputs derived from the test tables, as DataFrames and as SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import iso
from tidemark.operators.warehouse import sessionize
from tidemark.sources.tables import table

EVENTS_DAY = "2024-01-30"   # last day of events
EARLY_DAY = "1995-01-31"    # shortly after the first orders
MIDDLE_DAY = "1998-06-30"
LAST_DAY = "2001-08-01"     # last day of orders
VISIT_GAP = 1800            # seconds


def day_of(col: str) -> Column:
    return F.date_format(col, "yyyy-MM-dd")


def text(ts: str | Column) -> Column:
    """A timestamp as text, so that both engines compare it alike."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def sql_text(col: str) -> str:
    return f"strftime({col}, '%Y-%m-%d %H:%M:%S.%f')"


def events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").drop("props")


def kind(df: DataFrame, event_type: str) -> DataFrame:
    return df.where(F.col("event_type") == event_type)


VIEWS = f"""
lagged AS (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS prev FROM events),
marked AS (SELECT *, CASE WHEN prev IS NULL OR ts - prev >= INTERVAL {VISIT_GAP} SECOND THEN 1 ELSE 0 END AS starts
           FROM lagged),
views AS (SELECT user_id || '-' || sum(starts) OVER (PARTITION BY user_id ORDER BY ts) AS session_id,
                 user_id, user_id % 5 AS channel, event_type AS page_id, ts AS view_time,
                 strftime(ts, '%Y-%m-%d') AS dt
          FROM marked)"""


def views(spark: SparkSession, folder: str) -> DataFrame:
    seen = sessionize(events(spark, folder), "user_id", "ts", VISIT_GAP)
    return seen.select("session_id", "user_id", (F.col("user_id") % 5).alias("channel"),
                       F.col("event_type").alias("page_id"), F.col("ts").alias("view_time"),
                       day_of("ts").alias("dt"))


SESSIONS = VIEWS + """,
sessions AS (SELECT session_id, user_id AS mid_id, channel, min(dt) AS dt, count(*) AS page_count_1d,
                    (epoch_us(max(view_time)) - epoch_us(min(view_time))) // 1000 AS during_time_1d
             FROM views GROUP BY session_id, user_id, channel)"""


def sessions(spark: SparkSession, folder: str) -> DataFrame:
    length = F.timestamp_diff("MILLISECOND", F.min("view_time"), F.max("view_time"))
    return (
        views(spark, folder)
        .groupBy("session_id", F.col("user_id").alias("mid_id"), "channel")
        .agg(F.min("view_time").alias("_start"), F.count(F.lit(1)).alias("page_count_1d"),
             length.alias("during_time_1d"))
        .withColumn("dt", day_of("_start")).drop("_start")
    )


def logins(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_custkey").alias("user_id"), day_of("o_orderdate").alias("dt"))


LOGINS = """
logins AS (SELECT o_custkey AS user_id, strftime(o_orderdate, '%Y-%m-%d') AS dt FROM orders)"""


def register(spark: SparkSession, folder: str) -> DataFrame:
    first = table(spark, folder, "orders").groupBy(F.col("o_custkey").alias("user_id")).agg(
        F.min("o_orderdate").alias("_first"))
    return first.select("user_id", day_of("_first").alias("date_id"), day_of("_first").alias("dt"))


REGISTER = LOGINS + """,
register AS (SELECT user_id, min(dt) AS date_id FROM logins GROUP BY user_id)"""


def page_days(spark: SparkSession, folder: str) -> DataFrame:
    """One row per visitor, page and day."""
    return (
        events(spark, folder)
        .groupBy("user_id", F.col("event_type").alias("page_id"), day_of("ts").alias("dt"))
        .agg(F.count(F.lit(1)).alias("view_count_1d"))
    )


def recent_orders(spark: SparkSession, folder: str, day: str, days: int = 30) -> DataFrame:
    """Orders of the last ``days`` days. The test table is not partitioned by day, so the period
    is also stated on the stored column, where it reaches the scan."""
    first, after = (F.lit(iso(day, n)).cast("timestamp_ntz") for n in (1 - days, 1))
    date = F.col("o_orderdate")
    return table(spark, folder, "orders").where((date >= first) & (date < after))


def customer_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Changes of customers: each order is a new version of its customer."""
    orders = table(spark, folder, "orders")
    return orders.select(
        F.col("o_custkey").alias("id"), day_of("o_orderdate").alias("dt"),
        F.col("o_orderpriority").alias("create_time"), F.col("o_orderstatus").alias("operate_time"),
        F.col("o_orderkey").alias("ts"))


VERSIONS = """
versions AS (SELECT o_custkey AS id, strftime(o_orderdate, '%Y-%m-%d') AS dt, o_orderpriority AS create_time,
                    o_orderstatus AS operate_time, o_orderkey AS ts FROM orders),
newest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id, dt ORDER BY ts DESC) AS rn FROM versions)
           WHERE rn = 1),
zip AS (SELECT id, create_time, operate_time, dt AS start_date,
               coalesce(strftime(CAST(lead(dt) OVER (PARTITION BY id ORDER BY dt) AS DATE) - INTERVAL 1 DAY,
                                 '%Y-%m-%d'), '9999-12-31') AS end_date
        FROM newest WHERE dt < '{before}')"""
