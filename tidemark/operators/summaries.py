"""Summary tables the daily marts read: n-day and to-date."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import Day, iso
from tidemark.functions.periods import PERIODS, recent_days


def build_nd(daily: DataFrame, keys: Sequence[str], measures: Sequence[str], day: Day,
             periods: Sequence[int] = (7, 30), dt: str = "dt") -> DataFrame:
    """``<measure>_<n>d`` sums of a 1-day table over the periods ending at ``day``.

    One scan of the longest period, combined map-side per key.
    """
    longest = max(periods)
    window = daily.where(F.col(dt).between(F.lit(iso(day, 1 - longest)), F.lit(iso(day))))
    sums = []
    for n in periods:
        for m in measures:
            held = F.when(F.col(dt) >= F.lit(iso(day, 1 - n)), F.col(m)).otherwise(F.lit(0))
            sums.append(F.sum(F.col(m) if n == longest else held).alias(_nd_name(m, n)))
    return window.groupBy(*keys).agg(*sums).withColumn(dt, F.lit(iso(day)))


def _nd_name(measure: str, n: int) -> str:
    return f"{measure.removesuffix('_1d')}_{n}d"


def _last(date: str) -> Column:
    """Newest date. Compared as a date: the largest text would need a sort-based aggregate."""
    return F.max(F.col(date).cast("date")).cast("string").alias("login_date_last")


def build_td(logins: DataFrame, day: Day, user: str = "user_id", login_date: str = "dt") -> DataFrame:
    """Per user: last login date and login count over the whole history up to ``day``."""
    return (
        logins.where(F.col(login_date) <= F.lit(iso(day)))
        .groupBy(F.col(user).alias("user_id"))
        .agg(_last(login_date), F.count(F.lit(1)).alias("login_count_td"))
        .withColumn("dt", F.lit(iso(day)))
    )


def advance_td(yesterday: DataFrame, logins: DataFrame, day: Day, user: str = "user_id",
               login_date: str = "dt") -> DataFrame:
    """``build_td`` for ``day`` from the row of the day before and one day of logins: the
    history is not read again."""
    today = build_td(logins.where(F.col(login_date) == F.lit(iso(day))), day, user, login_date)
    columns = ["user_id", "login_date_last", "login_count_td"]
    return (
        yesterday.where(F.col("dt") == F.lit(iso(day, -1))).select(*columns)
        .unionByName(today.select(*columns))
        .groupBy("user_id")
        .agg(_last("login_date_last"), F.sum("login_count_td").alias("login_count_td"))
        .withColumn("dt", F.lit(iso(day)))
    )


def visitor_days(df: DataFrame, keys: Sequence[str], visitor: str, sums: Mapping[str, Column], dt: str = "dt") -> DataFrame:
    """A summary from which distinct visitors of any span of days can be counted: per day, ``keys`` and bucket of 32,768
    visitor numbers the set of visitors as a bitmap ``bits``, and the additive measures ``sums`` (aggregates) of their rows.

    Visitors are numbers, best without large gaps, as a bitmap takes 4 kB whoever is in it. A null visitor counts in the
    measures only. Combined map-side; nothing is shuffled but bitmaps and sums."""
    return df.groupBy(dt, *keys, F.bitmap_bucket_number(F.col(visitor)).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(F.col(visitor))).alias("bits"),
        *[c.alias(n) for n, c in sums.items()])


def visitors_in_periods(days: DataFrame, keys: Sequence[str], sums: Sequence[str], day: Day,
                        periods: Sequence[int] = PERIODS, dt: str = "dt") -> DataFrame:
    """Exact distinct visitors ``uv_count`` and the sums of ``visitor_days`` per period: bitmaps of the days are or-ed. Reads the
    partitions of the longest period of the summary, no rows it was made of."""
    joined = recent_days(days, day, periods, dt).groupBy("recent_days", *keys, "bucket").agg(
        F.bitmap_count(F.bitmap_or_agg("bits")).alias("_visitors"), *[F.sum(s).alias(s) for s in sums])
    return joined.groupBy("recent_days", *keys).agg(F.sum("_visitors").alias("uv_count"), *[F.sum(s).alias(s) for s in sums])
