"""Reusable warehouse patterns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.dates import Day, iso, later
from tidemark.functions.sizes import small_side
from tidemark.functions.timeline import ROWS_PER_SLICE, Timeline, previous, running_sum
from tidemark.session import written
from tidemark.sources.tables import replace_partitions, swap_table

OPEN_END = "9999-12-31"


def latest_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest row per key. An aggregate, not a window: it combines map-side, so a key with
    a third of all rows sends one candidate per map task."""
    newest = F.max_by(F.struct(*df.columns), F.struct(*order)).alias("_row")
    return df.groupBy(*key).agg(newest).select("_row.*")


def read_final(table: DataFrame, key: Sequence[str], version: Sequence[str],
               where: Column | None = None) -> DataFrame:
    """A table written at least once, read as if duplicates were already merged.

    ``where`` is applied first, to prune partitions before the merge; it must not separate
    versions of one key.
    """
    return latest_per_key(table if where is None else table.where(where), key, version)


def _opened(changes: DataFrame, day: Day, attributes: Sequence[str]) -> DataFrame:
    newest = latest_per_key(changes.where(F.col("dt") == F.lit(iso(day))), ["id"],
                            ["ts", "operate_time"])
    return newest.select("id", *attributes, F.lit(iso(day)).alias("start_date"),
                         F.lit(OPEN_END).alias("end_date"))


def _before(zip_table: DataFrame, day: Day, columns: Sequence[str]) -> DataFrame:
    """The rows open before the changes of ``day``: those opened earlier, and those an earlier run of ``day`` has closed."""
    yesterday = F.lit(iso(day, -1))
    was_open = (F.col("end_date") == OPEN_END) & (F.col("start_date") < F.lit(iso(day)))
    return zip_table.where(was_open | (F.col("end_date") == yesterday)).select(*columns)


def _step(zip_table: DataFrame, changes: DataFrame, day: Day, attributes: Sequence[str]) -> DataFrame:
    """Open rows after ``day``, and those it closes. The day's changes are worked out once and kept; the history is joined with
    their ids, which are broadcast if they are few, and is then not shuffled."""
    new = written(_opened(changes, day, attributes), "opened")
    ids = small_side(new.select("id", F.lit(True).alias("_closes")))
    old = _before(zip_table, day, ["id", *attributes, "start_date"]).join(ids, "id", "left")
    end = F.when(F.col("_closes"), F.lit(iso(day, -1))).otherwise(F.lit(OPEN_END))
    return old.withColumn("end_date", end).drop("_closes").unionByName(new).withColumn("dt", F.col("end_date"))


def scd2_apply(zip_table: DataFrame, changes: DataFrame, day: Day,
               attributes: Sequence[str] = ("create_time", "operate_time")) -> DataFrame:
    """One day of changes applied to the open rows of a history table.

    Reads the open partition and that of the day before, and returns the new content of both, with
    ``dt = end_date``. ``changes``: id, attributes, ts, dt. Days are applied in order. The last one may be
    run again, with the same or corrected changes: rows it had opened are dropped and rows it had closed are
    open again before its changes are applied.
    """
    near = zip_table.where(F.col("dt").isin(OPEN_END, iso(day, -1)))
    return _step(near, changes, day, attributes)


def scd2_rebuild(zip_table: DataFrame, changes: DataFrame, day: Day,
                 attributes: Sequence[str] = ("create_time", "operate_time")) -> DataFrame:
    """The same step over the whole history table, for ``swap_table``: rows closed before are kept as they are. May be run
    again on its own output."""
    columns = ["id", *attributes, "start_date", "end_date"]
    closed = zip_table.where(F.col("end_date") < F.lit(iso(day, -1))).select(*columns)
    return closed.withColumn("dt", F.col("end_date")).unionByName(_step(zip_table, changes, day, attributes))


def scd2_publish(result: DataFrame, path: str, day: Day | None = None) -> None:
    """Write ``scd2_apply`` output for ``day`` over the two partitions it stands for, in one step for readers of the published
    table (``read_current``); without a day, the whole table as it is first loaded."""
    if day is None:
        swap_table(result, path, "dt")
    else:
        replace_partitions(result, path, "dt", [OPEN_END, iso(day, -1)])


def max_concurrency(intervals: DataFrame, key: str, start: str, end: str, name: str = "max_user_count",
                    rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Largest number of intervals open at once per key; events of one instant net out.

    Changes are summed per (key, instant) map-side; the running sum is cut by the number of instants, so
    that a hot key is spread however its intervals lie. An interval with no end stays open.
    """
    changes = (
        intervals.select(
            key, F.explode(F.array(F.struct(F.col(start).alias("at"), F.lit(1).alias("change")),
                                   F.struct(F.col(end).alias("at"), F.lit(-1).alias("change")))))
        .select(key, "col.*").where(F.col("at").isNotNull())
        .groupBy(key, "at").agg(F.sum("change").alias("change"))
    )
    # a key has at most two instants for each of its intervals
    twice = intervals.select(key, F.explode(F.array(F.lit(0), F.lit(1)))).select(key)
    level = Timeline(changes, [key], ["at"], rows_per_slice, counted=twice).running(_level=running_sum(F.col("change")))
    return level.rows.groupBy(key).agg(F.max("_level").alias(name))


def sessionize(views: DataFrame, user: str, ts: str, gap: float = 60,
               rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Adds ``session_id`` = ``<user>-<n>``; a gap of ``gap`` seconds or more starts session n."""
    kind = views.schema[ts].dataType
    starts = F.col("_before").isNull() | (F.col(ts) >= later(F.col("_before"), gap, kind))
    line = (
        Timeline(views, [user], [ts], rows_per_slice)
        .running(_before=previous(F.col(ts)))
        .derive(_starts=F.when(starts, 1).otherwise(0))
        .running(_session=running_sum(F.col("_starts")))
    )
    return (
        line.rows
        .withColumn("session_id", F.concat(F.col(user).cast("string"), F.lit("-"),
                                           F.col("_session").cast("string")))
        .drop("_before", "_starts", "_session")
    )


def longest_streak(logins: DataFrame, user: str, ts: str, tolerance: int = 1,
                   name: str = "max_recent_days") -> DataFrame:
    """Longest run of login days per user, ``tolerance`` missed days in a row allowed.

    Rows become distinct (user, day) pairs before any window, so a user has at most one row per
    calendar day however many events they have.
    """
    days = logins.select(user, F.to_date(ts).alias("_day")).distinct()
    by_day = Window.partitionBy(user).orderBy("_day")
    gap = F.datediff(F.col("_day"), F.lag("_day").over(by_day))
    flagged = days.withColumn("_break", F.when(gap > tolerance + 1, 1).otherwise(0))
    return (
        flagged.withColumn("_run", F.sum("_break").over(by_day))
        .groupBy(user, "_run")
        .agg((F.datediff(F.max("_day"), F.min("_day")) + 1).alias("_days"))
        .groupBy(user).agg(F.max("_days").alias(name))
    )


def covered_days(ranges: DataFrame, key: str, start: str, end: str,
                 name: str = "promotion_day_count") -> DataFrame:
    """Days covered by closed date ranges per key, each day once.

    Ranges with one start collapse to the longest before the window: they cover the same days,
    and a key is left with at most one row per calendar day.
    """
    longest = ranges.groupBy(key, F.col(start).cast("date").alias("_start")).agg(
        F.max(F.col(end).cast("date")).alias("_end"))
    reached = F.max("_end").over(
        Window.partitionBy(key).orderBy("_start").rowsBetween(Window.unboundedPreceding, -1))
    first = F.when(F.col("_reached").isNull() | (F.col("_start") > F.col("_reached")),
                   F.col("_start")).otherwise(F.date_add("_reached", 1))
    return (
        longest.withColumn("_reached", reached)
        .withColumn("_start", first)
        .where(F.col("_end") >= F.col("_start"))
        .groupBy(key)
        .agg(F.sum(F.datediff("_end", "_start") + 1).alias(name))
    )


def pivot_scores(scores: DataFrame, row: str, column: str, value: str,
                 values: Sequence[str]) -> DataFrame:
    """Long to wide: one column per listed value, 0 where there is none, ordered by ``row``.

    Naming the values saves the extra job Spark would run to find them.
    """
    return (
        scores.groupBy(row).pivot(column, list(values)).agg(F.sum(value))
        .na.fill(0, list(values)).orderBy(row)
    )


def explode_list(df: DataFrame, column: str, name: str) -> DataFrame:
    """One row per array element; rows with null or empty arrays vanish."""
    kept = [c for c in df.columns if c != column]
    return df.select(*kept, F.explode(column).alias(name))
