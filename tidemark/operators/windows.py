"""Event-time windows over finished tables: the results the streaming operators converge to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.dates import later
from tidemark.functions.timeline import ROWS_PER_SLICE, Timeline, max_before
from tidemark.operators.joins import interval_join, side_by_side
from tidemark.session import written


def windowed(df: DataFrame, ts: str, size: str, slide: str | None = None) -> DataFrame:
    """Adds ``window_start`` and ``window_end``."""
    span = F.window(ts, size, slide)
    return (
        df.withColumn("_window", span)
        .withColumns({"window_start": F.col("_window.start"), "window_end": F.col("_window.end")})
        .drop("_window")
    )


def with_watermark_at_arrival(df: DataFrame, ts: str, arrival: Sequence[str], delay: float,
                              rows_per_slice: int = ROWS_PER_SLICE,
                              inputs: Sequence[Column] = ()) -> DataFrame:
    """Adds ``watermark``: what an event-time clock showed when the row arrived, the largest
    time on earlier arrivals less ``delay`` seconds (null before the first).

    With several ``inputs`` (one condition each) every input keeps its own clock and the
    smallest counts. The arrival order runs over the whole table; it is cut into slices like a
    hot key, so no task sees all of it.
    """
    kind = df.schema[ts].dataType
    each = list(inputs) or [F.lit(True)]
    line = Timeline(df, [], arrival, rows_per_slice).running(**{
        f"_clock{i}": max_before(F.when(cond, F.col(ts))) for i, cond in enumerate(each)})
    clocks = [F.col(f"_clock{i}") for i in range(len(each))]
    started = clocks[0].isNotNull()
    for clock in clocks[1:]:
        started = started & clock.isNotNull()
    lowest = F.least(*clocks) if len(clocks) > 1 else clocks[0]
    return line.rows.withColumn("watermark", F.when(started, later(lowest, -delay, kind))).drop(
        *[f"_clock{i}" for i in range(len(each))])


def tumbling_count_late(df: DataFrame, key: str, ts: str, arrival: Sequence[str], size: str,
                        delay: float = 0, lateness: float = 5,
                        rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Counts per key and tumbling window, with late rows handled as they arrive.

    ``kind`` tells the outputs apart: ``main`` when the watermark passes the window end, ``again``
    with the new count for each row arriving in the ``lateness`` seconds after it, ``late`` for
    each row arriving later still (those are not counted; ``n`` is null). ``at`` is the time of
    the row for ``again`` and ``late``. One pass: the table is put in arrival order once and
    spread over (key, window) once.
    """
    kind = df.schema[ts].dataType
    seen = windowed(with_watermark_at_arrival(df, ts, arrival, delay, rows_per_slice), ts, size)
    closed = F.col("watermark") >= F.col("window_end")
    gone = F.col("watermark") >= later(F.col("window_end"), lateness, kind)
    group = [key, "window_start", "window_end"]
    by_arrival = Window.partitionBy(*group).orderBy(*arrival)
    rows = seen.withColumn(
        "_kind", F.when(gone, "late").when(closed, "again").otherwise("main")
    ).select(*group, F.col(ts).alias("_at"), "_kind",
             F.row_number().over(by_arrival).alias("_count"),
             F.lead("_kind").over(by_arrival).alias("_next"))
    # the clock only rises, so within a window main, again and late rows follow one another
    # and the row number is the count so far; the last main row stands for the firing
    fires = F.col("_next").isNull() | (F.col("_next") != "main")
    return rows.where((F.col("_kind") != "main") | fires).select(
        *group, F.col("_kind").alias("kind"),
        F.when(F.col("_kind") != "main", F.col("_at")).alias("at"),
        F.when(F.col("_kind") != "late", F.col("_count").cast("long")).alias("n"))


def hot_items(df: DataFrame, item: str, ts: str, size: str = "1 hour", slide: str = "5 minutes",
              n: int = 3) -> DataFrame:
    """The ``n`` most frequent items per sliding window, ties by item.

    Rows are counted per item and slide-long pane first and only the pane counts are copied into
    the windows covering them, so the twelvefold copy is paid on counts, not on rows. The rank
    filter is applied map-side. ``size`` must be a multiple of ``slide``.
    """
    panes = windowed(df, ts, slide).groupBy("window_start", item).agg(
        F.count(F.lit(1)).alias("_n"))
    counts = (
        panes.withColumnRenamed("window_start", "_pane")
        .groupBy(F.window("_pane", size, slide).alias("_window"), item)
        .agg(F.sum("_n").alias("view_count"))
        .select(F.col("_window.start").alias("window_start"),
                F.col("_window.end").alias("window_end"), item, "view_count")
    )
    best = Window.partitionBy("window_start", "window_end").orderBy(F.desc("view_count"), item)
    return counts.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= n)


def eager_window(df: DataFrame, key: str, ts: str, size: str, order: Sequence[str] = ()) -> DataFrame:
    """Each row emits the running count of its key and window (``kind = "running"``), each window
    its final count once (``kind = "final"``).

    The final row is emitted by the last row of the window, so both come from one shuffle.
    """
    group = [key, "window_start", "window_end"]
    rows = windowed(df, ts, size)
    by_time = Window.partitionBy(*group).orderBy(ts, *order)
    last = F.lead(F.lit(1)).over(by_time).isNull()
    kinds = F.when(F.col("_last"), F.array(F.lit("running"), F.lit("final"))).otherwise(
        F.array(F.lit("running")))
    return (
        rows.withColumns({"n": F.row_number().over(by_time), "_last": last})
        .select(*group, F.explode(kinds).alias("kind"), "n")
    )


def window_uv_exact(df: DataFrame, user: str, ts: str, size: str = "1 hour") -> DataFrame:
    """Distinct users per window. Two aggregates, (window, user) then window, so an hour with
    most of the traffic is spread over its users."""
    return (
        windowed(df, ts, size).where(F.col(user).isNotNull())
        .groupBy("window_start", "window_end").agg(F.countDistinct(user).alias("uv"))
    )


def window_uv_approx(df: DataFrame, user: str, ts: str, size: str = "1 hour",
                     rsd: float = 0.01) -> DataFrame:
    """Distinct users per window from a mergeable sketch of fixed size; ``rsd`` is its relative
    standard deviation."""
    return (
        windowed(df, ts, size)
        .groupBy("window_start", "window_end")
        .agg(F.approx_count_distinct(user, rsd).alias("uv"))
    )


def interval_join_late(left: DataFrame, right: DataFrame, key: str, ts: str, seq: str,
                       lower: float, upper: float, delay: float,
                       rows_per_slice: int = ROWS_PER_SLICE) -> dict[str, DataFrame]:
    """``interval_join`` where rows behind the watermark at their arrival go to side outputs.

    ``seq`` is the arrival order over both inputs; the watermark is the smaller of the two
    inputs' clocks. Returns ``matches``, ``left_late`` and ``right_late``.
    """
    clocked = with_watermark_at_arrival(
        side_by_side(left, right, seq, ts), ts, [seq], delay, rows_per_slice,
        inputs=[F.col("_side") == "l", F.col("_side") == "r"])
    late = F.col("_late")
    tagged = written(clocked.select("_side", "_left", "_right", F.coalesce(
        F.col(ts) < F.col("watermark"), F.lit(False)).alias("_late")), "tagged")

    def rows(side: str, which: Column) -> DataFrame:
        return tagged.where((F.col("_side") == side) & which).select(
            "_left.*" if side == "l" else "_right.*")

    return {
        "matches": interval_join(rows("l", ~late), rows("r", ~late), key, ts, lower, upper),
        "left_late": rows("l", late),
        "right_late": rows("r", late),
    }
