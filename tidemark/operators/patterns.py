"""Event patterns per key, over finished tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import later
from tidemark.functions.timeline import ROWS_PER_SLICE, Timeline, following, recent


def consecutive_match(events: DataFrame, key: str, ts: str, matches: Column, times: int = 3,
                      rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """``times`` strictly adjacent matching events of a key; overlapping matches are all kept.

    Columns: key, ``match_times`` (oldest first).
    """
    held = F.coalesce(matches, F.lit(False))
    seen = F.struct(F.col(ts).alias("at"), F.col("_hit").alias("hit"))
    before = F.col("_recent")
    return (
        Timeline(events.select(key, ts, held.alias("_hit")), [key], [ts], rows_per_slice)
        .running(_recent=recent(seen, times - 1))
        .rows
        .where(F.col("_hit") & (F.size(before) == times - 1)
               & F.forall(before, lambda e: e["hit"]))
        .select(key, F.concat(F.transform(before, lambda e: e["at"]),
                              F.array(F.col(ts))).alias("match_times"))
    )


def sequence_within(events: DataFrame, key: str, ts: str, first: Column, second: Column,
                    within: float, interrupted: str = "drop",
                    rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """A ``first`` event immediately followed by a ``second`` one less than ``within`` seconds
    later is a match; one not followed by anything in that time is a timeout.

    Strict adjacency: another event in between ends the attempt silently, unless
    ``interrupted="timeout"`` asks for it to be reported as a timeout too.
    Columns: key, kind (``match`` / ``timeout``), first_ts, second_ts.
    """
    kind = events.schema[ts].dataType
    then = F.col("_next")
    in_time = F.col("_next").isNotNull() & (then["at"] < later(F.col(ts), within, kind))
    label = F.when(in_time & then["second"], F.lit("match"))
    label = label.when(~in_time | F.lit(interrupted == "timeout"), F.lit("timeout"))
    flagged = events.select(key, ts, F.coalesce(first, F.lit(False)).alias("_first"),
                            F.coalesce(second, F.lit(False)).alias("_second"))
    return (
        Timeline(flagged, [key], [ts], rows_per_slice)
        .running(_next=following(F.struct(F.col(ts).alias("at"), F.col("_second").alias("second"))))
        .rows.where("_first")
        .select(key, label.alias("kind"), F.col(ts).alias("first_ts"),
                F.when(label == "match", then["at"]).alias("second_ts"))
        .where(F.col("kind").isNotNull())
    )


def order_timeout(events: DataFrame, key: str, ts: str, create: Column, pay: Column,
                  within: float, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Every pay event is reported as ``paid``; a create event still open ``within`` seconds
    later is reported as ``timeout`` at that instant. A newer create replaces the open one and
    its timer. Other events are ignored. Columns: key, kind, at.
    """
    kind = events.schema[ts].dataType
    due = later(F.col(ts), within, kind)
    expired = F.col("_create") & (F.col("_next").isNull() | (F.col("_next") > due))
    flagged = (
        events.where(create | pay)
        .select(key, ts, F.coalesce(create, F.lit(False)).alias("_create"))
    )
    return (
        Timeline(flagged, [key], [ts], rows_per_slice)
        .running(_next=following(F.col(ts)))
        .rows
        .select(key,
                F.when(~F.col("_create"), F.lit("paid")).when(expired, F.lit("timeout")).alias("kind"),
                F.when(F.col("_create"), due).otherwise(F.col(ts)).alias("at"))
        .where(F.col("kind").isNotNull())
    )
