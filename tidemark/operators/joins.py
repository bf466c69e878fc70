"""Batch joins, including the batch results of stream joins."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.dates import later, place_of
from tidemark.functions.sizes import SMALL_BYTES, SMALL_ROWS, small_side  # noqa: F401
from tidemark.functions.timeline import ROWS_PER_SLICE, Timeline, latest, previous, running_sum
from tidemark.session import written


def regular_join(left: DataFrame, right: DataFrame, keys: Sequence[str],
                 how: str = "inner") -> DataFrame:
    """Equi join, ``inner``, ``left``, ``right`` or ``full``.

    The physical join is left to Spark: it broadcasts a side it has measured to be small, and
    otherwise sort-merges, where adaptive execution splits the partitions of a hot key.
    """
    return left.join(right, list(keys), how)


def lookup_join(facts: DataFrame, dim: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Rows enriched from a dimension. ``facts`` may be a stream.

    Nothing is hinted: Spark copies the dimension to every executor when the size of its files or, at run
    time, of its shuffle is below the broadcast threshold, and shuffles otherwise. A stream plans
    every micro-batch anew, so the choice follows the dimension as it grows.
    """
    return facts.join(dim, list(keys), how)


def table_function_join(left: DataFrame, rows: DataFrame) -> DataFrame:
    """Each left row joined to the rows a table function yields for it, for example
    ``spark.tvf.explode(F.split(F.col("text").outer(), " "))``.

    To keep left rows for which it yields none, use an ``_outer`` function: Spark turns a left
    lateral join over a plain generator into an inner one.
    """
    return left.lateralJoin(rows)


def prefixed(df: DataFrame, *but: str) -> DataFrame:
    """Columns renamed ``right_*``, except those named in ``but``."""
    return df.select(*[F.col(c) if c in but else F.col(c).alias(f"right_{c}") for c in df.columns])


def with_window(df: DataFrame, ts: str, size: str, slide: str | None = None) -> DataFrame:
    return df.withColumn("window", F.window(ts, size, slide))


def window_join(left: DataFrame, right: DataFrame, key: str, ts: str, size: str,
                slide: str | None = None) -> DataFrame:
    """Inner join on equal key and same tumbling or sliding window.

    Columns of ``right`` other than the key get the prefix ``right_``. The window is part of the
    join key, so a hot key is spread over its windows.
    """
    mine, theirs = (with_window(df, ts, size, slide) for df in (left, right))
    return mine.join(prefixed(theirs, key, "window"), [key, "window"])


def _row_type(df: DataFrame) -> T.StructType:
    return df.select(F.struct(*df.columns)).schema[0].dataType


def side_by_side(left: DataFrame, right: DataFrame, *shared: str) -> DataFrame:
    """Both inputs as one: the ``shared`` columns, ``_side`` (``l`` / ``r``) and the whole row in
    ``_left`` or ``_right``."""
    return left.select(
        *shared, F.lit("l").alias("_side"), F.struct(*left.columns).alias("_left"),
        F.lit(None).cast(_row_type(right)).alias("_right"),
    ).unionByName(right.select(
        *shared, F.lit("r").alias("_side"), F.lit(None).cast(_row_type(left)).alias("_left"),
        F.struct(*right.columns).alias("_right")))


def session_window_join(left: DataFrame, right: DataFrame, key: str, ts: str, gap: float,
                        rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Inner join on equal key and same session, where sessions are formed over the rows of both
    sides together: a pause longer than ``gap`` seconds starts the next one. The sessions are worked out
    once and kept in the scratch folder, from where both sides are read."""
    kind = left.schema[ts].dataType
    pause = F.col("_before").isNotNull() & (F.col(ts) > later(F.col("_before"), gap, kind))
    line = (
        Timeline(side_by_side(left, right, key, ts), [key], [ts], rows_per_slice)
        .running(_before=previous(F.col(ts)))
        .derive(_starts=F.when(pause, 1).otherwise(0))
        .running(session=running_sum(F.col("_starts")))
    )
    rows = written(line.rows.select("session", "_side", "_left", "_right"), "sessions")
    mine = rows.where(F.col("_side") == "l").select("session", "_left.*")
    theirs = rows.where(F.col("_side") == "r").select("session", "_right.*")
    return mine.join(prefixed(theirs, key, "session"), [key, "session"])


def interval_join(left: DataFrame, right: DataFrame, key: str, ts: str, lower: float,
                  upper: float) -> DataFrame:
    """Inner join on equal key and right time in the closed ``[left + lower, left + upper]``
    (seconds). Columns of ``right`` other than the key get the prefix ``right_``.

    Time is cut into cells as long as the interval. A left row sits in one cell, a right row is
    copied to the two or three cells its partners can sit in, and the cell joins the equi-join
    key: a hot key is spread over time instead of meeting itself in one task.
    """
    kind = left.schema[ts].dataType
    cell = max(1, math.ceil(upper - lower))
    renamed = prefixed(right, key)
    rts = F.col(f"right_{ts}")

    def number(col: Column) -> Column:
        return F.floor(place_of(col, kind) / cell)

    cells = F.sequence(number(later(rts, -upper, kind)), number(later(rts, -lower, kind)))
    inside = rts.between(later(F.col(ts), lower, kind), later(F.col(ts), upper, kind))
    return (
        left.withColumn("_cell", number(F.col(ts)))
        .join(renamed.withColumn("_cell", F.explode(cells)), [key, "_cell"])
        .where(inside)
        .drop("_cell")
    )


def as_of_join(left: DataFrame, versions: DataFrame, key: str, ts: str, version_ts: str,
               how: str = "left", rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Each left row with the newest version of its key not later than it.

    Both sides go into one ordered timeline and the last version seen is carried along: one
    shuffle and no pairs, where a range join would build every earlier version first. Columns of
    ``versions`` other than the key get the prefix ``right_``. ``how``: ``left`` or ``inner``. A null key
    equals nothing.
    """
    keyed = F.col(key).isNotNull()
    names = [c for c in versions.columns if c != key]
    unkeyed = left.where(~keyed).select(*left.columns, *[
        F.lit(None).cast(versions.schema[c].dataType).alias(f"right_{c}") for c in names])
    left, versions = left.where(keyed), versions.where(keyed)
    both = (
        left.select(F.col(key).alias("_key"), F.col(ts).alias("_at"), F.lit(1).alias("_side"),
                    F.struct(*left.columns).alias("_row"),
                    F.lit(None).cast(_row_type(versions)).alias("_version"))
        .unionByName(versions.select(
            F.col(key).alias("_key"), F.col(version_ts).alias("_at"), F.lit(0).alias("_side"),
            F.lit(None).cast(_row_type(left)).alias("_row"),
            F.struct(*versions.columns).alias("_version")))
    )
    rows = (
        Timeline(both, ["_key"], ["_at", "_side"], rows_per_slice)
        .running(_seen=latest(F.col("_version")))
        .rows.where(F.col("_side") == 1)
    )
    if how == "inner":
        rows = rows.where(F.col("_seen").isNotNull())
    found = rows.select("_row.*", *[F.col("_seen")[c].alias(f"right_{c}") for c in names])
    return found if how == "inner" else found.unionByName(unkeyed)


def history_join(left: DataFrame, zip_table: DataFrame, key: str, ts: str,
                 rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Each left row with the history row valid on its day, ``start_date <= day <= end_date``.

    History rows of a key do not overlap, so the valid one can only be the newest started by
    that day: an as-of join, without pairing every row with every version of its key.
    """
    dated = left.withColumn("_day", F.col(ts).cast("date"))
    started = zip_table.withColumn("_start", F.col("start_date").cast("date"))
    found = as_of_join(dated, started, key, "_day", "_start", "inner", rows_per_slice)
    valid = F.date_format("_day", "yyyy-MM-dd") <= F.col("right_end_date")
    return found.where(valid).drop("_day", "right__start")


def outer_join_changelog(left: DataFrame, right: DataFrame, key: str, seq: str,
                         how: str = "left") -> DataFrame:
    """The ordered change log of an unbounded join of two append-only inputs.

    ``seq`` is the arrival order over both inputs. A preserved row arriving before any partner
    is emitted padded with nulls (+I), withdrawn (-D) when its first partner arrives and replaced
    by the full row (+I). Columns: op, at (arrival that caused it), step (order within one
    arrival: -D before +I), key, then the values of each side, those of ``right`` prefixed.

    Whether a row was padded depends only on the earliest partner of its key, so no window is
    needed: pairs from one equi join, paddings from a join with one aggregated row per key.
    """
    if how not in ("inner", "left", "right", "full"):
        raise ValueError(how)
    mine = [c for c in left.columns if c != key]
    theirs = [f"right_{c}" for c in right.columns if c != key]
    other = prefixed(right, key)

    def log(rows: DataFrame, op: str, at: Column, step: int) -> DataFrame:
        return rows.select(F.lit(op).alias("op"), at.alias("at"), F.lit(step).alias("step"), key,
                           *[F.col(c) for c in mine + theirs])

    both_at = F.greatest(F.col(seq), F.col(f"right_{seq}"))
    result = log(left.join(other, key), "+I", both_at, 1)
    sides = []
    if how in ("left", "full"):
        sides.append((left, seq, other, f"right_{seq}", theirs))
    if how in ("right", "full"):
        sides.append((other, f"right_{seq}", left, seq, mine))
    for kept, kept_seq, partner, partner_seq, missing in sides:
        kinds = dict(partner.dtypes)
        nothing = {c: F.lit(None).cast(kinds[c]) for c in missing}
        keyed = F.col(key).isNotNull()
        first = partner.where(keyed).groupBy(key).agg(F.min(partner_seq).alias("_first"))
        padded = (
            kept.where(keyed).join(first, key, "left")
            .where(F.col("_first").isNull() | (F.col("_first") > F.col(kept_seq)))
            .withColumns(nothing)
        )
        changes = F.array(
            F.struct(F.lit("+I").alias("op"), F.col(kept_seq).alias("at"), F.lit(1).alias("step")),
            F.struct(F.lit("-D").alias("op"), F.col("_first").alias("at"), F.lit(0).alias("step")))
        result = result.unionByName(
            padded.withColumn("_change", F.explode(changes))
            .where(F.col("_change.at").isNotNull())
            .select("_change.*", key, *mine, *theirs))
        # rows without a key have no partner, ever; kept apart, they need no shuffle, and the
        # other rows are shuffled once for pairs and paddings
        lone = kept.where(~keyed).withColumns(nothing)
        result = result.unionByName(log(lone, "+I", F.col(kept_seq), 1))
    return result
