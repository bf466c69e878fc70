"""Event-time windows over streams."""

from __future__ import annotations

import math
from collections.abc import Iterator
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.operators.windows import windowed
from tidemark.streaming.streams import watermark


def micros(ts: str | Column) -> Column:
    return F.unix_micros(F.col(ts) if isinstance(ts, str) else ts)


def instant(micros_column: str) -> Column:
    return F.timestamp_micros(F.col(micros_column))


def _flat(df: DataFrame) -> DataFrame:
    span = F.col("window")
    rest = [c for c in df.columns if c != "window"]
    return df.select(span["start"].alias("window_start"), span["end"].alias("window_end"), *rest)


def tumbling_count(df: DataFrame, key: str, ts: str, size: str, delay: str) -> DataFrame:
    """Count per key and window, combined before the shuffle. In ``update`` mode every
    micro-batch re-emits the windows it touched; in ``append`` mode a window is emitted once."""
    return _flat(
        watermark(df, ts, delay).groupBy(F.window(ts, size), key).agg(F.count(F.lit(1)).alias("n")))


def hot_items(df: DataFrame, item: str, ts: str, size: str = "1 hour", slide: str = "5 minutes",
              n: int = 3, delay: str = "0 seconds", shards: int = 64) -> DataFrame:
    """The ``n`` most frequent items per sliding window, emitted once it closes; ties by item.

    Rows are counted once, per item and pane of one slide; only pane counts are copied to the windows
    they lie in. A window's counts come out together when it closes; they are ranked within shards of items and the shards'
    best ``n`` then among each other, all by built-in aggregates, so the items of a window are spread over
    ``shards`` groups, as many as it has items if those are fewer. ``size`` is a multiple of ``slide``.
    """
    panes = watermark(df, ts, delay).groupBy(F.window(ts, slide), item).agg(F.count(F.lit(1)).alias("_n"))
    counts = panes.groupBy(F.window("window", size, slide), item).agg(F.sum("_n").alias("_score"))
    entry = F.struct((-F.col("_score")).alias("lost"), F.col(item).alias("item"))
    of_shard = counts.groupBy("window", F.pmod(F.xxhash64(item), F.lit(shards)).alias("_shard")).agg(
        _first(F.collect_list(entry), n).alias("_best"))
    best = of_shard.groupBy("window").agg(_first(F.flatten(F.collect_list("_best")), n).alias("_best"))
    ranked = best.select("window", F.posexplode("_best").alias("_at", "_one"))
    return _flat(ranked.select("window", F.col("_one.item").alias(item), (-F.col("_one.lost")).alias("view_count"),
                               (F.col("_at") + 1).cast("int").alias("rank")))


def _first(entries: Column, n: int) -> Column:
    return F.slice(F.array_sort(entries), 1, n)


def window_uv_exact(df: DataFrame, user: str, ts: str, size: str = "1 hour",
                    delay: str = "0 seconds") -> DataFrame:
    """Distinct users per window: (window, user) first, then the window, so state is spread over
    users and kept no longer than the window."""
    users = watermark(df, ts, delay).where(F.col(user).isNotNull()).groupBy(
        F.window(ts, size), user).agg(F.count(F.lit(1)).alias("_n"))
    return _flat(users.groupBy("window").agg(F.count(F.lit(1)).alias("uv")))


def window_uv_approx(df: DataFrame, user: str, ts: str, size: str = "1 hour", rsd: float = 0.01,
                     delay: str = "0 seconds") -> DataFrame:
    """Distinct users per window from one fixed-size sketch per window."""
    return _flat(watermark(df, ts, delay).groupBy(F.window(ts, size)).agg(
        F.approx_count_distinct(user, rsd).alias("uv")))


#: Bits of one bitmap of ``bitmap_construct_agg``.
BITMAP = 32_768


def bitmaps_of(capacity: int, error: float) -> int:
    """Bitmaps for a filter that ``capacity`` visitors fill so little that a share of ``error`` of them is not seen, on average."""
    return math.ceil(capacity / (2 * error) / BITMAP)


def missed(visitors: int | Column, bitmaps: int) -> float | Column:
    """How many of ``visitors`` a filter of so many bitmaps counts too few on average: pairs that share a bit."""
    return visitors * visitors / (2 * BITMAP * bitmaps)


def _set_bits(df: DataFrame, by: list, user: str, bitmaps: int) -> DataFrame:
    """``uv``: the number of different bits the users hash to. A bitmap is kept for each part of the bits that is used."""
    place = F.pmod(F.xxhash64(user), F.lit(bitmaps * BITMAP))
    parts = df.where(F.col(user).isNotNull()).groupBy(*by, F.floor(place / BITMAP).alias("_part")).agg(
        F.bitmap_construct_agg(place % BITMAP).alias("_bits"))
    return parts.select("window", F.bitmap_count("_bits").alias("_set")).groupBy("window").agg(F.sum("_set").alias("uv"))


def window_uv_filter(df: DataFrame, user: str, ts: str, size: str = "1 hour", delay: str = "0 seconds",
                     capacity: int = 20_000, error: float = 0.001) -> DataFrame:
    """Distinct users per window by a Bloom filter with one hash: a user counts if their bit was not set.

    The filter is a set of bits, so it can be merged, also map-side, and its count does not depend on the order of rows. It never
    counts too many; ``capacity`` users are undercounted by a share of ``error`` on average, v users by v^2 / 2m with m bits.
    State holds at most ``bitmaps_of(capacity, error)`` bitmaps of 4 kB per window. Works on tables and streams."""
    rows = watermark(df, ts, delay) if df.isStreaming else df
    return _flat(_set_bits(rows, [F.window(ts, size)], user, bitmaps_of(capacity, error)))


def session_counts(df: DataFrame, key: str, ts: str, gap: str, delay: str = "0 seconds") -> DataFrame:
    """Events per key and session, a session ending after ``gap`` without events."""
    sessions = watermark(df, ts, delay).groupBy(F.session_window(ts, gap).alias("window"), key)
    return _flat(sessions.agg(F.count(F.lit(1)).alias("n")))


HORIZON = 100 * 365 * 86_400.0  # seconds a row may be behind before Spark drops it: for ever, in effect
_LIFT = 400 * 365 * 86_400_000  # milliseconds; keeps the engine's clock above zero for any time after 1600

CLOCK = "_clock"


def late_watermark(df: DataFrame, ts: str, horizon: float = HORIZON) -> DataFrame:
    """``df`` with the column ``_clock`` as event time, on which rows count as late for Spark only beyond
    ``horizon``. It runs ahead of ``ts``, so that the engine's watermark is the largest time seen, moved
    by a constant, however large the horizon is."""
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        df = df.withColumn(ts, F.col(ts).cast("timestamp"))
    plain = F.col(ts).alias(ts, metadata={"comment": "event time of the row"})  # the clock takes over
    ahead = F.timestamp_millis(F.unix_millis(ts) + F.lit(round(horizon * 1000) + _LIFT))
    rows = df.select(*[plain if c == ts else F.col(c) for c in df.columns], ahead.alias(CLOCK))
    return rows.withWatermark(CLOCK, f"{round(horizon * 1000)} milliseconds")


class LogicalClock(StatefulProcessor):
    """A processor that sees late rows, on a stream marked by ``late_watermark``.

    Spark drops rows behind its watermark before user code runs. The engine is therefore given
    a huge delay, and the watermark asked for, ``delay`` seconds behind the largest time, is worked out
    from it. Times are milliseconds; timers are registered on the engine's clock.
    """

    def __init__(self, delay: float):
        self.behind = round(delay * 1000) + _LIFT

    def now(self, timer_values) -> int | None:
        """The watermark, or None before the first one."""
        engine = timer_values.getCurrentWatermarkInMs()
        return engine - self.behind if engine > 0 else None

    def wake(self, at_ms: int) -> None:
        """Run ``handleExpiredTimer`` once the watermark reaches ``at_ms``."""
        self.handle.registerTimer(max(at_ms + self.behind, 1))


class CountWithLate(LogicalClock):
    """One window of one key. ``phase``: 0 open, 1 fired."""

    def __init__(self, lateness: float, delay: float):
        super().__init__(delay)
        self.lateness = round(lateness * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.count = handle.getValueState("count", "n long, fired boolean")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        end = key[2]
        now = self.now(timerValues)
        closed = now is not None and now >= end
        gone = now is not None and now >= end + self.lateness
        state = self.count.get()
        n, fired = state or (0, False)
        if closed and state and not fired:
            # input is handled before timers: the window fires first
            yield Row(kind="main", at=None, n=n, key=key[0], start=key[1], end=end)
            self.count.update((n, True))
        for row in sorted(rows, key=lambda r: r["arrival"]):
            if gone:
                yield Row(kind="late", at=row["at"], n=None, key=key[0], start=key[1], end=end)
                continue
            n += 1
            if closed:
                yield Row(kind="again", at=row["at"], n=n, key=key[0], start=key[1], end=end)
        if gone:
            return
        self.count.update((n, closed))
        if not state:
            self.wake(end + self.lateness if closed else end)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        state = self.count.get()
        if not state:
            return
        end, now = key[2], self.now(timerValues)
        n, fired = state
        if not fired:
            yield Row(kind="main", at=None, n=n, key=key[0], start=key[1], end=end)
        if now is not None and now >= end + self.lateness:
            self.count.clear()
        else:
            self.count.update((n, True))
            self.wake(end + self.lateness)

    def close(self) -> None:
        pass


def tumbling_count_late(df: DataFrame, key: str, ts: str, size: str, delay: float = 0,
                        lateness: float = 5, horizon: float = HORIZON,
                        arrival: str | None = None) -> DataFrame:
    """Streaming form of ``operators.windows.tumbling_count_late``, same columns.

    Grouped by (key, window), so a hot key is spread over its windows. No row is lost: each is
    counted, counted ``again`` or tagged ``late``. Only a smaller ``horizon`` lets Spark drop rows
    further behind. ``arrival`` orders the rows of one micro-batch.
    """
    typed = df.schema[key].dataType.simpleString()
    marked = late_watermark(df, ts, horizon)
    ms = lambda c: F.unix_millis(c)
    rows = windowed(marked, ts, size).select(
        F.col(key).alias("key"), ms(F.col("window_start")).alias("start"),
        ms(F.col("window_end")).alias("end"), micros(ts).alias("at"),
        (F.col(arrival) if arrival else micros(ts)).alias("arrival"), CLOCK)
    out = rows.groupBy("key", "start", "end").transformWithState(
        CountWithLate(lateness, delay),
        f"kind string, at long, n long, key {typed}, start long, end long", "append", "EventTime")
    return out.select(
        F.col("key").alias(key), F.timestamp_millis("start").alias("window_start"),
        F.timestamp_millis("end").alias("window_end"), "kind", instant("at").alias("at"), "n")


class EagerCount(LogicalClock):
    """One window of one key: the running count per row, the final count once."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.count = handle.getValueState("count", "n long")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        now = self.now(timerValues)
        if now is not None and now >= key[2]:
            return  # the window is purged; rows this late are dropped
        state = self.count.get()
        n = state[0] if state else 0
        for _ in rows:
            n += 1
            yield Row(kind="running", n=n, key=key[0], start=key[1], end=key[2])
        self.count.update((n,))
        if not state:
            self.wake(key[2])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        state = self.count.get()
        if state:
            yield Row(kind="final", n=state[0], key=key[0], start=key[1], end=key[2])
            self.count.clear()

    def close(self) -> None:
        pass


def eager_window(df: DataFrame, key: str, ts: str, size: str, delay: float = 0) -> DataFrame:
    """Streaming form of ``operators.windows.eager_window``: one row per element, and one when
    the window ends; elements after that are dropped. ``tumbling_count`` in update mode is the cheaper form, once per batch."""
    typed = df.schema[key].dataType.simpleString()
    marked = late_watermark(df, ts)
    rows = windowed(marked, ts, size).select(
        F.col(key).alias("key"), F.unix_millis("window_start").alias("start"),
        F.unix_millis("window_end").alias("end"), CLOCK)
    out = rows.groupBy("key", "start", "end").transformWithState(
        EagerCount(delay), f"kind string, n long, key {typed}, start long, end long",
        "append", "EventTime")
    return out.select(
        F.col("key").alias(key), F.timestamp_millis("start").alias("window_start"),
        F.timestamp_millis("end").alias("window_end"), "kind", "n")


class TopN(StatefulProcessor):
    """Keeps the best ``n`` entries of a (group, shard) in list state and emits them on its timer."""

    def __init__(self, n: int):
        self.n = n

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.best = handle.getListState("best", "score long, item string")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        kept = [tuple(e) for e in self.best.get()]
        for row in rows:
            kept.append((row["score"], row["item"]))
            if len(kept) > 50 * self.n:
                kept = self._top(kept)
        self.best.put(self._top(kept))
        # a group is complete when the watermark has reached its end
        self.handle.registerTimer(key[0])
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        at = datetime.fromtimestamp(key[0] / 1000, timezone.utc)  # an instant, whatever the zone of the worker
        for rank, (score, item) in enumerate(self._top([tuple(e) for e in self.best.get()]), 1):
            yield Row(group=key[0], shard=key[1], item=item, score=score, rank=rank, at=at)
        self.best.clear()

    def _top(self, entries):
        return sorted(entries, key=lambda e: (-e[0], e[1] is not None, e[1] or ""))[:self.n]

    def close(self) -> None:
        pass


def _top(rows: DataFrame, by: list[str], n: int) -> DataFrame:
    return rows.groupBy(*by).transformWithState(
        TopN(n), "group long, shard long, item string, score long, rank int, at timestamp", "append", "EventTime",
        eventTimeColumnName="at")


def top_n_keyed(df: DataFrame, group_end: str, ts: str, item: str, score: str, n: int, shards: int = 4) -> DataFrame:
    """Best ``n`` rows per group, emitted when the watermark passes the group's end time.

    ``df`` is watermarked on ``ts`` and has one row per group and item. Items are ranked per shard first, so that
    a group's items are spread over tasks (choose more shards for more items, one where a group has only a few); state holds
    ``n`` entries per group and shard, whatever the number of rows. Ties go by item as text.
    """
    rows = df.select(
        F.unix_millis(group_end).alias("group"), F.pmod(F.xxhash64(item), F.lit(shards)).alias("shard"),
        F.col(item).cast("string").alias("item"), F.col(score).cast("long").alias("score"), F.col(ts).alias("at"))
    out = _top(rows, ["group", "shard"], n)
    if shards > 1:
        out = _top(out.select("group", F.lit(0).cast("long").alias("shard"), "item", "score", "at"), ["group", "shard"], n)
    kind = df.schema[item].dataType
    return out.select(F.timestamp_millis("group").alias(group_end), F.col("item").cast(kind).alias(item),
                      F.col("score").alias(score), "rank")
