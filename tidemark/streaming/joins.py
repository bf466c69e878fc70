"""Joins of two streams. ``window_join`` and ``lookup_join`` of the batch joins work on
watermarked streams as they are."""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.functions.dates import later
from tidemark.operators import joins
from tidemark.operators.joins import prefixed, side_by_side
from tidemark.streaming.groups import dealt, id_type
from tidemark.streaming.streams import watermark
from tidemark.streaming.windows import CLOCK, HORIZON, LogicalClock, late_watermark, micros


def window_join(left: DataFrame, right: DataFrame, key: str, ts: str, size: str,
                slide: str | None = None, delay: str = "0 seconds") -> DataFrame:
    """State is dropped when the watermark passes the window."""
    # the window takes over as event time; a join input may have only one
    plain = F.col(ts).alias(ts, metadata={"comment": "event time of the row"})

    def side(df: DataFrame) -> DataFrame:
        rows = joins.with_window(watermark(df, ts, delay), ts, size, slide)
        return rows.select(*[plain if c == ts else F.col(c) for c in rows.columns])

    return side(left).join(prefixed(side(right), key, "window"), [key, "window"])


def interval_join(left: DataFrame, right: DataFrame, key: str, ts: str, lower: float,
                  upper: float, delay: str = "0 seconds") -> DataFrame:
    """State on both sides is dropped once the interval can no longer be reached."""
    return joins.interval_join(watermark(left, ts, delay), watermark(right, ts, delay), key, ts,
                               lower, upper)


def outer_join(left: DataFrame, right: DataFrame, key: str, ts: str, lower: float, upper: float,
               how: str, delay: str = "0 seconds") -> DataFrame:
    """``left``, ``right`` or ``full`` join on equal key within a time range. Unmatched rows come
    out padded with nulls when the watermark rules out a partner; nothing is withdrawn later
    (see ``changelog_join`` for that)."""
    mine = watermark(left, ts, delay)
    theirs = prefixed(watermark(right, ts, delay))
    kind = mine.schema[ts].dataType
    rts = F.col(f"right_{ts}")
    on = (F.col(key) == F.col(f"right_{key}")) & (rts >= later(F.col(ts), lower, kind)) & (
        rts <= later(F.col(ts), upper, kind))
    joined = mine.join(theirs, on, {"full": "full_outer"}.get(how, how))
    return joined.withColumn(key, F.coalesce(F.col(key), F.col(f"right_{key}"))).drop(f"right_{key}")


BUCKETS = 256  # groups that keys are dealt to


def _struct(df: DataFrame) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema])


def _values(row) -> tuple:
    """A nested row as state stores it; Arrow hands it over as a dict."""
    return tuple(row.values()) if isinstance(row, dict) else tuple(row)


def _named(kind: T.StructType, row) -> dict | None:
    """A stored row as Arrow takes it back."""
    return None if row is None else dict(zip(kind.names, row))


def session_window_join(left: DataFrame, right: DataFrame, key: str, ts: str, gap: str,
                        delay: str = "0 seconds") -> DataFrame:
    """Inner join on equal key and same session, where sessions are formed over the rows of both sides together; a pause longer
    than ``gap`` starts the next one. Columns of ``right`` other than the key get the prefix ``right_``.

    A session's rows are gathered by a session window: a row between two open sessions merges them. Its pairs come out
    when the watermark, the smaller of the two streams', has passed its end; until then it holds the rows of both sides. Null keys
    meet nobody."""
    both = side_by_side(watermark(left, ts, delay), watermark(right, ts, delay), key, ts).where(F.col(key).isNotNull())
    side = F.col("_side")
    sessions = both.groupBy(F.session_window(ts, gap).alias("window"), key).agg(
        F.collect_list(F.when(side == "l", F.col("_left"))).alias("_lefts"),
        F.collect_list(F.when(side == "r", F.col("_right"))).alias("_rights"))
    met = sessions.where((F.size("_lefts") > 0) & (F.size("_rights") > 0))
    pairs = met.withColumn("_left", F.explode("_lefts")).withColumn("_right", F.explode("_rights"))
    mine = [F.col("_left")[c].alias(c) for c in left.columns]
    return pairs.select(*mine, *[F.col("_right")[c].alias(f"right_{c}") for c in right.columns if c != key],
                        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"))


def _rows_type(id_type: T.DataType, row: T.StructType, *more: str) -> T.StructType:
    """An array of rows with the ids of their keys."""
    fields = [T.StructField("id", id_type), *[T.StructField(c, T.LongType()) for c in more],
              T.StructField("row", row)]
    return T.StructType([T.StructField("rows", T.ArrayType(T.StructType(fields)))])


def _held(state, *number: int) -> list[tuple]:
    """The rows under a number in map state."""
    found = state.getValue(number)
    return [(*r[:-1], _values(r[-1])) for r in found[0]] if found else []


class AsOf(LogicalClock):
    """A bucket of keys, or a share of its rows. Versions are kept in map state by page of keys, as chunks added without reading those
    before; rows wait in map state by slot of time until the watermark has passed them. One timer, for the row that waits longest, answers
    all rows passed, so that a page of versions is read once a micro-batch. A version that no later row can meet goes when its page is written
    again: if half of it is such versions, or after ``most_chunks``."""

    most_chunks = 16

    def __init__(self, id_type: T.DataType, row: T.StructType, version: T.StructType, delay: float):
        super().__init__(delay)
        self.id_type, self.types = id_type, (row, version)
        self.slot = max(1000, round(delay * 1000) // 32)  # milliseconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.book = handle.getValueState(
            "book", "answered long, wake long, slots array<long>, chunks array<struct<page: int, n: int>>")
        self.versions = handle.getMapState("versions", "page int, chunk int", _rows_type(self.id_type, self.types[1], "at"))
        self.waiting = handle.getMapState("waiting", "slot long", _rows_type(self.id_type, self.types[0], "page", "at"))

    def _book(self) -> tuple:
        """What has been answered, when the timer is due, the slots with rows that wait, and the chunks of each page."""
        found = self.book.get()
        return (found[0], found[1], set(found[2]), {p: n for p, n in found[3]}) if found else (None, None, set(), {})

    def _note(self, answered: int | None, wake: int | None, slots: set[int], chunks: dict[int, int]) -> None:
        self.book.update((answered, wake, sorted(slots), list(chunks.items())))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        now = self.now(timerValues)
        answered, wake, slots, chunks = self._book()
        new: dict[int, list] = {}
        waiting: dict[int, list] = {}
        for row in rows:
            at = row["at"]
            if row["_side"] == "r":
                new.setdefault(row["page"], []).append((row["id"], at, _values(row["_right"])))
            elif now is None or at >= now * 1000:
                waiting.setdefault(-(-at // 1000) // self.slot, []).append((row["id"], row["page"], at, _values(row["_left"])))
        for page, more in new.items():
            n = chunks.get(page, 0)
            if n >= self.most_chunks:
                n = self._write(page, n, self._live([*self._versions(page, n), *more], answered))
            else:
                self.versions.updateValue((page, n), (more,))
                n += 1
            chunks[page] = n
        for slot, more in waiting.items():
            self.waiting.updateValue((slot,), ([*(_held(self.waiting, slot) if slot in slots else ()), *more],))
            slots.add(slot)
            first = min(-(-at // 1000) for _, _, at, _ in more) + 1
            if wake is None or first < wake:
                wake = first
                self.wake(wake)
        # timers run after the rows: what waits until now is answered by the next call
        self._note(answered if now is None else now, wake, slots, chunks)
        return iter(())

    def _versions(self, page: int, chunks: int) -> list[tuple]:
        return [v for chunk in range(chunks) for v in _held(self.versions, page, chunk)]

    def _write(self, page: int, chunks: int, versions: list[tuple]) -> int:
        """Keep the versions as the only chunk of a page."""
        for chunk in range(1, chunks):
            self.versions.removeKey((page, chunk))
        self.versions.updateValue((page, 0), (versions,))
        return 1

    def _live(self, versions: list[tuple], answered: int | None) -> list[tuple]:
        """Versions without those replaced, the last of one start to arrive counting, and those before the newest of their key that had started by
        ``answered`` (milliseconds): no row waits or comes that is as old."""
        last = {(id, at): row for id, at, row in versions}
        if answered is None:
            return [(id, at, row) for (id, at), row in last.items()]
        bound = (answered - 1) * 1000  # rows of this millisecond may still wait
        newest: dict = {}
        for id, at in last:
            if at <= bound and at > newest.get(id, at - 1):
                newest[id] = at
        return [(id, at, row) for (id, at), row in last.items() if at >= newest.get(id, at)]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = self.now(timerValues)
        answered, wake, slots, chunks = self._book()
        due = [slot for slot in sorted(slots) if slot * self.slot < now]
        passed: dict[int, list] = {}
        rest: list[int] = []
        for slot in due:
            later_rows = []
            for row in _held(self.waiting, slot):
                if -(-row[2] // 1000) < now:
                    passed.setdefault(row[1], []).append(row)
                else:
                    later_rows.append(row)
            if later_rows:
                rest += [-(-row[2] // 1000) for row in later_rows]
                self.waiting.updateValue((slot,), (later_rows,))
            else:
                self.waiting.removeKey((slot,))
                slots.remove(slot)
        for page, rows in passed.items():
            n = chunks.get(page, 0)
            held = self._versions(page, n)
            versions: dict = {}
            for id, start, version in sorted(held, key=lambda v: v[1]):
                versions.setdefault(id, []).append((start, version))
            for id, _, at, row in rows:
                known = versions.get(id, ())
                i = bisect_right(known, at, key=lambda v: v[0]) - 1
                yield Row(left=_named(self.types[0], row), right=_named(self.types[1], known[i][1]) if i >= 0 else None)
            live = self._live(held, now)
            if 2 * len(live) < len(held):
                chunks[page] = self._write(page, n, live)
        if not rest and slots:  # the next slot's rows are not read for it
            rest = [min(slots) * self.slot]
        wake = min(rest) + 1 if rest else None
        if wake is not None:
            self.wake(max(wake, now + 1))
        self._note(answered, wake, slots, chunks)

    def close(self) -> None:
        pass


def as_of_join(left: DataFrame, versions: DataFrame, key: str, ts: str, version_ts: str, how: str = "left",
               delay: float = 0, shards: int = 1, horizon: float = HORIZON, buckets: int = BUCKETS) -> DataFrame:
    """Streaming form of ``operators.joins.as_of_join``: each row of ``left`` with the version of its key that was valid
    at its time, not the newest one known when it arrives.

    A row waits until the watermark, ``delay`` seconds behind the smaller of the two streams' clocks, has passed it: versions that
    come late by less than this still count for rows before them. Rows behind the watermark are dropped; versions are
    kept however late they come, for the rows after them. Of versions with one start the last to arrive counts. Keys are
    dealt to ``buckets`` groups; ``shards`` spreads the rows of a hot key over so many, each with a copy of its versions. A row with a null key comes out at once, without a
    version."""
    right = versions.withColumn(version_ts, F.col(version_ts).cast("timestamp")).where(F.col(key).isNotNull())
    mine = left_typed(left, ts)
    both = side_by_side(
        late_watermark(mine.where(F.col(key).isNotNull()).withColumns({"_key": F.col(key), "_at": F.col(ts)}), "_at", horizon),
        late_watermark(right.withColumns({"_key": F.col(key), "_at": F.col(version_ts)}), "_at", horizon), "_key", "_at", CLOCK)
    share = F.xxhash64("_left") if shards > 1 else F.lit(0).cast("long")
    every = F.array(*[F.lit(i).cast("long") for i in range(shards)])
    own = ["_key", "_at", CLOCK]
    rows = dealt(both.select(
        F.col("_key").alias("key"), F.explode(F.when(F.col("_side") == "r", every).otherwise(
            F.array(F.pmod(share, F.lit(shards).cast("long"))))).alias("shard"),
        "_side", F.col("_left").dropFields(*own).alias("_left"), F.col("_right").dropFields(*own).alias("_right"),
        micros("_at").alias("at"), CLOCK), "key", buckets)
    types = (_struct(mine), _struct(right))
    found = rows.groupBy("bucket", "shard").transformWithState(
        AsOf(id_type(mine.schema[key].dataType), *types, delay), T.StructType([T.StructField("left", types[0]), T.StructField("right", types[1])]), "append", "EventTime")
    if how == "inner":
        found = found.where(F.col("right").isNotNull())
    names = [c for c in versions.columns if c != key]
    out = found.select("left.*", *[F.col("right")[c].alias(f"right_{c}") for c in names])
    if how == "inner":
        return out
    return out.unionByName(mine.where(F.col(key).isNull()).select(
        *mine.columns, *[F.lit(None).cast(right.schema[c].dataType).alias(f"right_{c}") for c in names]))


class IntervalJoinLate(LogicalClock):
    """One cell of time of a bucket of keys. The rows of each side wait in map state, by slot of time: a new row reads
    only the slots its partners can lie in, and pairs are found in sorted lists of a key's rows."""

    def __init__(self, id_type: T.DataType, left: T.StructType, right: T.StructType, lower: float, upper: float,
                 cell: float, delay: float):
        super().__init__(delay)
        self.id_type, self.types = id_type, (left, right)
        self.lower, self.upper = round(lower * 1e6), round(upper * 1e6)
        self.cell = cell
        self.slot = max(1, (self.upper - self.lower) // 2)  # microseconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sides = [handle.getMapState(name, "slot long", _rows_type(self.id_type, kind, "at"))
                      for name, kind in zip(("left", "right"), self.types)]

    def _slot(self, side: int, slot: int, read: list[dict | None]) -> dict:
        """Kept rows of a slot by key, each by time."""
        if read[side] is None:  # nothing is held: no need to look into every slot
            read[side] = {} if self.sides[side].exists() else defaultdict(dict)
        if isinstance(read[side], defaultdict) or slot in read[side]:
            return read[side][slot]
        read[side][slot] = _by_id(_held(self.sides[side], slot))
        return read[side][slot]

    def _near(self, side: int, id, first: int, last: int, read: list[dict | None]) -> Iterator[tuple]:
        """Kept rows of a key and side with ``first <= at <= last``."""
        for slot in range(first // self.slot, last // self.slot + 1):
            yield from _between(self._slot(side, slot, read).get(id, ()), first, last)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        now = self.now(timerValues)
        new: tuple[list, list] = ([], [])
        for row in rows:
            side = 0 if row["_side"] == "l" else 1
            mine = _values(row["_right"] if side else row["_left"])
            if now is not None and row["at"] < now * 1000:
                if row["primary"]:
                    yield Row(kind=("left_late", "right_late")[side],
                              left=None if side else _named(self.types[0], mine),
                              right=_named(self.types[1], mine) if side else None)
            elif row["id"] is not None:  # a null key equals nothing
                new[side].append((row["id"], row["at"], mine))
        # new left rows meet the right rows kept before and the new ones, new right rows the left rows kept before
        read: list[dict | None] = [None, None]
        fresh = _by_id(new[1])
        for id, at, l_row in new[0]:
            first, last = at + self.lower, at + self.upper
            for _, r_row in (*self._near(1, id, first, last, read), *_between(fresh.get(id, ()), first, last)):
                yield self._match(l_row, r_row)
        for id, at, r_row in new[1]:
            for _, l_row in self._near(0, id, at - self.upper, at - self.lower, read):
                yield self._match(l_row, r_row)
        for side in (0, 1):
            slots: dict[int, list] = {}
            for row in new[side]:
                slots.setdefault(row[1] // self.slot, []).append(row)
            for slot, more in slots.items():
                kept = [(id, at, row) for id, of_key in self._slot(side, slot, read).items() for at, row in of_key]
                self.sides[side].updateValue((slot,), ([*kept, *more],))
        if new[0] or new[1]:
            end = (key[1] + 1) * self.cell * 1000 + max(self.upper // 1000, 0)
            self.wake(int(end) + 1)

    def _match(self, left: tuple, right: tuple) -> Row:
        return Row(kind="match", left=_named(self.types[0], left), right=_named(self.types[1], right))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        for state in self.sides:
            state.clear()
        return iter(())

    def close(self) -> None:
        pass


def _by_id(rows: list[tuple]) -> dict:
    """(id, at, row) as lists of (at, row) by id, each by time."""
    out: dict = {}
    for id, at, row in sorted(rows, key=lambda r: r[1]):
        out.setdefault(id, []).append((at, row))
    return out


def _between(rows: list[tuple], first: int, last: int) -> list[tuple]:
    return rows[bisect_left(rows, first, key=lambda r: r[0]):bisect_right(rows, last, key=lambda r: r[0])] if rows else []


def interval_join_late(left: DataFrame, right: DataFrame, key: str, ts: str, lower: float,
                       upper: float, delay: float, horizon: float = HORIZON, buckets: int = 16) -> DataFrame:
    """Interval join with rows behind the watermark tagged instead of dropped, however late they are.

    Output: ``kind`` (``match``, ``left_late``, ``right_late``) and the whole rows ``left`` and
    ``right``. The watermark is the smaller one of the two streams. Grouped by bucket of keys and cell of
    time, as in the batch ``interval_join``; cells are wider here, as each costs state and a
    timer, and ``buckets`` few, as there are as many groups for every cell. A right row reaches one or two cells and is reported late from the first only. A null
    key equals nothing.
    """
    both = side_by_side(late_watermark(left, ts, horizon), late_watermark(right, ts, horizon), key, ts, CLOCK)
    cell = max(1, 4 * math.ceil(upper - lower))
    number = lambda us: F.floor(us / F.lit(cell * 1e6)).cast("long")
    at = micros(ts)
    reach = F.sequence(number(at - F.lit(round(upper * 1e6))), number(at - F.lit(round(lower * 1e6))))
    cells = F.when(F.col("_side") == "l", F.array(number(at))).otherwise(reach)
    rows = dealt(both.select(
        F.col(key).alias("key"), F.posexplode(cells).alias("_nth", "cell"), "_side",
        F.col("_left").dropFields(CLOCK).alias("_left"), F.col("_right").dropFields(CLOCK).alias("_right"),
        at.alias("at"), CLOCK,
    ).withColumn("primary", F.col("_nth") == 0), "key", buckets)
    types = (_struct(left_typed(left, ts)), _struct(left_typed(right, ts)))
    out = T.StructType([T.StructField("kind", T.StringType()), T.StructField("left", types[0]),
                        T.StructField("right", types[1])])
    return rows.groupBy("bucket", "cell").transformWithState(
        IntervalJoinLate(id_type(both.schema[key].dataType), *types, lower, upper, cell, delay), out, "append", "EventTime")


def left_typed(df: DataFrame, ts: str) -> DataFrame:
    """``df`` with the event time as watermarks need it."""
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


class ChangelogJoin(StatefulProcessor):
    """A cell of a bucket of keys: its share of the left rows and its share of the right rows, in arrival order. How many rows of a key and
    side there are here, and whether any have come at all, here or elsewhere (``seen``), is kept apart, by page: the rows of a
    page and side are read only when a row of the other side has to meet them. Rows are added as chunks, without reading those before.

    Cells lie in a square. The cells of the first column answer for the left rows that have met nobody, those of the first
    row for the right ones; rows of other cells reach them as marks, which hold no row."""

    most_chunks = 16  # chunks that are read are joined into one if they are more

    def __init__(self, id_type: T.DataType, left: T.StructType, right: T.StructType, how: str):
        self.id_type, self.types, self.how = id_type, (left, right), how

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.sides = [handle.getMapState(name, "page int, chunk int", _rows_type(self.id_type, kind))
                      for name, kind in zip(("left", "right"), self.types)]
        self.pages = handle.getMapState(
            "pages", "page int", f"left int, right int, keys array<struct<id: {self.id_type.simpleString()}, n_left: long, n_right: long, "
            "seen_left: boolean, seen_right: boolean>>")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        pages: dict[int, list] = {}
        for row in rows:
            pages.setdefault(row["page"], []).append(row)
        for page, own in pages.items():
            yield from self._page(key, page, sorted(own, key=lambda r: r["seq"]))

    def _read(self, side: int, page: int, chunks: list[int]) -> dict:
        """Rows of a page and side by key."""
        out: dict = {}
        parts = [self.sides[side].getValue((page, chunk))[0] for chunk in range(chunks[side])]
        for part in parts:
            for id, row in part:
                out.setdefault(id, []).append(_values(row))
        if chunks[side] > self.most_chunks:
            for chunk in range(1, chunks[side]):
                self.sides[side].removeKey((page, chunk))
            self.sides[side].updateValue((page, 0), ([(id, row) for id, own in out.items() for row in own],))
            chunks[side] = 1
        return out

    def _page(self, key, page: int, rows: list[Row]) -> Iterator[Row]:
        found = self.pages.getValue((page,))
        chunks = [found[0], found[1]] if found else [0, 0]
        keys = {k[0]: list(k[1:]) for k in found[2]} if found else {}
        new: tuple[dict, dict] = ({}, {})
        held: list[dict | None] = [None, None]
        # whose padded rows are told here
        padded = (self.how in ("left", "full") and key[2] == 0, self.how in ("right", "full") and key[1] == 0)

        def partners(side: int, id) -> Iterator[tuple]:
            if keys[id][side]:
                if held[side] is None:
                    held[side] = self._read(side, page, chunks)
                yield from held[side][id]
            yield from new[side].get(id, ())

        def out(op, at, step, side, mine, other):
            left, right = (other, mine) if side else (mine, other)
            return Row(op=op, at=at, step=step, left=_named(self.types[0], left),
                       right=_named(self.types[1], right))

        for row in rows:
            at, id = row["seq"], row["id"]
            known = keys.setdefault(id, [0, 0, False, False])
            side = 0 if row["_side"] == "l" else 1
            # partners alone so far were emitted padded; withdraw that first
            if padded[1 - side] and not known[2 + side]:
                for other in partners(1 - side, id):
                    yield out("-D", at, 0, side, None, other)
            known[2 + side] = True
            if row["mark"]:
                continue
            mine = _values(row["_right"] if side else row["_left"])
            for other in partners(1 - side, id):
                yield out("+I", at, 1, side, mine, other)
            if padded[side] and not known[3 - side]:
                yield out("+I", at, 1, side, mine, None)
            new[side].setdefault(id, []).append(mine)
        for side in (0, 1):
            if new[side]:
                self.sides[side].updateValue((page, chunks[side]), ([(id, row) for id, own in new[side].items() for row in own],))
                chunks[side] += 1
                for id, own in new[side].items():
                    keys[id][side] += len(own)
        self.pages.updateValue((page,), (*chunks, [(id, *known) for id, known in keys.items()]))

    def close(self) -> None:
        pass


def _in_cells(rows: DataFrame, key: str, shards: int) -> DataFrame:
    """Left rows in a row of the square of cells, right rows in a column, and their marks in the first row or column."""
    mine = F.pmod(F.xxhash64("_left", "_right"), F.lit(shards)).cast("int")  # one of them is null
    every = F.sequence(F.lit(0), F.lit(shards - 1))
    left = F.col("_side") == "l"

    def cell(own, other, mark: bool):
        return F.struct(F.when(left, own).otherwise(other).alias("i"), F.when(left, other).otherwise(own).alias("j"),
                        F.lit(mark).alias("mark"))

    full = F.transform(every, lambda other: cell(F.col("_mine"), other, False))
    marks = F.when(F.col("_mine") > 0, F.transform(every, lambda other: cell(F.lit(0), other, True))).otherwise(
        F.array().cast("array<struct<i:int,j:int,mark:boolean>>"))
    spread = rows.withColumn("_mine", mine).withColumn("_cell", F.explode(F.concat(full, marks)))
    blank = [F.when(~F.col("_cell.mark"), F.col(c)).alias(c) for c in ("_left", "_right")]
    return spread.select(key, "seq", "_side", F.col("_cell.i").alias("i"), F.col("_cell.j").alias("j"),
                         F.col("_cell.mark").alias("mark"), *blank)


def changelog_join(left: DataFrame, right: DataFrame, key: str, seq: str,
                   how: str = "left", shards: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """Streaming form of ``operators.joins.outer_join_changelog``: every row of both streams is
    kept, nothing needs a watermark, and padded rows are withdrawn when a partner arrives. Keys are dealt to ``buckets``. With ``shards`` a bucket is
    ``shards * shards`` groups, each with a share of both sides, for which every row is sent ``shards`` times and, without its
    values, as often again: no group of a hot key reads or holds a whole side.

    Output: op, at, step, key and the whole rows ``left`` and ``right`` (null where padded).
    """
    if how not in ("inner", "left", "right", "full"):
        raise ValueError(how)
    keyed = F.col(key).isNotNull()
    rows = side_by_side(left.where(keyed), right.where(keyed), key).withColumn(
        "seq", F.coalesce(F.col(f"_left.{seq}"), F.col(f"_right.{seq}")))
    types = (_struct(left), _struct(right))
    out = T.StructType([
        T.StructField("op", T.StringType()), T.StructField("at", left.schema[seq].dataType),
        T.StructField("step", T.IntegerType()), T.StructField("left", types[0]),
        T.StructField("right", types[1])])
    log = dealt(_in_cells(rows, key, shards), key, buckets).groupBy("bucket", "i", "j").transformWithState(
        ChangelogJoin(id_type(rows.schema[key].dataType), *types, how), out, "append", "None")
    # a null key equals nothing: such rows are padded at once and never withdrawn
    for side, name in ((left, "left"), (right, "right")):
        if how in (name, "full"):
            own = F.struct(*side.columns).cast(types[name == "right"])
            blank = F.lit(None).cast(types[name == "left"])
            both = (own, blank) if name == "left" else (blank, own)
            log = log.unionByName(side.where(~keyed).select(
                F.lit("+I").alias("op"), F.col(seq).alias("at"), F.lit(1).alias("step"),
                both[0].alias("left"), both[1].alias("right")))
    return log.withColumn(key, F.coalesce(F.col(f"left.{key}"), F.col(f"right.{key}")))
