"""Event patterns per key over streams.

A group is a bucket of keys in a cell of time: a call of Python serves many keys, and the rows of a hot key are spread. What decides about a row lies close to it:
patterns with a time limit also get the rows shortly after their cell, as copies that only end what the cell has open; runs of
adjacent events hand the few events at the edges of their cell to a second step, which only ever sees those.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.streaming.groups import dealt, id_type, key_of, plain
from tidemark.streaming.streams import watermark
from tidemark.streaming.windows import instant, micros


FIRST, SECOND, OTHER, BORDER = 1, 2, 0, 4
CELL = 30 * 86_400.0  # seconds; shorter cells spread a hot key further and cost a group each
CELLS = 240      # length of a cell in time limits, for patterns that have one
SHARES = 64      # groups that a key's matches pass through
BUCKETS = 512    # groups that the keys of a cell are dealt to


class InOrder(StatefulProcessor):
    """Hands the rows of each key of a group to ``event`` in order of event time. A group is a bucket of keys in a cell of time.

    Rows wait in list state, an array for each micro-batch, until the watermark passes them, so input out of order within the
    watermark delay gives the same result as input in order. Each row is ``(id, page, at, flag)``, ``at``
    in microseconds. What the subclass must remember of a key is a list, ``memory``, kept in map state by page.
    """

    memory_schema = "at: long"

    def __init__(self, id_type: str):
        self.id_type = id_type

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState(
            "waiting", f"rows array<struct<id: {self.id_type}, page: int, at: long, flag: int>>")
        self.pages = handle.getMapState(
            "pages", "page int", f"keys array<struct<id: {self.id_type}, memory: array<struct<{self.memory_schema}>>>>")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        new = [(r["id"], r["page"], r["at"], r["flag"]) for r in rows]
        self.waiting.appendValue((new,))
        self._wake(min(at for _, _, at, _ in new))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        reached = timerValues.getCurrentWatermarkInMs() * 1000 + 999
        waiting = [tuple(w) for held in self.waiting.get() for w in held[0]]
        ready = sorted((w for w in waiting if w[2] <= reached), key=lambda w: w[2:])
        rest = [w for w in waiting if w[2] > reached]
        whole = self.looks_at_all(key, reached)
        pages = self._every_page() if whole else {}
        before = {page: {id: list(m) for id, m in keys.items()} for page, keys in pages.items()}
        for id, page, at, flag in ready:
            if page not in pages:
                pages[page] = {} if whole else self._page(page)
                before[page] = {id: list(m) for id, m in pages[page].items()}
            yield from self.event(id, page, key, at, flag, pages[page].setdefault(id, []))
        if whole:
            for page, keys in pages.items():
                for id, memory in keys.items():
                    if memory and all(at <= reached for at in self.deadlines(memory)):
                        yield from self.passed(id, page, key, reached, memory)
        if ready:
            self.waiting.put([(rest,)]) if rest else self.waiting.clear()
        for page, keys in pages.items():
            kept = {id: memory for id, memory in keys.items() if memory}
            if kept != before[page]:
                self.pages.updateValue((page,), (list(kept.items()),)) if kept else self.pages.removeKey((page,))
        following = [min(w[2] for w in rest)] if rest else []
        following += [at for keys in pages.values() for memory in keys.values() for at in self.deadlines(memory)]
        if following:
            self._wake(min(following))

    def _keys(self, value) -> dict:
        return {k[0]: plain(k[1]) for k in value[0]} if value else {}

    def _page(self, page: int) -> dict:
        return self._keys(self.pages.getValue((page,)))

    def _every_page(self) -> dict:
        return {page[0]: self._keys(value) for page, value in self.pages.iterator()}

    def _wake(self, at: int) -> None:
        self.handle.registerTimer(at // 1000 + 1)

    def event(self, id, page: int, key, at: int, flag: int, memory: list) -> Iterator[Row]:
        """Handle one row; change ``memory`` in place."""
        raise NotImplementedError

    def looks_at_all(self, key, reached: int) -> bool:
        """Whether ``passed`` may concern keys without new rows."""
        return True

    def passed(self, id, page: int, key, reached: int, memory: list) -> Iterator[Row]:
        """Handle time passing without rows."""
        return iter(())

    def deadlines(self, memory: list) -> list[int]:
        """Times at which ``passed`` must run."""
        return []

    def close(self) -> None:
        pass


def _by_key(df: DataFrame, key: str, ts: str, delay: str, flag: Column, cell: float, reach: float = 0,
            buckets: int = BUCKETS) -> DataFrame:
    """Rows by ``bucket`` of keys and ``cell`` of time; those in the first ``reach`` seconds of a cell also as ``BORDER`` rows of the one before."""
    marked = watermark(df, ts, delay)
    rows = dealt(marked.select(F.col(key).alias("key"), micros(ts).alias("at"), flag.cast("int").alias("flag"), F.col(ts).alias("_time")),
                 "key", buckets)

    def number(at: Column) -> Column:
        return F.floor(at / F.lit(round(cell * 1e6))).cast("long")

    if not reach:
        return rows.withColumn("cell", number(F.col("at")))
    own, early = number(F.col("at")), number(F.col("at") - F.lit(round(reach * 1e6)))
    both = rows.withColumn("cell", F.explode(F.when(early < own, F.array(own, early)).otherwise(F.array(own))))
    return both.withColumn("flag", F.when(F.col("cell") < own, F.col("flag") + BORDER).otherwise(F.col("flag")))


def _edge(edge) -> tuple[int, int]:
    return (edge["at"], edge["flag"]) if isinstance(edge, dict) else tuple(edge)


class RunsInCell(InOrder):
    """The runs inside one cell of time. Memory of a key: how many events there were, the times of the current run of matching events, at most
    ``times - 1``, and the last events. The first ``times - 1`` events go on as they are, the last ones when the cell ends
    (``edges``; ``gap``: there were others between)."""

    memory_schema = "n: long, run: array<long>, last: array<struct<at: long, flag: int>>"

    def __init__(self, id_type: str, times: int, cell: float):
        super().__init__(id_type)
        self.times, self.cell = times, round(cell * 1e6)

    def _row(self, id, page, key, times=None, edges=(), gap=False) -> Row:
        share = key[1] % SHARES + 1 if times else 0
        return Row(id=id, page=page, bucket=key[0], share=share, cell=key[1], match_times=times,
                   edges=[dict(at=a, flag=f) for a, f in edges], gap=gap)

    def event(self, id, page, key, at, flag, memory):
        n, run, last = memory.pop() if memory else (0, [], [])
        if n < self.times - 1:
            yield self._row(id, page, key, edges=[(at, flag)])
        elif self.times > 1:
            last = [*last, (at, flag)][-(self.times - 1):]
        run = [*run, at] if flag else []
        if len(run) == self.times:
            yield self._row(id, page, key, times=run)
            run = run[1:]
        memory.append((n + 1, run, last))

    def looks_at_all(self, key, reached):
        return reached >= (key[1] + 1) * self.cell

    def passed(self, id, page, key, reached, memory):
        n, _, last = memory.pop()
        if last:
            yield self._row(id, page, key, edges=last, gap=n > 2 * (self.times - 1))

    def handleInputRows(self, key, rows, timerValues):
        self.handle.registerTimer((key[1] + 1) * self.cell // 1000 + 1)
        return super().handleInputRows(key, rows, timerValues)


class RunsAcrossCells(StatefulProcessor):
    """Edges of the cells of the keys of a bucket, which come in the order of cells, as a cell's events come after the cells before it have
    ended. Finds the runs of more than one cell; matches found in a cell pass through."""

    def __init__(self, id_type: str, times: int):
        self.id_type, self.times = id_type, times

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.pages = handle.getMapState(
            "pages", "page int", f"keys array<struct<id: {self.id_type}, run: array<struct<at: long, cell: long>>>>")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        edges: dict[int, dict] = {}
        for row in rows:
            if row["match_times"] is not None and len(row["match_times"]):
                yield Row(id=row["id"], match_times=[int(t) for t in row["match_times"]])
            else:
                edges.setdefault(row["page"], {}).setdefault(row["id"], []).append(
                    (row["cell"], [_edge(e) for e in row["edges"]], row["gap"]))
        for page, of_keys in edges.items():
            found = self.pages.getValue((page,))
            runs = {k[0]: plain(k[1]) for k in found[0]} if found else {}
            for id, more in of_keys.items():
                run = runs.pop(id, [])
                for cell, events, gap in sorted(more):
                    if gap:
                        run = []
                    for at, flag in events:
                        run = [*run, (at, cell)][-self.times:] if flag else []
                        if len(run) == self.times and run[0][1] != cell:
                            yield Row(id=id, match_times=[at for at, _ in run])
                run = run[-(self.times - 1):] if self.times > 1 else []
                if run:
                    runs[id] = run
            if runs:
                self.pages.updateValue((page,), (list(runs.items()),))
            elif found:
                self.pages.removeKey((page,))

    def close(self) -> None:
        pass


def consecutive_match(df: DataFrame, key: str, ts: str, matches: Column, times: int = 3,
                      delay: str = "0 seconds", cell: float = CELL, buckets: int = BUCKETS) -> DataFrame:
    """Streaming form of ``operators.patterns.consecutive_match``."""
    rows = _by_key(df, key, ts, delay, F.coalesce(matches, F.lit(False)), cell, buckets=buckets)
    typed = id_type(df.schema[key].dataType).simpleString()
    in_cells = rows.groupBy("bucket", "cell").transformWithState(
        RunsInCell(typed, times, cell), f"id {typed}, page int, bucket int, share long, cell long, match_times array<long>, "
        "edges array<struct<at: long, flag: int>>, gap boolean", "append", "EventTime")
    out = in_cells.groupBy("bucket", "share").transformWithState(
        RunsAcrossCells(typed, times), f"id {typed}, match_times array<long>", "append", "None")
    return out.select(key_of(F.col("id"), df.schema[key].dataType).alias(key), F.transform(
        "match_times", F.timestamp_micros).alias("match_times"))


class SequenceWithin(InOrder):
    """Memory of a key: the open first event, if any."""

    def __init__(self, id_type: str, within: float, interrupted: str):
        super().__init__(id_type)
        self.within, self.interrupted = round(within * 1e6), interrupted

    def event(self, id, page, key, at, flag, memory):
        yield from self.passed(id, page, key, at, memory)
        if memory:
            opened = memory.pop()[0]
            if flag & SECOND:
                yield Row(id=id, kind="match", first=opened, second=at)
            elif self.interrupted == "timeout":
                yield Row(id=id, kind="timeout", first=opened, second=None)
        if flag & FIRST and not flag & BORDER:
            memory.append((at,))

    def passed(self, id, page, key, reached, memory):
        if memory and reached >= memory[0][0] + self.within:
            yield Row(id=id, kind="timeout", first=memory.pop()[0], second=None)

    def deadlines(self, memory):
        return [m[0] + self.within for m in memory]


def sequence_within(df: DataFrame, key: str, ts: str, first: Column, second: Column,
                    within: float, interrupted: str = "drop",
                    delay: str = "0 seconds", cell: float | None = None,
                    buckets: int = BUCKETS) -> DataFrame:
    """Streaming form of ``operators.patterns.sequence_within``. Matches and timeouts share one
    output; split it by ``kind``. ``cell`` is at least ``within`` seconds, by default ``CELLS`` times as long."""
    flag = (F.when(first, FIRST).otherwise(OTHER) + F.when(second, SECOND).otherwise(OTHER))
    typed = id_type(df.schema[key].dataType).simpleString()
    rows = _by_key(df, key, ts, delay, flag, max(within, cell or CELLS * within), within, buckets)
    out = rows.groupBy("bucket", "cell").transformWithState(
        SequenceWithin(typed, within, interrupted), f"id {typed}, kind string, first long, second long",
        "append", "EventTime")
    return out.select(key_of(F.col("id"), df.schema[key].dataType).alias(key), "kind", instant("first").alias("first_ts"),
                      instant("second").alias("second_ts"))


class OrderTimeout(InOrder):
    """Memory of a key: the open create event, if any."""

    def __init__(self, id_type: str, within: float):
        super().__init__(id_type)
        self.within = round(within * 1e6)

    def event(self, id, page, key, at, flag, memory):
        yield from self.passed(id, page, key, at - 1, memory)
        memory.clear()
        if flag & BORDER:
            return
        if flag == SECOND:
            yield Row(id=id, kind="paid", at=at)
        else:
            memory.append((at,))

    def passed(self, id, page, key, reached, memory):
        # a payment at the very deadline still counts
        if memory and reached >= memory[0][0] + self.within:
            yield Row(id=id, kind="timeout", at=memory.pop()[0] + self.within)

    def deadlines(self, memory):
        return [m[0] + self.within + 1000 for m in memory]


def order_timeout(df: DataFrame, key: str, ts: str, create: Column, pay: Column, within: float,
                  delay: str = "0 seconds", cell: float | None = None,
                  buckets: int = BUCKETS) -> DataFrame:
    """Streaming form of ``operators.patterns.order_timeout``; ``cell`` as for ``sequence_within``."""
    typed = id_type(df.schema[key].dataType).simpleString()
    flag = F.when(pay, SECOND).otherwise(FIRST)
    rows = _by_key(df.where(create | pay), key, ts, delay, flag, max(within, cell or CELLS * within), within, buckets)
    out = rows.groupBy("bucket", "cell").transformWithState(
        OrderTimeout(typed, within), f"id {typed}, kind string, at long", "append", "EventTime")
    return out.select(key_of(F.col("id"), df.schema[key].dataType).alias(key), "kind", instant("at").alias("at"))
