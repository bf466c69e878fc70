"""Running computations over the ordered rows of each key, balanced when one key is huge.

``Window.partitionBy(key)`` puts every row of a key in one task. Here a key with more rows
than ``rows_per_slice`` is cut along its ordering column into slices, the window runs inside
(key, slice), and what earlier or later slices contribute is carried over from one summary row
per slice. Results are those of the plain window.

Whether there is such a key is found first, by a count per key that reads the key columns only and is combined map-side.
Where there is none, what runs is the plain window: one shuffle, one sort, no joins. Otherwise the bounds of the
slices are worked out once, from the hot keys' rows only, and kept; the rows are still shuffled once, by (key, slice).

Sizes: a key is cut only above ``rows_per_slice`` rows, so at most ``N / rows_per_slice`` keys and
``2 * SPLIT * N / rows_per_slice`` bounds of eight bytes are joined in (10^12 rows at the default:
200,000 keys, 800,000 bounds), after a check of their bytes, and so many summary rows. These are hinted for a broadcast only if
what they carry has a fixed width; carried payloads are left to Spark's own measure. A key has ``GRID``
slices at most: beyond ``GRID / SPLIT * rows_per_slice`` rows (5 * 10^9) its slices grow with it.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.dates import place
from tidemark.functions.sizes import small_side
from tidemark.session import written

ROWS_PER_SLICE = 5_000_000
SPLIT = 2   # slices per ROWS_PER_SLICE rows, to absorb the error of the quantiles
GRID = 2048  # most slices of one key

SLICE = "_tl_slice"


@dataclass(frozen=True)
class Running:
    """One running column: inside a slice, per slice, across slices, and put together."""

    local: Callable[[Window], Column]
    summary: Callable[[Column], Column]
    carry: Callable[[Column, Window], Column]
    merge: Callable[[Column, Column], Column]
    tail: int = 0  # summary needs the last rows of the slice, not an aggregate


def _before(window):
    return window.rowsBetween(Window.unboundedPreceding, -1)


def running_sum(value: Column) -> Running:
    """Sum up to and including the row; rows with equal order count together."""
    return Running(
        local=lambda w: F.sum(value).over(w),
        summary=lambda order: F.sum(value),
        carry=lambda s, w: F.sum(s).over(_before(w)),
        merge=lambda here, earlier: F.when(earlier.isNull(), here).otherwise(
            F.coalesce(here, F.lit(0)) + earlier),
    )


def row_number() -> Running:
    return Running(
        local=lambda w: F.row_number().over(w),
        summary=lambda order: F.count(F.lit(1)),
        carry=lambda s, w: F.sum(s).over(_before(w)),
        merge=lambda here, earlier: here + F.coalesce(earlier, F.lit(0)),
    )


def max_before(value: Column) -> Running:
    """Largest value on strictly earlier rows, null on the first."""
    return Running(
        local=lambda w: F.max(value).over(_before(w)),
        summary=lambda order: F.max(value),
        carry=lambda s, w: F.max(s).over(_before(w)),
        merge=F.greatest,
    )


def previous(value: Column) -> Running:
    """The value on the row before, null if there is none. The value must not be null; wrap one
    that may be in a struct."""
    return Running(
        local=lambda w: F.lag(value).over(w),
        summary=lambda order: F.max_by(value, order),
        carry=lambda s, w: F.lag(s).over(w),
        merge=F.coalesce,
    )


def following(value: Column) -> Running:
    """The value on the row after, null if there is none; as for ``previous``."""
    return Running(
        local=lambda w: F.lead(value).over(w),
        summary=lambda order: F.min_by(value, order),
        carry=lambda s, w: F.lead(s).over(w),
        merge=F.coalesce,
    )


def latest(value: Column) -> Running:
    """Last non-null value up to and including the row."""
    return Running(
        local=lambda w: F.last(value, ignorenulls=True).over(
            w.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        summary=lambda order: F.max_by(value, F.when(value.isNotNull(), order)),
        carry=lambda s, w: F.last(s, ignorenulls=True).over(_before(w)),
        merge=F.coalesce,
    )


def recent(value: Column, n: int) -> Running:
    """Up to ``n`` values on the rows before, oldest first. Values must not be null."""
    def newest(values: Column) -> Column:
        return F.slice(values, F.greatest(F.size(values) - n + 1, F.lit(1)), F.lit(n))

    return Running(
        local=lambda w: F.collect_list(value).over(w.rowsBetween(-n, -1)),
        summary=lambda order: F.transform(
            F.array_sort(F.collect_list(F.struct(order.alias("at"), value.alias("v")))),
            lambda row: row["v"]),
        # every slice has a row, so the last n rows lie in the last n slices
        carry=lambda s, w: F.flatten(F.collect_list(s).over(w.rowsBetween(-n, -1))),
        merge=lambda here, earlier: F.when(earlier.isNull(), here).otherwise(
            newest(F.concat(earlier, here))),
        tail=n,
    )


def _same(pairs: Sequence[tuple[str, str]]) -> Column:
    """Null-safe equality: a null key is a key like any other, and often the hot one."""
    return reduce(and_, [F.col(a).eqNullSafe(F.col(b)) for a, b in pairs], F.lit(True))


def _fixed_width(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_fixed_width(f.dataType) for f in kind)
    return not isinstance(kind, (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.VariantType))


class Timeline:
    """The rows of ``df``, ordered per key. ``order_by`` is ascending; its first column is cut
    into slices, the others only break ties.

    ``counted``: a table to count keys on in place of ``df``, cheaper to read, with some of the key columns and at least as many
    rows for each of their values; by default ``df``."""

    def __init__(self, df: DataFrame, keys: Sequence[str], order_by: Sequence[str],
                 rows_per_slice: int = ROWS_PER_SLICE, counted: DataFrame | None = None):
        self.keys, self.order_by, self.rows_per_slice = list(keys), list(order_by), rows_per_slice
        self._df, self.sliced = self._cut(df, df if counted is None else counted)

    def _cut(self, df: DataFrame, counted: DataFrame) -> tuple[DataFrame, bool]:
        """Number the slices of hot keys, null for all others. Slices are of equal size however the rows lie: their bounds are
        quantiles of the ordering column."""
        by = [k for k in self.keys if k in counted.columns]
        many = F.count(F.lit(1)).alias("rows")
        most = counted.groupBy(*by).agg(many).agg(F.max("rows")).first()[0] or 0
        if most <= self.rows_per_slice:
            return df, False
        parts = min(math.ceil(most / self.rows_per_slice) * SPLIT, GRID)
        at = place(df, self.order_by[0])
        if self.keys:
            hot = written(df.groupBy(*self.keys).agg(many).where(F.col("rows") > self.rows_per_slice).select(
                *[F.col(k).alias(f"_tl_hot_{k}") for k in self.keys], "rows"), "hot-keys")
            on = _same([(k, f"_tl_hot_{k}") for k in self.keys])
            rows = df.select(*self.keys, at.alias("_tl_at")).join(small_side(hot), on)
            bounds = rows.groupBy(*hot.columns).agg(self._quantiles(min(4 * parts, GRID)))
            bounds = written(bounds.select(*[c for c in hot.columns if c != "rows"], self._bounds(min(4 * parts, GRID))), "bounds")
            df = df.join(small_side(bounds), on, "left")
            cut = F.col("_tl_bounds")
        else:
            found = df.select(at.alias("_tl_at")).agg(self._quantiles(parts)).first()[0] or []
            cut = F.lit([float(b) for b in sorted(set(found))]).cast("array<double>")
        # the number of bounds passed, found among every 64th first
        step = 64
        coarse = F.size(F.filter(F.sequence(F.lit(1), F.size(cut), F.lit(step)), lambda i: F.get(cut, i - 1) <= at))
        begin = F.greatest(coarse - 1, F.lit(0)) * step
        nth = begin + F.size(F.filter(F.slice(cut, begin + 1, step), lambda b: b <= at))
        number = F.when(F.size(cut) > 0, F.when(at.isNull(), F.lit(0)).otherwise(nth)).when(cut.isNotNull(), F.lit(0))
        gone = ["_tl_bounds", *[f"_tl_hot_{k}" for k in self.keys]]
        return df.withColumn(SLICE, number.cast("long")).drop(*gone), True

    @staticmethod
    def _quantiles(grid: int) -> Column:
        shares = [i / grid for i in range(1, grid)]
        return F.percentile_approx("_tl_at", F.lit(shares), F.lit(max(4 * grid, 1000))).alias("_tl_grid")

    def _bounds(self, grid: int) -> Column:
        """Where the slices of a key begin, ascending and distinct: ``SPLIT`` parts for every ``rows_per_slice`` rows."""
        parts = F.least(F.ceil(F.col("rows") / self.rows_per_slice) * SPLIT, F.lit(grid)).cast("int")
        picked = F.transform(F.sequence(F.lit(1), parts - 1), lambda i: F.get(
            "_tl_grid", F.floor(i * grid / parts).cast("int") - 1))
        return F.array_sort(F.array_distinct(F.filter(picked, lambda b: b.isNotNull()))).alias("_tl_bounds")

    def _with(self, df: DataFrame) -> Timeline:
        other = object.__new__(Timeline)
        other.__dict__.update(self.__dict__, _df=df)
        return other

    def derive(self, **columns: Column) -> Timeline:
        """Add row-wise columns."""
        return self._with(self._df.withColumns(columns))

    def running(self, **columns: Running) -> Timeline:
        """Add running columns."""
        if not self.sliced:
            plain = Window.partitionBy(*self.keys).orderBy(*self.order_by)
            return self._with(self._df.withColumns({n: c.local(plain) for n, c in columns.items()}))
        within = [*self.keys, SLICE]
        here = Window.partitionBy(*within).orderBy(*self.order_by)
        across = Window.partitionBy(*self.keys).orderBy(SLICE)
        local = self._df.withColumns({f"_tl_here_{n}": c.local(here) for n, c in columns.items()})
        carried = self._summaries(columns).select(
            *[F.col(k).alias(f"_tl_from_{k}") for k in within],
            *[c.carry(F.col(f"_tl_sum_{n}"), across).alias(f"_tl_far_{n}") for n, c in columns.items()],
        )
        if all(_fixed_width(f.dataType) for f in carried.schema):
            carried = F.broadcast(carried)
        joined = local.join(carried, _same([(k, f"_tl_from_{k}") for k in within]), "left")
        merged = joined.withColumns({
            n: c.merge(F.col(f"_tl_here_{n}"), F.col(f"_tl_far_{n}")) for n, c in columns.items()})
        helpers = [f"_tl_from_{k}" for k in within]
        helpers += [f"{p}_{n}" for n in columns for p in ("_tl_here", "_tl_far")]
        return self._with(merged.drop(*helpers))

    def _summaries(self, columns: dict[str, Running]) -> DataFrame:
        """One row per slice of the cut keys."""
        within = [*self.keys, SLICE]
        cut = self._df.where(F.col(SLICE).isNotNull())
        tail = max(c.tail for c in columns.values())
        if tail:
            if any(c.tail == 0 for c in columns.values()):
                raise ValueError("ask for recent() columns in a running() call of their own")
            newest = Window.partitionBy(*within).orderBy(*[F.desc(c) for c in self.order_by])
            cut = cut.withColumn("_tl_back", F.row_number().over(newest)).where(F.col("_tl_back") <= tail)
        # a plain column keeps max_by in a hash aggregate, a struct would need a sort
        order = F.col(self.order_by[0]) if len(self.order_by) == 1 else F.struct(*self.order_by)
        return cut.groupBy(*within).agg(
            *[c.summary(order).alias(f"_tl_sum_{n}") for n, c in columns.items()])

    @property
    def rows(self) -> DataFrame:
        return self._df.drop(SLICE)
