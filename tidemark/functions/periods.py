"""Rolling report periods: the last 1, 7 and 30 days."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import Day, iso

PERIODS = (1, 7, 30)


def recent_days(df: DataFrame, day: Day, periods: Sequence[int] = PERIODS,
                dt: str = "dt", name: str = "recent_days") -> DataFrame:
    """One copy of each row per period ``n`` holding it, ``day-(n-1) <= dt <= day``.

    The outer bound is stated as a plain filter: Catalyst does not push a filter on the
    generated period below the generator, so ``dt`` partitions would not be pruned. Only the
    periods that hold the row are generated; a row six days old is copied twice, not three times.
    """
    col = F.col(dt)
    held = F.array_compact(F.array(*[
        F.when(col >= F.lit(iso(day, 1 - n)), F.lit(n)) for n in periods]))
    return (
        df.where(col.between(F.lit(iso(day, 1 - max(periods))), F.lit(iso(day))))
        .withColumn(name, F.explode(held))
    )


def unpivot_periods(df: DataFrame, ids: Sequence[str | Column],
                    measures: Mapping[str, Mapping[int, str]],
                    name: str = "recent_days") -> DataFrame:
    """Wide ``x_7d, x_30d`` columns to one row per period.

    ``measures`` maps each output column to its source column per period.
    """
    periods = sorted({n for by_period in measures.values() for n in by_period})
    cells: list[Column] = []
    for n in periods:
        cells.append(F.lit(n))
        cells += [F.col(by_period[n]) for by_period in measures.values()]
    return df.select(*ids, F.stack(F.lit(len(periods)), *cells).alias(name, *measures))


def count_in_periods(df: DataFrame, date: str, day: Day, out: str,
                     periods: Sequence[int] = PERIODS) -> DataFrame:
    """Rows whose ``date`` lies in each period. Periods nest, so one pass of conditional sums
    replaces copying every row once per period."""
    inside = F.col(date) <= F.lit(iso(day))
    sums = df.agg(*[
        F.count(F.when(inside & (F.col(date) >= F.lit(iso(day, 1 - n))), 1)).alias(f"_{n}")
        for n in periods])
    return unpivot_periods(sums, [], {out: {n: f"_{n}" for n in periods}})
