"""User-written aggregates that combine before the shuffle."""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence
from typing import Any

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Aggregate:
    """An aggregate Spark has no function for. The accumulator may be any picklable value and
    should stay small: one per key and task is shuffled."""

    def create(self) -> Any:
        raise NotImplementedError

    def add(self, acc: Any, rows: pd.DataFrame) -> Any:
        """Take in a batch of rows of one key."""
        raise NotImplementedError

    def merge(self, a: Any, b: Any) -> Any:
        raise NotImplementedError

    def result(self, acc: Any) -> tuple:
        """Values in the order of the declared result columns."""
        raise NotImplementedError


def user_aggregate(df: DataFrame, keys: Sequence[str], values: Sequence[str], agg: Aggregate,
                   result: str, max_keys: int = 50_000, fan: int = 64) -> DataFrame:
    """``agg`` per key; ``result`` declares its columns as DDL.

    Each task keeps one accumulator per key (at most ``max_keys``, then it hands them on), so a
    key with a third of all rows sends a few accumulators per task, not its rows. They are merged in
    two levels, first in ``fan`` groups by the task they come from, so that no group has an accumulator of
    every task. A grouped pandas UDF would bring all rows of the key into one task.
    """
    keys = list(keys)
    key_fields = [T.StructField(k, df.schema[k].dataType) for k in keys]

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple, Any] = {}
        for batch in batches:
            for key, rows in batch.groupby(keys, dropna=False, sort=False):
                key = tuple(None if pd.isna(k) else k for k in key)
                held[key] = agg.add(held[key] if key in held else agg.create(), rows)
            if len(held) > max_keys:
                yield packed(held)
                held = {}
        if held:
            yield packed(held)

    def packed(held: dict[tuple, Any]) -> pd.DataFrame:
        out = pd.DataFrame({k: pd.Series([key[i] for key in held], dtype=object)
                            for i, k in enumerate(keys)})
        return out.assign(_acc=[pickle.dumps(a) for a in held.values()],
                          _part=TaskContext.get().partitionId() % fan)

    names = T.StructType.fromDDL(result).names

    def merged(rows: pd.DataFrame) -> Any:
        acc = pickle.loads(rows["_acc"].iloc[0])
        for other in rows["_acc"].iloc[1:]:
            acc = agg.merge(acc, pickle.loads(other))
        return acc

    def middle(rows: pd.DataFrame) -> pd.DataFrame:
        return rows[keys].head(1).assign(_acc=pickle.dumps(merged(rows)))

    def final(rows: pd.DataFrame) -> pd.DataFrame:
        return rows[keys].head(1).assign(**dict(zip(names, agg.result(merged(rows)))))

    held_fields = [*key_fields, T.StructField("_acc", T.BinaryType())]
    partials = df.select(*keys, *values).mapInPandas(
        partial, T.StructType([*held_fields, T.StructField("_part", T.IntegerType())]))
    by = [F.col(k) for k in keys]
    schema = T.StructType([*key_fields, *T.StructType.fromDDL(result).fields])
    return partials.groupBy(*by, "_part").applyInPandas(middle, T.StructType(held_fields)).groupBy(*by).applyInPandas(
        final, schema)
