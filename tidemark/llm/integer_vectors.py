"""Vectors as whole numbers, and rounds of assigning and averaging them: shared by the two vector codings."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import Batches

#: Components beyond this size (after scaling) could overflow squared sums of 64-bit integers.
LARGEST = 2**24


def whole_numbers(vector: str, scale: int) -> Column:
    """floor(scale * x) of every component as an array of int; null where the vector is null, holds null or non-finite
    components, or any beyond ``LARGEST`` after scaling."""
    scaled = F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * scale))
    usable = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * scale) < LARGEST))
    return F.when(F.coalesce(usable, F.lit(False)), scaled.cast("array<int>"))


def matrix(column: pa.Array, length: int) -> np.ndarray:
    """A column of arrays of one length as a matrix of 64-bit integers."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.int64).reshape(len(column), length)


def totals(vectors: DataFrame, assign: Callable[[np.ndarray], np.ndarray], length: int, parts: int, entries: int
           ) -> dict[tuple[int, int], tuple[int, list[int]]]:
    """By (part, entry): how many parts of ``vectors`` were assigned to it, and their componentwise sum. ``assign`` gives
    the entry of each part, (rows, parts). Every task adds up what it reads; a row for each of its entries is shuffled, and
    the result has ``parts * entries`` rows at most."""
    width = length // parts

    def run(batches: Batches) -> Batches:
        count = np.zeros(parts * entries, np.int64)
        total = np.zeros((parts * entries, width), np.int64)
        for batch in batches:
            x = matrix(batch.column("vector"), length)
            slot = assign(x) + np.arange(parts) * entries
            count += np.bincount(slot.ravel(), minlength=len(count))
            np.add.at(total, slot.ravel(), x.reshape(-1, width))
        used = np.flatnonzero(count)
        sums = pa.ListArray.from_arrays(np.arange(0, len(used) * width + 1, width, dtype=np.int32), total[used].ravel())
        yield pa.RecordBatch.from_pydict({"slot": pa.array(used, pa.int64()), "n": pa.array(count[used]), "sums": sums})

    made = vectors.select("vector").mapInArrow(run, "slot long, n long, sums array<long>")
    added = made.groupBy("slot").agg(F.sum("n").alias("n"), *[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(width)])
    return {divmod(r[0], entries): (r[1], list(r[2:])) for r in added.collect()}


def averaged(entries: np.ndarray, part: int, found: dict[tuple[int, int], tuple[int, list[int]]]) -> np.ndarray:
    """Entries replaced by floor(sum / count) of what was assigned to them; unused ones stay."""
    new = entries.copy()
    for i in range(len(entries)):
        if (part, i) in found:
            n, sums = found[part, i]
            new[i] = [s // n for s in sums]
    return new
