"""Vectors compressed to codes: a codebook for each of several parts, searched by equal averages.

A part and an entry with component sums S and T are at least (S - T)^2 / d apart, d being the number of components. The entries
of a codebook are sorted by their sum; the search starts at the part's own sum and goes outward on both sides. A side ends when
this bound strictly exceeds the best distance so far, so the entry found is the nearest, and of equally near ones
the first. All arithmetic is on integers.

Vectors stay spread over the tasks: each round reads them once with the codebooks (256 entries a part, so their size is
fixed), and a row of sums for every entry a task met is shuffled.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.integer_vectors import averaged, matrix, totals, whole_numbers
from tidemark.llm.text import arrow_map
from tidemark.session import written

BLOCK = 8192


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest row of ``entries`` for each row of ``parts``, ties to the lower index, and the squared distance."""
    width = entries.shape[1]
    order = np.argsort(entries.sum(axis=1), kind="stable")
    book, sums = entries[order], entries.sum(axis=1)[order]
    own = parts.sum(axis=1)
    best = np.full(len(parts), 2**62 // max(width, 1), np.int64)
    index = np.full(len(parts), len(entries), np.int64)
    begin = np.searchsorted(sums, own)
    sides = [(1, begin, np.arange(len(parts))), (-1, begin - 1, np.arange(len(parts)))]
    while any(len(rows) for _, _, rows in sides):
        for side, (step, at, rows) in enumerate(sides):
            inside = (at >= 0) & (at < len(sums))
            at, rows = at[inside], rows[inside]
            gap = sums[at] - own[rows]
            going = gap * gap <= width * best[rows]
            at, rows = at[going], rows[going]
            apart = parts[rows] - book[at]
            d = np.einsum("ij,ij->i", apart, apart)
            better = (d < best[rows]) | ((d == best[rows]) & (order[at] < index[rows]))
            best[rows[better]], index[rows[better]] = d[better], order[at[better]]
            sides[side] = (step, at + step, rows)
    return index, best


def assign(x: np.ndarray, books: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Entry and squared distance of every part: (rows, parts) each."""
    width = x.shape[1] // len(books)
    index = np.empty((len(x), len(books)), np.int64)
    distance = np.empty_like(index)
    for at in range(0, len(x), BLOCK):
        for p, book in enumerate(books):
            rows = slice(at, at + BLOCK)
            index[rows, p], distance[rows, p] = nearest(x[rows, p * width:(p + 1) * width], book)
    return index, distance


def _first_entries(kept: DataFrame, entries: int) -> list[list[int]]:
    """The vectors of the smallest ids, ascending, a null id last; of an id that occurs more than once, its smallest vector."""
    id_ = F.col("vec_id")
    ids = [r[0] for r in kept.select(id_).distinct().orderBy(id_.asc_nulls_last()).limit(entries).collect()]
    chosen = id_.isin([i for i in ids if i is not None])
    if None in ids:
        chosen = F.coalesce(chosen, F.lit(True))
    first = {r[0]: list(r[1]) for r in kept.where(chosen).groupBy(id_).agg(F.min("vector")).collect()}
    return [first[i] for i in ids]


def compress(vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024,
             length: int | None = None) -> DataFrame:
    """Rows (``vec_id``, ``label``, ``vector`` as integers, ``code``, ``error``, ``codebooks_sha256``) of ``vectors``
    (vec_id, label, vector).

    Components are floor(``scale`` * x); vectors are cut into ``parts`` consecutive parts. The codebooks start as the parts of
    the ``entries`` smallest ids and are improved in ``rounds`` rounds; ``code`` holds two hex digits for each part, so
    ``entries`` is at most 256. ``error`` is the squared distance summed over the parts.

    Left out: vectors that are null, hold null or non-finite components or any of 2^24 or more after scaling, and
    vectors of another length than ``length``, by default the most frequent length that can be cut (of equally frequent
    ones the greatest). Rows with a null id are coded too, equal rows stay separate rows, an empty table gives no rows."""
    if not 0 < entries <= 256:
        raise ValueError("two hex digits name 256 entries")
    kept = written(vectors.select("vec_id", "label", whole_numbers("vector", scale).alias("vector")).where(
        F.col("vector").isNotNull() & (F.size("vector") % parts == 0) & (F.size("vector") > 0)), "code-vectors")
    if length is None:
        size = F.size("vector").alias("length")
        most = kept.groupBy(size).count().orderBy(F.desc("count"), F.desc("length")).first()
        length = most["length"] if most else parts
    kept = kept.where(F.size("vector") == length)
    start = np.array(_first_entries(kept, entries), np.int64).reshape(-1, length)
    width = length // parts
    books = [start[:, p * width:(p + 1) * width] for p in range(parts)]
    for _ in range(rounds if len(start) else 0):
        found = totals(kept, lambda x, books=books: assign(x, books)[0], length, parts, len(start))
        books = [averaged(book, p, found) for p, book in enumerate(books)]

    def encode(batch: pa.RecordBatch) -> dict:
        index, distance = assign(matrix(batch.column("vector"), length), books)
        return {"code": pa.array([bytes(i).hex() for i in index.astype(np.uint8)], pa.string()),
                "error": distance.sum(axis=1)}

    digest = hashlib.sha256(",".join(str(x) for book in books for x in book.ravel().tolist()).encode()).hexdigest()
    coded = arrow_map(kept, encode, ["vec_id", "label", "vector"], "code string, error long")
    return coded.withColumn("codebooks_sha256", F.lit(digest))


def errors(coded: DataFrame) -> DataFrame:
    """Add ``label_error``: ``error`` summed over equal labels, nulls together. Labels are summed before they are joined, so
    one that holds a third of all rows is one row of sums; adaptive execution splits its rows in the join."""
    coded = written(coded.drop("vector"), "codes")
    sums = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    return coded.join(sums, F.col("label").eqNullSafe(F.col("_label"))).drop("_label")
