"""Centroid clustering with progressive search over Walsh-Hadamard coefficients.

The transform of integer vectors by a matrix of +1 and -1 is exact, and squared distances of transformed vectors are the original
ones times the length. Coefficients are ordered by their number of sign changes, coarse to fine, so most of a distance is in the
first few. For each vector, one promising centroid is finished first; the others add up coefficient differences level by level,
and a centroid is given up once its sum is strictly above the best distance so far. Those that finish all coefficients
have exact distances; of equal ones the smaller number is taken.

Centroids are a fixed few that travel with the tasks; each round reads the vectors once and shuffles a row of sums for every
centroid a task met.
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

BLOCK = 4096


def transformed(x: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of every row (a power of two long), coefficients by rising number of sign changes."""
    n = x.shape[1]
    y, half = x.copy(), 1
    while half < n:
        pairs = y.reshape(len(y), n // (2 * half), 2, half)
        y = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(y), n)
        half *= 2
    return y[:, _coarse_first(n)]


def _coarse_first(n: int) -> np.ndarray:
    at = np.arange(n)
    signs = np.bitwise_count(at[:, None] & at[None, :]) & 1
    return np.argsort((signs[:, 1:] != signs[:, :-1]).sum(axis=1), kind="stable")


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid of each row, ties to the smaller number, and its squared distance."""
    index, distance = np.empty(len(x), np.int64), np.empty(len(x), np.int64)
    coarse = transformed(centroids)
    for at in range(0, len(x), BLOCK):
        index[at:at + BLOCK], distance[at:at + BLOCK] = _progressive(transformed(x[at:at + BLOCK]), coarse)
    return index, distance // x.shape[1]


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = a - b
    return np.einsum("ij,ij->i", d, d)


def _progressive(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n, length = x.shape
    k = len(centroids)
    row, number = np.repeat(np.arange(n), k), np.tile(np.arange(k), n)
    level = max(1, length // 16)
    sums = _apart(x[row, :level], centroids[number, :level])
    # the one that is nearest by its coarsest coefficients is finished first
    first = sums.reshape(n, k).argmin(axis=1)
    best = _apart(x, centroids[first])
    while level < length:
        alive = sums <= best[row]
        row, number, sums = row[alive], number[alive], sums[alive]
        finer = min(2 * level, length)
        sums = sums + _apart(x[row, level:finer], centroids[number, level:finer])
        level = finer
        if level == length:
            np.minimum.at(best, row, sums)
    found = sums == best[row]
    index = np.full(n, k, np.int64)
    np.minimum.at(index, row[found], number[found])
    return index, best


def cluster(vectors: DataFrame, length: int = 64, centroids: int = 16, rounds: int = 3, scale: int = 64, seed: str = "1"
            ) -> tuple[DataFrame, np.ndarray]:
    """Rows (``vec_id``, ``vector`` as integers, ``cluster``, ``distance``) of ``vectors`` (vec_id, vector), and the
    centroids.

    Components are floor(``scale`` * x). Centroids start as the rows with the smallest sha256 of ``seed:vec_id`` (a null id
    reads ``null``; of equal ids the smaller vector first) and are improved in ``rounds`` rounds; a cluster without vectors keeps its centroid.
    ``length`` is a power of two. Left out: vectors that are null, of another length, or that hold null or non-finite
    components or any of 2^24 or more after scaling. Equal rows stay separate rows; fewer rows than ``centroids`` make
    fewer centroids, an empty table no rows."""
    if length & (length - 1):
        raise ValueError("the transform needs a power of two")
    kept = written(vectors.select("vec_id", whole_numbers("vector", scale).alias("vector")).where(
        F.size("vector") == length), "cluster-vectors")
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("null"))), 256)
    start = kept.select(order.alias("key"), "vector").orderBy("key", "vector").limit(centroids).collect()
    book = np.array([r.vector for r in start], np.int64).reshape(-1, length)
    for _ in range(rounds if len(book) else 0):
        found = totals(kept, lambda x, book=book: nearest(x, book)[0][:, None], length, 1, len(book))
        book = averaged(book, 0, found)

    def label(batch: pa.RecordBatch) -> dict:
        index, distance = nearest(matrix(batch.column("vector"), length), book)
        return {"cluster": index.astype(np.int32), "distance": distance}

    return arrow_map(kept, label, ["vec_id", "vector"], "cluster int, distance long"), book


def inertias(clustered: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(``vec_id``, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia``, ``centroid_sha256``): distances summed over the
    cluster and over all rows, and the digest of the centroid. A row per cluster is broadcast, as many as there are centroids."""
    rows = written(clustered.select("vec_id", "cluster", "distance"), "clusters")
    each = dict(rows.groupBy("cluster").agg(F.sum("distance")).collect())
    total = sum(each.values())
    shown = [(c, sum_, total, hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest())
             for c, sum_ in each.items()]
    sums = rows.sparkSession.createDataFrame(shown, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(sums), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
