"""Approximate nearest neighbours on robustly pruned directed graphs.

Distinct vectors are dealt to shards by hash. Each shard builds a directed graph: a beam search from
the shard's middle over the graph so far proposes neighbours of a new vector; they are taken nearest
first, and whatever is nearer to a taken one (times ``alpha``) than to the vector is dropped, which
keeps long, diverse edges. Queries are sent to every shard in blocks and answered by beam search;
the best of all shards are merged.

Largest inner product is turned into smallest distance by one more component that gives all vectors
the same norm. Equal vectors are one node that stands for its smallest ids, so a vector that holds a
third of all rows is one node too.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.text import Batches
from tidemark.session import written


@dataclass(frozen=True)
class Graph:
    """degree: edges a node keeps; beam: nodes a search keeps; alpha: how much shorter a detour must be for an edge to
    be dropped; shards: at least so many; rows: most vectors of a shard."""

    degree: int = 32
    beam: int = 64
    alpha: float = 1.2
    shards: int = 12
    rows: int = 20_000
    batch: int = 512


def _search(points: np.ndarray, edges: np.ndarray, entry: int, queries: np.ndarray, beam: int,
            expand: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """Greedy beam search for all queries at once: the nodes found, nearest first, and their squared distances. Missing
    ones have node -1. ``edges`` is padded with -1."""
    q, n = len(queries), len(points)
    norm = np.einsum("ij,ij->i", points, points)
    node = np.full((q, beam), -1, np.int64)
    dist = np.full((q, beam), np.inf, np.float32)
    done = np.ones((q, beam), bool)
    node[:, 0], done[:, 0] = entry, False
    dist[:, 0] = norm[entry] - 2 * (queries @ points[entry])
    seen = np.zeros((q, n), bool)
    seen[:, entry] = True
    live = np.arange(q)
    while len(live):
        open_dist = np.where(done[live], np.inf, dist[live])
        pick = np.argpartition(open_dist, min(expand, beam) - 1, axis=1)[:, :expand]
        some = np.take_along_axis(open_dist, pick, 1) < np.inf
        going = some.any(axis=1)
        live, pick, some = live[going], pick[going], some[going]
        if not len(live):
            break
        chosen = np.where(some, node[live[:, None], pick], -1)
        done[live[:, None], pick] = True
        near = np.where((chosen >= 0)[..., None], edges[chosen], -1).reshape(len(live), -1)
        near = np.sort(near, axis=1)
        fresh = near >= 0
        fresh[:, 1:] &= near[:, 1:] != near[:, :-1]
        fresh &= ~seen[live[:, None], near]
        r, c = np.nonzero(fresh)
        found = near[r, c]
        seen[live[r], found] = True
        d = norm[found] - 2 * np.einsum("ij,ij->i", queries[live[r]], points[found])
        width = int(np.bincount(r, minlength=len(live)).max()) if len(r) else 0
        if not width:
            continue
        slot = np.arange(len(r)) - np.searchsorted(r, np.arange(len(live)))[r]
        new_node = np.full((len(live), width), -1, np.int64)
        new_dist = np.full((len(live), width), np.inf, np.float32)
        new_node[r, slot], new_dist[r, slot] = found, d
        all_node = np.concatenate([node[live], new_node], axis=1)
        all_dist = np.concatenate([dist[live], new_dist], axis=1)
        all_done = np.concatenate([done[live], new_node < 0], axis=1)
        best = np.argpartition(all_dist, beam - 1, axis=1)[:, :beam]
        node[live], dist[live], done[live] = (np.take_along_axis(x, best, 1) for x in (all_node, all_dist, all_done))
    order = np.argsort(dist, axis=1, kind="stable")
    return np.take_along_axis(node, order, 1), np.take_along_axis(dist, order, 1)


def _prune(points: np.ndarray, of: np.ndarray, candidates: np.ndarray, alpha: float, degree: int) -> np.ndarray:
    """For every node in ``of`` the diverse nearest of its candidates (-1: none), at most ``degree``."""
    at = np.sort(candidates, axis=1)
    at[:, 1:][at[:, 1:] == at[:, :-1]] = -1
    at[at == of[:, None]] = -1
    vectors = points[at]
    offset = vectors - points[of][:, None]
    dist = np.where(at >= 0, np.einsum("qcd,qcd->qc", offset, offset), np.inf)
    norm = np.einsum("qcd,qcd->qc", vectors, vectors)
    rows = np.arange(len(of))
    out = np.full((len(of), degree), -1, np.int64)
    for k in range(degree):
        best = dist.argmin(axis=1)
        alive = np.isfinite(dist[rows, best])
        if not alive.any():
            break
        out[alive, k] = at[alive, best[alive]]
        star = vectors[rows, best]
        between = norm + norm[rows, best][:, None] - 2 * np.einsum("qcd,qd->qc", vectors, star)
        dist[(alpha * alpha * between <= dist) | ~alive[:, None]] = np.inf
        dist[rows, best] = np.inf
    return out


def build_graph(points: np.ndarray, how: Graph) -> tuple[np.ndarray, int]:
    """Edges (padded with -1) and the entry node. Vectors are inserted in batches that double up to ``how.batch``."""
    n = len(points)
    edges = np.full((n, how.degree), -1, np.int64)
    middle = points.mean(axis=0)
    entry = int(((points - middle) ** 2).sum(axis=1).argmin())
    order = np.random.default_rng(7).permutation(n)
    order = np.concatenate([[entry], order[order != entry]])
    at = 1
    while at < n:
        new = order[at:at + min(at, how.batch)]
        at += len(new)
        found, _ = _search(points, edges, entry, points[new], how.beam)
        # vectors of one batch do not find each other in the graph: their nearest in the batch are candidates too
        inside = points[new] @ points[new].T
        own = np.einsum("ij,ij->i", points[new], points[new])
        few = min(8, len(new))
        near = new[np.argpartition(own[None, :] - 2 * inside, few - 1, axis=1)[:, :few]]
        edges[new] = _prune(points, new, np.concatenate([found, near], axis=1), how.alpha, how.degree)
        # edges back, pruned where a node has too many
        source = np.repeat(new, how.degree)
        target = edges[new].ravel()
        source, target = source[target >= 0], target[target >= 0]
        by = np.argsort(target, kind="stable")
        source, target = source[by], target[by]
        nodes, first, count = np.unique(target, return_index=True, return_counts=True)
        for a in range(0, len(nodes), 4 * how.batch):
            some = slice(a, a + 4 * how.batch)
            width = int(count[some].max())
            rank = np.arange(width)
            index = np.minimum(first[some][:, None] + rank, len(source) - 1)
            back = np.where(rank < count[some][:, None], source[index], -1)
            both = np.sort(np.concatenate([edges[nodes[some]], back], axis=1), axis=1)
            both[:, 1:][both[:, 1:] == both[:, :-1]] = -1
            over = (both >= 0).sum(axis=1) > how.degree
            simple = -np.sort(-both[~over], axis=1)[:, :how.degree]
            edges[nodes[some][~over]] = np.pad(simple, ((0, 0), (0, how.degree - simple.shape[1])), constant_values=-1)
            if over.any():
                edges[nodes[some][over]] = _prune(points, nodes[some][over], both[over], how.alpha, how.degree)
    return edges, entry


def usable(vector: Column) -> Column:
    """Not null, of finite components, not all zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(fine, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def distinct_vectors(vectors: DataFrame, keep: int) -> DataFrame:
    """(``vector``, ``ids``): every distinct vector once, with its ``keep`` smallest ids: more of one vector cannot be among
    the nearest. The limit per vector is applied before the shuffle, so a frequent vector is not a hot key."""
    rank = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    few = vectors.withColumn("rank", rank).where(F.col("rank") <= keep)
    return few.groupBy("vector").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))


def _lifted(vectors: np.ndarray, largest: float) -> np.ndarray:
    """Scaled by the largest norm, with a component that makes all norms one."""
    unit = vectors.astype(np.float64) / largest
    rest = np.sqrt(np.maximum(0, 1 - np.einsum("ij,ij->i", unit, unit)))
    return np.concatenate([unit, rest[:, None]], axis=1).astype(np.float32)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(column), -1)


def search(vectors: DataFrame, queries: DataFrame, k: int = 20, how: Graph = Graph()) -> DataFrame:
    """(``query_id``, ``rank``, ``vec_id``, ``score``): for each row of ``queries`` (vec_id, vector) its ``k`` nearest rows of
    ``vectors`` by inner product, itself left out; ties go to the smaller vec_id.

    Rows without an id and vectors that are null, zero or hold null or non-finite components take no part;
    a vector is compared with those of its own length. A vec_id that occurs twice with different vectors is
    two candidates."""
    good = usable(F.col("vector")) & F.col("vec_id").isNotNull()
    # -0.0 and 0.0 are one value
    plain = F.transform("vector", lambda x: x.cast("double") + F.lit(0.0)).alias("vector")
    vectors, queries = (df.where(good).select(F.col("vec_id").cast("long"), plain) for df in (vectors, queries))
    nodes = written(distinct_vectors(vectors, k + 1), "ann-vectors")
    # 12 shards at least, so that small tables use more than a core; more when a shard would outgrow a task
    sizes = nodes.groupBy(F.size("vector").alias("length")).agg(
        F.count(F.lit(1)).alias("n"), F.sqrt(F.max(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))).alias("norm"))
    shards = F.greatest(F.lit(how.shards), F.ceil(F.col("n") / how.rows)).cast("int")
    # a row for each length of vectors, in practice one
    sizes = F.broadcast(sizes.select("length", "norm", shards.alias("shards")))
    key = F.xxhash64("vector")
    dealt = nodes.join(sizes, F.size("vector") == F.col("length")).select(
        "length", F.pmod(key, F.col("shards")).cast("int").alias("shard"), F.lit(0).alias("kind"), key.alias("key"),
        "vector", "ids", "norm")
    asked = written(queries.select(key.alias("key"), "vector").dropDuplicates(["vector"]), "ann-queries")
    sent = asked.join(sizes, F.size("vector") == F.col("length")).select(
        "length", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), F.lit(1).alias("kind"), "key",
        "vector", F.array().cast("array<bigint>").alias("ids"), "norm")
    found = _by_shard(dealt.union(sent), k + 1, how)
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    top = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k + 1)
    # every query row takes the list of its vector, without itself
    lists = top.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("list"))
    ids = queries.join(asked.select(F.col("key").alias("query"), "vector"), "vector").select("query", "vec_id")
    others = lists.join(ids.withColumnRenamed("vec_id", "query_id"), "query").select(
        "query_id", F.slice(F.filter("list", lambda x: x["vec_id"] != F.col("query_id")), 1, k).alias("list"))
    return others.select("query_id", F.posexplode("list").alias("at", "one")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("one.vec_id").alias("vec_id"),
        F.col("one.score").alias("score"))


def _by_shard(rows: DataFrame, k: int, how: Graph) -> DataFrame:
    """(``query``, ``vec_id``, ``score``): the ``k`` nearest in each shard. Of every shard its vectors come first and are
    built into a graph, then its queries stream past, a block at a time."""
    def run(batches: Batches) -> Batches:
        shard, parts, index = None, [], None
        for batch in batches:
            names = list(zip(batch.column("length").to_pylist(), batch.column("shard").to_pylist(),
                             batch.column("kind").to_pylist()))
            cuts = [0, *(i for i in range(1, len(names)) if names[i] != names[i - 1]), len(names)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                part, (length, number, kind) = batch.slice(a, b - a), names[a]
                if (length, number) != shard:
                    shard, parts, index = (length, number), [], None
                if kind == 0:
                    parts.append(part)
                    continue
                if not parts and index is None:
                    continue  # a shard without vectors
                if index is None:
                    exact = np.concatenate([_matrix(p.column("vector")) for p in parts])
                    ids = [i for p in parts for i in p.column("ids").to_pylist()]
                    points = _lifted(exact, part.column("norm")[0].as_py())
                    index, parts = (exact, ids, points, *build_graph(points, how)), []
                for at in range(0, part.num_rows, how.batch):
                    yield _answer(part.slice(at, how.batch), index, k, how)

    parted = rows.repartition("length", "shard").sortWithinPartitions("length", "shard", "kind", "key")
    return parted.mapInArrow(run, "query long, vec_id long, score double")


def _answer(block: pa.RecordBatch, index: tuple, k: int, how: Graph) -> pa.RecordBatch:
    exact, ids, points, edges, entry = index
    asked = _matrix(block.column("vector"))
    flat = np.concatenate([asked / block.column("norm")[0].as_py(), np.zeros((len(asked), 1))], axis=1).astype(np.float32)
    found, _ = _search(points, edges, entry, flat, max(how.beam, 2 * k))
    query, vec, score = [], [], []
    for i, key in enumerate(block.column("key").to_pylist()):
        nodes = found[i][found[i] >= 0]
        each = [float(x) for x in (exact[nodes] * asked[i]).sum(axis=1)]
        rows = sorted((-s, v) for s, n in zip(each, nodes) for v in ids[n])[:k]
        query += [key] * len(rows)
        vec += [v for _, v in rows]
        score += [-s for s, _ in rows]
    return pa.RecordBatch.from_pydict({"query": pa.array(query, pa.int64()), "vec_id": pa.array(vec, pa.int64()),
                                       "score": pa.array(score, pa.float64())})
