"""Near-duplicates by SimHash: all pairs of fingerprints within ``radius`` bits, found by ball hashing.

Two fingerprints that differ in at most ``radius`` bits have a value in between that differs from
each in at most ``radius / 2``. Every distinct fingerprint therefore emits all variants within half
the radius (2,081 of 64 bits for radius 4); fingerprints that emit a common variant are candidates.

Shuffling each variant as a row would move two thousand times the fingerprints. The shuffle goes
by the leading bits of the variants instead: a fingerprint is sent once to each cell of leading
bits that holds one of its variants, and the task of a cell makes the variants of that cell, sorts
them and reads collisions from equal neighbours. Exact copies share one fingerprint and so weigh no
more than a single document; crowded cells are cut by further bits.

All owners of one variant are linked to the smallest of them, which connects what all their pairs
would connect, without making the pairs. Links whose fingerprints differ in more bits than the
radius are dropped; components come from iterated joins (``components``).
"""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import connected
from tidemark.llm.text import arrow_map, utf8, without
from tidemark.session import written

def _hashes(text: bytes, words: int) -> np.ndarray:
    tokens = text.lower().split()
    if not tokens:
        return np.zeros(0, np.uint64)
    joined = b" ".join(tokens)
    digest = xxhash.xxh64_intdigest
    if len(tokens) <= words:
        return np.array([digest(joined, 42)], np.uint64)
    length = np.fromiter(map(len, tokens), np.int64, len(tokens))
    end = np.cumsum(length + 1) - 1
    start = (end - length)[: len(tokens) - words + 1].tolist()
    end = end[words - 1:].tolist()
    return np.array([digest(joined[a:b], 42) for a, b in zip(start, end)], np.uint64)


def _fingerprint(hashes: np.ndarray) -> int:
    """Bit b is set if more than half of the hashes have it."""
    total = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):
        block = hashes[at:at + 65536].view(np.uint8).reshape(-1, 8)
        bits = np.unpackbits(block, axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
    return int((2 * total > len(hashes)).astype(np.uint64) @ (np.uint64(1) << np.arange(64, dtype=np.uint64)))


def fingerprints(docs: DataFrame, words: int = 4) -> DataFrame:
    """Add ``bits``: the SimHash over shingles of ``words`` lower-cased words as a long. A null text is empty;
    a text without words has 0, one with fewer words is a single shingle."""
    kept = without(docs, ["text", "bits"])

    def work(batch: pa.RecordBatch) -> dict:
        found = [_fingerprint(_hashes(t, words)) for t in utf8(batch)]
        return {"bits": np.array(found, np.uint64).view(np.int64)}

    return arrow_map(docs.select(*kept, "text"), work, kept, "bits long")


def _masks(bits: int, most: int) -> np.ndarray:
    """All numbers of ``bits`` bits with at most ``most`` set."""
    out = level = [0]
    for _ in range(most):
        level = sorted({m | (1 << b) for m in level for b in range(bits) if not m >> b & 1})
        out = out + level
    return np.array(out, np.uint64)


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).astype(np.int64)


def _variants(bits: int, most: int) -> int:
    return sum(comb(bits, k) for k in range(most + 1))


def _stars(cell: int, owners: np.ndarray, radius: int, lead: int) -> np.ndarray:
    """Pairs (owner, smallest owner) over the variants that begin with the ``lead`` bits ``cell``."""
    none = np.zeros((0, 2), np.uint64)
    half, rest = radius // 2, 64 - lead
    owners = np.sort(owners)
    flips = _popcount((owners >> np.uint64(rest)) ^ np.uint64(cell))
    low = owners & np.uint64((1 << rest) - 1)
    variants, index = [], []
    for left in range(half + 1):
        mine, masks = np.flatnonzero(flips == half - left), _masks(rest, left)
        variants.append((low[mine][:, None] ^ masks[None, :]).ravel())
        index.append((mine, len(masks)))
    every = np.concatenate(variants)
    ordered = np.sort(every)
    shared = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(shared):
        return none
    which = np.minimum(np.searchsorted(shared, every), len(shared) - 1)
    hit = np.flatnonzero(shared[which] == every)
    owner = np.concatenate([np.repeat(m, k) for m, k in index])[hit]
    which = which[hit]
    least = np.full(len(shared), len(owners), np.int64)
    np.minimum.at(least, which, owner)
    pair = np.unique(owner * np.int64(len(owners)) + least[which])
    a, b = pair // len(owners), pair % len(owners)
    return np.stack([owners[a], owners[b]], axis=1)[a != b]


def _finder(radius: int, lead: int):
    def find(cell: tuple, rows: pa.Table) -> pa.Table:
        owners = rows.column("bits").to_numpy().view(np.uint64)
        found = _stars(cell[0].as_py(), owners, radius, lead).view(np.int64)
        return pa.table({"a": found[:, 0], "b": found[:, 1]})

    return find


def links(distinct: DataFrame, radius: int = 4, variants_per_task: int = 4_000_000) -> DataFrame:
    """Links (``a``, ``b``) among the distinct longs in ``bits`` that connect all that differ in at most
    ``radius`` bits. ``radius`` is even.

    Cells have 8 leading bits. Those with more than ``variants_per_task`` variants, because there are
    many fingerprints or because a large group of near copies shares its leading bits, are cut by the
    next 8 bits, and so on; this changes the tasks, not the links."""
    if radius % 2:
        raise ValueError("the radius must be even")
    half = radius // 2
    masks = F.lit([int(m) for m in _masks(8, half)])
    rows = distinct.where("bits is not null").select("bits", F.lit(0).cast("long").alias("cell"),
                                                     F.lit(half).alias("left"))
    pairs = None
    for lead in range(8, 57, 8):
        byte = F.shiftrightunsigned("bits", 64 - lead).bitwiseAND(F.lit(255))
        rows = rows.select("bits", "cell", "left", F.explode(masks).alias("mask")).select(
            "bits", (F.shiftleft("cell", 8) + byte.bitwiseXOR(F.col("mask"))).alias("cell"),
            (F.col("left") - F.bit_count("mask")).alias("left")).where("left >= 0")
        size = F.lit(1).cast("long")
        for left in range(1, half + 1):
            size = F.when(F.col("left") == left, F.lit(_variants(64 - lead, left))).otherwise(size)
        crowded = rows.groupBy("cell").agg(F.sum(size).alias("n")).where(
            F.col("n") > variants_per_task).select("cell")
        last = lead == 56 or crowded.isEmpty()
        here = rows if last else rows.join(crowded, "cell", "left_anti")

        made = here.groupBy("cell").applyInArrow(_finder(radius, lead), "a long, b long")
        pairs = made if pairs is None else pairs.union(made)
        if last:
            break
        rows = rows.join(crowded, "cell", "left_semi")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius
    return pairs.where(near).distinct()


def _labels(marked: DataFrame, radius: int) -> DataFrame:
    """(``bits``, ``label``, ``doc_id``): the component of every distinct fingerprint and its smallest document."""
    # copies of one text are one row from here on
    least = written(marked.groupBy("bits").agg(F.min("doc_id").alias("doc_id")), "simhash-distinct")
    label = connected(links(least.select("bits"), radius)).withColumnRenamed("node", "bits")
    return least.join(label, "bits", "left").select("bits", F.coalesce("label", "bits").alias("label"), "doc_id")


def components(docs: DataFrame, radius: int = 4, words: int = 4) -> DataFrame:
    """Add ``fingerprint`` (16 hex digits) and ``component_id``: the smallest ``doc_id`` that is reached over
    links of at most ``radius`` bits, null where all ids of the component are null. Equal rows stay
    separate rows."""
    kept = without(docs, ["text", "fingerprint", "component_id", "bits"])
    marked = written(fingerprints(docs.select(*kept, "text"), words), "simhash")
    labels = written(_labels(marked, radius), "simhash-labels")
    first = labels.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    of_bits = labels.join(first, "label").select("bits", "component_id")
    return marked.join(of_bits, "bits").select(
        *kept, F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, radius: int = 4, words: int = 4) -> DataFrame:
    """The documents without near-duplicates: of each component the row with the smallest doc_id stays (a
    null id only where there is no other), of equal ids one by the hash of its row."""
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"),
                   F.xxhash64(*docs.columns).alias("row"))
    keyed = docs.select("doc_id", "text", key.alias("_key"))
    marked = written(fingerprints(keyed, words), "simhash")
    best = marked.join(_labels(marked, radius).drop("doc_id"), "bits").groupBy("label").agg(
        F.min("_key").alias("_key")).select("_key")
    return docs.withColumn("_key", key).join(best, "_key", "left_semi").dropDuplicates(["_key"]).select(*docs.columns)
