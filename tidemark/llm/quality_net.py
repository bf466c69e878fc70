"""Quality of texts by a small convolutional network over bytes, in numpy.

A text is read in overlapping chunks that cover all of it. Each byte has a learned vector; learned
filters of a few bytes slide over the chunk, and of every filter the largest answer in the chunk
counts. Over the chunks of a document these are combined by their maximum and their mean into one
probability. The network is trained on a bounded sample of labelled rows (``Sample``); scoring is one
pass over the texts without any shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import arrow_map, crc_mod, utf8, without

CHUNK = 512


@dataclass(frozen=True)
class Sample:
    """Bounds of the training sample: at most ``rows`` labelled rows, the first by the hash of their id, as far as
    they fit into ``bytes`` of text. A text over ``longest`` bytes counts with chunks drawn over the whole of it. The first
    ``sure`` rows of each label come before all others, whatever their place and size."""

    rows: int = 3000
    bytes: int = 6_000_000
    longest: int = 300_000
    sure: int = 10


@dataclass
class Net:
    """byte vectors (256, d), filters (width * d, f), their offsets, output weights (2 f) and offset."""

    vectors: np.ndarray
    filters: np.ndarray
    offsets: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    width: int

    @staticmethod
    def fresh(d: int = 4, width: int = 5, f: int = 24, seed: int = 7) -> Net:
        r = np.random.default_rng(seed)
        return Net(r.normal(0, 0.5, (256, d)).astype(np.float32),
                   r.normal(0, (width * d) ** -0.5, (width * d, f)).astype(np.float32),
                   np.zeros(f, np.float32), r.normal(0, 0.1, 2 * f).astype(np.float32),
                   np.zeros(1, np.float32), width)

    def parts(self) -> list[np.ndarray]:
        return [self.vectors, self.filters, self.offsets, self.weights, self.bias]


def chunked(text: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The text's bytes, zero-padded to one filter at least, and where its chunks begin. Chunks overlap by a filter
    less one byte, so that every place of a filter lies in one of them."""
    data = np.frombuffer(text + bytes(max(0, width - len(text))), np.uint8)
    return data, np.arange(0, len(data) - width + 1, CHUNK)


def _answers(net: Net, data: np.ndarray) -> np.ndarray:
    """Answers of all filters at all places."""
    seen = np.ascontiguousarray(net.vectors[data])
    d = seen.shape[1]
    windows = np.lib.stride_tricks.as_strided(
        seen, (len(data) - net.width + 1, net.width * d), (seen.strides[0], seen.strides[1]))
    return np.dot(windows, net.filters)


def _pooled(net: Net, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The largest answer of each filter in each chunk, not below zero; blocks bound the memory of long texts."""
    out, step = [], 64
    for at in range(0, len(starts), step):
        first = starts[at]
        last = starts[at + step] + net.width - 1 if at + step < len(starts) else len(data)
        answers = _answers(net, data[first:last])
        n, f = len(answers) // CHUNK, answers.shape[1]
        out.append(answers[:n * CHUNK].reshape(n, CHUNK, f).max(axis=1))
        if n * CHUNK < len(answers):
            out.append(answers[n * CHUNK:].max(axis=0, keepdims=True))
    return np.maximum(np.concatenate(out) + net.offsets, 0)


def _combined(pooled: np.ndarray) -> np.ndarray:
    return np.concatenate([pooled.max(axis=0), pooled.mean(axis=0)])


def probability(net: Net, text: bytes) -> float:
    pooled = _pooled(net, *chunked(text, net.width))
    z = float(_combined(pooled) @ net.weights + net.bias[0])
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _gradients(net: Net, text: bytes, label: int, weight: float) -> list[np.ndarray]:
    data, starts = chunked(text, net.width)
    answers = _answers(net, data)
    f = net.filters.shape[1]
    place = np.empty((len(starts), f), np.int64)
    for i, s in enumerate(starts):
        place[i] = s + answers[s:s + CHUNK].argmax(axis=0)
    best = answers[place, np.arange(f)] + net.offsets
    pooled = np.maximum(best, 0)
    both = _combined(pooled)
    p = 1 / (1 + np.exp(-np.clip(both @ net.weights + net.bias[0], -30, 30)))
    dz = np.float32(weight * (p - label))
    dpool = np.broadcast_to(dz * net.weights[f:] / len(starts), pooled.shape).copy()
    dpool[pooled.argmax(axis=0), np.arange(f)] += dz * net.weights[:f]
    dpool *= best > 0
    around = data[place[..., None] + np.arange(net.width)]           # chunk, filter, width
    seen = net.vectors[around].reshape(*place.shape, -1)             # chunk, filter, width * d
    dfilters = np.einsum("cfk,cf->kf", seen, dpool)
    dseen = (dpool[..., None] * net.filters.T[None]).reshape(-1, net.vectors.shape[1])
    dvectors = np.zeros_like(net.vectors)
    np.add.at(dvectors, around.reshape(-1), dseen)
    return [dvectors, dfilters, dpool.sum(axis=0), dz * both, np.array([dz], np.float32)]


def train(texts: list[bytes], labels: list[int], epochs: int = 8, batch: int = 16, rate: float = 0.01,
          seed: int = 7, least_steps: int = 500) -> Net:
    """Adam on the logistic loss; both labels weigh the same in sum. Small samples are gone through more often, for
    ``least_steps`` steps in all. Without examples of both, the share of label 1
    (1 if there are none at all) is what every text gets."""
    net = Net.fresh(seed=seed)
    y = np.array(labels)
    if len(set(labels)) < 2:
        net.weights[:] = 0
        net.bias[:] = 10 if not len(y) or y[0] == 1 else -10
        return net
    balance = np.where(y == 1, len(y) / (2 * (y == 1).sum()), len(y) / (2 * (y == 0).sum()))
    parts = net.parts()
    m, v = [np.zeros_like(x) for x in parts], [np.zeros_like(x) for x in parts]
    order, step = np.random.default_rng(seed), 0
    epochs = max(epochs, -(-least_steps // max(1, len(y) // batch)))
    for epoch in range(epochs):
        lr = rate * (1 - epoch / epochs) + rate / 20
        for block in np.array_split(order.permutation(len(y)), max(1, len(y) // batch)):
            step += 1
            total = [np.zeros_like(x) for x in parts]
            for i in block:
                for t, g in zip(total, _gradients(net, texts[i], y[i], balance[i])):
                    t += g / len(block)
            for x, g, a, b in zip(parts, total, m, v):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                x -= lr * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
    return net


def drawn(text: bytes, most: int) -> bytes:
    """The text, or as many chunks as fit into ``most`` bytes, evenly spread from its first to its last byte."""
    if len(text) <= most:
        return text
    n = max(2, most // CHUNK)
    starts = np.linspace(0, len(text) - CHUNK, n).astype(np.int64)
    return b"".join(text[s:s + CHUNK] for s in starts.tolist())


def sample_of(docs: DataFrame, labels: DataFrame, sample: Sample = Sample(), folds: int = 5) -> list[tuple[bytes, int]]:
    """Texts and labels to train on, of the folds other than the held-out one. ``labels`` has doc_id and quality (0 or 1;
    other rows are left out). A document labelled more than once counts with its smallest label."""
    known = labels.where("quality in (0, 1) and doc_id is not null").where(crc_mod("doc_id", folds) != 0).groupBy(
        "doc_id").agg(F.min("quality").alias("quality"))
    order = F.xxhash64(F.col("doc_id"), F.lit("train"))
    later = known.orderBy(order, "doc_id").limit(max(0, sample.rows - 2 * sample.sure)).withColumn("later", F.lit(1))
    sure = [known.where(F.col("quality") == y).orderBy(order, "doc_id").limit(sample.sure).withColumn("later", F.lit(0))
            for y in (0, 1)]
    chosen = later.union(sure[0]).union(sure[1]).groupBy("doc_id", "quality").agg(F.min("later").alias("later"))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(chosen, "doc_id").groupBy(
        "doc_id", "quality", "later").agg(F.min("text").alias("text"))

    def shorten(batch: pa.RecordBatch) -> dict:
        return {"data": pa.array([drawn(t, sample.longest) for t in utf8(batch)], pa.binary())}

    short = arrow_map(rows, shorten, ["doc_id", "quality", "later"], "data binary")
    before = F.sum(F.octet_length("data")).over(_ordered(order))
    bounded = short.withColumn("_bytes", before).where(F.col("_bytes") <= sample.bytes).orderBy(order, "doc_id")
    return [(bytes(r.data), int(r.quality)) for r in bounded.select("data", "quality").collect()]


def fit(docs: DataFrame, labels: DataFrame, sample: Sample = Sample(), folds: int = 5, **training) -> Net:
    """Train on the labelled documents of ``sample_of``."""
    taken = sample_of(docs, labels, sample, folds)
    return train([t for t, _ in taken], [y for _, y in taken], **training)


def _ordered(order):
    from pyspark.sql import Window
    return Window.partitionBy().orderBy("later", order, "doc_id")  # over the sample only


def score(docs: DataFrame, net: Net, threshold: float = 0.3) -> DataFrame:
    """Replace ``text`` by ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on). A null text is empty. Only the
    text counts."""
    kept = without(docs, ["text", "score", "predicted"])

    def work(batch: pa.RecordBatch) -> dict:  # the network, some 10 kB, travels with the task
        found = np.array([probability(net, t) for t in utf8(batch)], np.float64)
        return {"score": found, "predicted": (found >= threshold).astype(np.int32)}

    return arrow_map(docs.select(*kept, "text"), work, kept, "score double, predicted int")


def score_held_out(docs: DataFrame, labels: DataFrame, folds: int = 5, **options) -> DataFrame:
    """(``doc_id``, ``held_out``, ``score``, ``predicted``) with a network trained on the other folds."""
    net = fit(docs, labels, folds=folds, **options)
    return score(docs.select("doc_id", "text"), net).select(
        "doc_id", (crc_mod("doc_id", folds) == 0).alias("held_out"), "score", "predicted")
