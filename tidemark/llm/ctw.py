"""Scoring texts by context-tree weighting over bytes.

The model gives a probability to a text's words, in order, and to its end. A word is spelled as its
bytes and a closing space, the end as a line feed; every byte is eight binary decisions, one node
of a 255-node tree each. A decision's context is the bytes before it in the running text, the nearest
first, across the words; before the text stand a space and padding.

In every context the training counts (a, b) of a decision have the Krichevsky-Trofimov probability
Pe(a, b); the tree mixes all depths, Pw = (Pe + product of the Pw of the longer contexts) / 2, with
Pw = Pe at the greatest depth. The weight of a depth, Pe / (2 Pw), then mixes the predictions
(a + 1/2) / (a + b + 1) of all depths.

Texts of different kinds, say languages, have trees of their own: the probability of a text is the
mean of what the trees of all groups give it, weighted by their shares of the training documents. The
group of a document to be scored is never looked at.

Most bytes of a text have their whole context in their own word. Within a chunk these are looked at once per distinct word, and the
first bytes of a word once for each pair of them and the bytes before the word (``_Words``).

Corpus counts go through shuffles only: words per chunk (``chunks``), then per corpus; byte strings, a context and its byte,
per chunk, then per corpus. The probability of a string's last byte goes back to the chunks that have it, as do the words. Contexts are shared out by their two nearest bytes:
a bucket holds whole subtrees from depth two on. The two depths above have 257 contexts at most,
and their table (65,280 rows, a few numbers per group) is the only thing broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.chunks import (
    Dictionary, assembled, buckets_for, coded, gathered, lists, matrix, pack, unpack, unpack_words)
from tidemark.llm.text import Batches, crc_mod, trim, utf8, without
from tidemark.session import written

DEPTH = 5            # bytes of context; the byte strings counted have one more and fit 64 bits up to 7
STRINGS_PER_BUCKET = 40_000
CHUNK_BYTES = 24 << 20  # of text; chunks end here only, as more words than that they cannot have
PIECE = 1 << 20      # bytes whose strings are made at a time
SPAN = 1 << 18       # words of texts looked at at a time
KEY_BITS = 63        # of what stands before a word and the word's number, where both fit
END = b""            # the end of a text among the words


def split_tokens(text: bytes) -> list[bytes]:
    """Words with A-Z in lower case, then the end."""
    return [*text.lower().split(), END]


def _ending(data: np.ndarray, depth: int) -> np.ndarray:
    """The last ``depth`` + 1 of the bytes up to each place, the one there lowest."""
    strings = np.zeros(len(data), np.uint64)
    for back in range(min(depth, len(data)) + 1):
        strings[back:] |= data[: len(data) - back].astype(np.uint64) << np.uint64(8 * back)
    return strings


def _strings(pieces: list[tuple[bytes, bytes]], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The byte strings (context and byte, the byte lowest) of all bytes of some pieces, each with the ``depth`` bytes before it, and how
    many each piece has."""
    data = np.frombuffer(b"".join(x for piece in pieces for x in piece), np.uint8)
    own = np.fromiter((len(piece) for _, piece in pieces), np.int64, len(pieces))
    strings = _ending(data, depth)
    start = np.cumsum(own + depth) - own
    at = np.repeat(start - (np.cumsum(own) - own), own) + np.arange(own.sum())
    return strings[at].view(np.int64), own


def _pad(depth: int) -> bytes:
    return bytes(depth - 1) + b" "


def _spelled(words: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The byte strings of words that stand alone, and how many each word has."""
    return _strings([(_pad(depth), w + b" " if w else b"\n") for w in words], depth)


def _pieces(tokens: list[bytes], depth: int) -> list[tuple[bytes, bytes]]:
    """The running text of words and the end, in pieces of bounded size with the bytes before them: what ``_Words`` must amount to."""
    text = _pad(depth) + b" ".join(tokens) + b"\n"
    return [(text[a - depth:a], text[a:a + PIECE]) for a in range(depth, len(text), PIECE)]


class _Words:
    """Distinct words, of which texts are lists of numbers, and the byte strings of such texts without spelling them.

    The bytes of a word from place ``depth`` - 1 on, and the space behind it, have their context in the word and the space
    before it (``inner``). The context of those before, its head, also takes the ``depth`` - 1 bytes before that space, the tail
    of what stands there (``pairs``, ``heads_of``)."""

    def __init__(self, data: bytes, size: np.ndarray, depth: int):
        n, keep = len(size), depth - 1
        self.depth, self.size = depth, size
        self.text = np.full(len(data) + n + 1, 32, np.uint8)
        self.end = np.cumsum(size + 1)
        self.start = self.end - size
        own = np.ones(len(self.text), bool)
        own[0], own[self.end] = False, False
        self.text[own] = np.frombuffer(data, np.uint8)
        self.last, head, long = np.zeros(n, np.uint64), np.zeros(n, np.uint64), np.minimum(size + 1, keep)
        for j in range(keep):
            at = np.flatnonzero(size > j)
            self.last[at] |= self.text[self.end[at] - 1 - j].astype(np.uint64) << np.uint64(8 * j)
            at = np.flatnonzero(long > j)
            head[at] = head[at] << np.uint64(8) | self.text[self.start[at] + j]
        head[size == 0] = ord("\n")  # the end
        heads, self.head = np.unique(head | long.astype(np.uint64) << np.uint64(56), return_inverse=True)
        self.heads, self.head_size = heads & np.uint64((1 << 56) - 1), heads >> np.uint64(56)

    def inner(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Byte strings that depend on a word alone, and the words they are of, ``PIECE`` bytes at a time."""
        for a in range(1, len(self.text), PIECE):
            b = min(a + PIECE, len(self.text))
            first, last = np.searchsorted(self.end, [a, b - 1])
            ends = np.minimum(self.end[first:last + 1], b - 1)
            of = np.repeat(np.arange(first, last + 1), np.diff(ends, prepend=a - 1))
            lead = min(a, self.depth)
            chosen = np.flatnonzero(np.arange(a, b) - self.start[of] >= self.depth - 1)
            yield _ending(self.text[a - lead:b], self.depth)[lead:][chosen].view(np.int64), of[chosen]

    def _tails(self, stream: np.ndarray, place: np.ndarray, a: int, b: int) -> np.ndarray:
        """What stands before the words ``a`` to ``b`` of the stream and their space; ``place`` is a word's in its text."""
        keep = self.depth - 1
        tail, have = np.zeros(b - a, np.uint64), np.zeros(b - a, np.int64)
        rows, back = np.flatnonzero(place[a:b] > 0), 1
        while len(rows):
            if back > 1:
                tail[rows] |= np.uint64(32) << (8 * have[rows]).astype(np.uint64)
                have[rows] += 1
                rows = rows[(have[rows] < keep) & (place[a + rows] >= back)]
            of = stream[a + rows - back]
            tail[rows] |= self.last[of] << (8 * have[rows]).astype(np.uint64)
            have[rows] += self.size[of]
            rows, back = rows[have[rows] < keep], back + 1
        return tail & np.uint64((1 << 8 * keep) - 1)

    def pairs(self, texts: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray | None]]:
        """A number for tail and head of each word, ``SPAN`` words of the texts at a time, and the tails if it has only their places."""
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        stream = np.concatenate(texts)
        place = np.arange(len(stream), dtype=np.int32)
        place -= np.repeat((np.cumsum(size) - size).astype(np.int32), size)
        bits = 8 * (self.depth - 1)
        for a in range(0, len(stream), SPAN):
            b = min(a + SPAN, len(stream))
            tail, head = self._tails(stream, place, a, b), self.head[stream[a:b]]
            if bits + len(self.heads).bit_length() <= KEY_BITS:
                yield tail.view(np.int64) | head << bits, None
            else:
                number, tails = pd.factorize(tail)
                yield number | head << 32, tails

    def heads_of(self, keys: np.ndarray, tails: np.ndarray | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The byte strings of the heads of some ``pairs``, and the pairs they are of, a place in the heads at a time."""
        bits = 8 * (self.depth - 1) if tails is None else 32
        tail, head = keys & ((1 << bits) - 1), keys >> bits
        before = (tail.view(np.uint64) if tails is None else tails[tail]) << np.uint64(8) | np.uint64(32)
        value, size = self.heads[head], self.head_size[head]
        whole = np.uint64((1 << 8 * (self.depth + 1)) - 1)
        for j in range(self.depth - 1):
            at = np.flatnonzero(size > j)
            strings = before[at] << np.uint64(8 * (j + 1)) | value[at] >> np.uint64(8) * (size[at] - np.uint64(j + 1))
            yield (strings & whole).view(np.int64), at


def _lgamma(x: np.ndarray) -> np.ndarray:
    """log Gamma for x >= 1/2, by Stirling's series at x + 8."""
    shift = np.zeros_like(x)
    for k in range(8):
        shift += np.log(x + k)
    y = x + 8
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - shift


def _estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """log Pe of ``a`` zeros and ``b`` ones."""
    return _lgamma(a + 0.5) + _lgamma(b + 0.5) - _lgamma(a + b + 1.0) - np.log(np.pi)


def _weighted(log_pe: np.ndarray, log_children: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """log Pw, and the weight of stopping here."""
    log_pw = np.logaddexp(log_pe, log_children) - np.log(2)
    return log_pw, np.exp(log_pe - np.log(2) - log_pw)


def _sums(at: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sums of the rows with equal number in ``at``."""
    return np.stack([np.bincount(at, rows[:, g], n) for g in range(rows.shape[1])], axis=1)


class _Subtrees:
    """Contexts from depth two to ``depth`` of some byte strings with their counts, a column per group."""

    def __init__(self, strings: np.ndarray, n: np.ndarray, depth: int):
        symbol, context = strings & 255, strings >> 8
        level = np.arange(8)
        self.node = ((1 << level) | (symbol[:, None] >> (8 - level))).ravel()
        self.bit = ((symbol[:, None] >> (7 - level)) & 1).ravel()
        context, n = np.repeat(context, 8), np.repeat(n.astype(np.float64), 8, axis=0)
        self.levels, below = [], None
        for d in range(depth, 1, -1):
            mask = (1 << 8 * d) - 1
            if below is None:
                keys, at = np.unique(((context & mask) << 8) | self.node, return_inverse=True)
                a, b = _sums(at, n * (1 - self.bit)[:, None], len(keys)), _sums(at, n * self.bit[:, None], len(keys))
                log_pw = _estimate(a, b)
                weight = np.ones_like(a)
            else:
                old, old_a, old_b, old_pw, old_at = below
                keys, up = np.unique((((old >> 8) & mask) << 8) | (old & 255), return_inverse=True)
                a, b, log_children = (_sums(up, x, len(keys)) for x in (old_a, old_b, old_pw))
                log_pw, weight = _weighted(_estimate(a, b), log_children)
                at = up[old_at]
            self.levels.append((at, weight, (a + 0.5) / (a + b + 1)))
            below = keys, a, b, log_pw, at
        self.keys, self.a, self.b, self.log_pw = below[:4]

    def log10(self, above: np.ndarray) -> np.ndarray:
        """log10 of each string's last byte, a column per group. ``above`` has for (nearest byte, node) and group the share of
        the two upper depths in the probability of a zero, and the weight left for the others."""
        upper = above[(self.keys >> 8) & 255, self.keys & 255][self.levels[-1][0]]
        zero, rest = upper[:, 0], upper[:, 1]
        for at, weight, p in reversed(self.levels):
            zero = zero + rest * (weight * p)[at]
            rest = rest * (1 - weight)[at]
        p = np.where(self.bit[:, None] == 0, zero, 1 - zero)
        return np.log10(np.maximum(p, 1e-300)).reshape(-1, 8, p.shape[1]).sum(axis=1)


def _upper(groups: int):
    def upper(key: tuple, rows: pa.Table) -> pa.Table:
        """Depths zero and one for one node: at most 65,536 contexts of two bytes come in."""
        near = rows.column("context").to_numpy() & 255
        a, b, log_children = (_sums(near, matrix(rows.column(c), groups), 256) for c in ("a", "b", "log_pw"))
        log_pw, w1 = _weighted(_estimate(a, b), log_children)
        a0, b0 = a.sum(axis=0), b.sum(axis=0)
        _, w0 = _weighted(_estimate(a0, b0), log_pw.sum(axis=0))
        zero = w0 * (a0 + 0.5) / (a0 + b0 + 1) + (1 - w0) * w1 * (a + 0.5) / (a + b + 1)
        return pa.table({"near": np.arange(256, dtype=np.int32), "node": np.full(256, key[0].as_py(), np.int32),
                         "zero": lists(zero), "rest": lists((1 - w0) * (1 - w1))})

    return upper


def _predicted(counted: DataFrame, groups: int, depth: int) -> DataFrame:
    """(``string``, ``log10_p``: a number per group) for distinct byte strings and their training counts ``n0``, ``n1``, ..."""
    names = [f"n{g}" for g in range(groups)]
    # bytes one and two of a string are the two nearest of its context
    near = F.shiftrightunsigned("string", 8).bitwiseAND(F.lit(0xFFFF))
    buckets = max(16, -(-counted.count() // STRINGS_PER_BUCKET))
    dealt = counted.withColumn("bucket", F.pmod(F.xxhash64(near), F.lit(buckets)))

    def tree(rows: pa.Table) -> _Subtrees:
        n = np.stack([rows.column(c).to_numpy() for c in names], axis=1)
        return _Subtrees(rows.column("string").to_numpy(), n, depth)

    def second_depth(rows: pa.Table) -> pa.Table:
        t = tree(rows)
        out = pa.table({"context": t.keys >> 8, "node": (t.keys & 255).astype(np.int32), "a": lists(t.a),
                        "b": lists(t.b), "log_pw": lists(t.log_pw)})
        del t
        trim()
        return out

    sides = "context long, node int, a array<double>, b array<double>, log_pw array<double>"
    upper = dealt.groupBy("bucket").applyInArrow(second_depth, sides).groupBy("node").applyInArrow(
        _upper(groups), "near int, node int, zero array<double>, rest array<double>")
    table = np.empty((256, 256, 2, groups))
    table[:, :, 0], table[:, :, 1] = 0.5, 0.0
    for row in upper.toLocalIterator():  # 255 nodes of 256 contexts at most
        table[row.near, row.node] = row.zero, row.rest
    above = counted.sparkSession.sparkContext.broadcast(table)

    def predict(rows: pa.Table) -> pa.Table:
        out = pa.table({"string": rows.column("string"), "log10_p": lists(tree(rows).log10(above.value))})
        trim()
        return out

    return dealt.groupBy("bucket").applyInArrow(predict, "string long, log10_p array<double>")


def score_words(words: DataFrame, groups: int, depth: int = DEPTH) -> DataFrame:
    """(``cell``, ``word``, ``n``, ``log10_p``: a number per group) for distinct words in cells of any kind (``word``: binary; ``n``:
    array of its counts in training per group, all 0 if it is only to be scored). The empty word is the end
    of a text."""
    if not 2 <= depth <= 7:
        raise ValueError("the depth must be from 2 to 7")

    def strings_of(key: tuple, rows: pa.Table) -> pa.Table:
        strings, own = _spelled(rows.column("word").to_pylist(), depth)
        distinct, at = np.unique(strings, return_inverse=True)
        n = _sums(at, np.repeat(matrix(rows.column("n"), groups), own, axis=0), len(distinct)).astype(np.int64)
        counts = {f"n{g}": n[:, g] for g in range(groups)}
        return pa.table({"cell": np.full(len(distinct), key[0].as_py(), np.int32), "string": distinct, **counts})

    names = [f"n{g}" for g in range(groups)]
    per_cell = words.groupBy("cell").applyInArrow(
        strings_of, "cell int, string long, " + ", ".join(f"{c} long" for c in names))
    counted = written(per_cell.groupBy("string").agg(*[F.sum(c).alias(c) for c in names]), "ctw-strings")
    predicted = _predicted(counted, groups, depth)
    back = per_cell.select("cell", "string").join(predicted, "string")

    def add_up(rows: pa.Table, strings: pa.Table) -> pa.Table:
        texts = rows.column("word").to_pylist()
        own_strings, own = _spelled(texts, depth)
        known = strings.column("string").to_numpy()
        order = np.argsort(known)
        p = matrix(strings.column("log10_p"), groups)[order[np.searchsorted(known[order], own_strings)]]
        total = _sums(np.repeat(np.arange(len(own)), own), p, len(own))
        return pa.table({"cell": rows.column("cell"), "word": rows.column("word"), "n": rows.column("n"),
                         "log10_p": lists(total)})

    return words.groupBy("cell").cogroup(back.groupBy("cell")).applyInArrow(
        add_up, "cell int, word binary, n array<long>, log10_p array<double>")


def score(docs: DataFrame, learn: str, group: str | None = None, depth: int = DEPTH, most_groups: int = 8) -> DataFrame:
    """Replace ``text`` by its score under a model of the rows whose column ``learn`` is true: ``n_tokens``
    (words and the end), ``n_known`` (tokens seen in training), ``train_tokens``, ``base_score`` (log10 probability
    under smoothed token frequencies), ``score`` (log10 probability under the weighted context trees) and
    ``bits_per_byte`` (its code length, per byte of the words and their separators).

    ``group`` names a column of kinds of text, such as the language: the ``most_groups`` most frequent get a
    tree of their own, the rest and null share one. A null text is empty; a null ``learn`` is false. ``docs``
    must give the same partitions when it is read twice (files, or a written table)."""
    added = ["n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"]
    kept = [c for c in without(docs, ["text", *added, "_chunk", "_kind", "_codes", "_a", "_b"]) if c.lower() != learn.lower()]
    docs = docs.withColumn("_learn", F.coalesce(learn, F.lit(False)))
    names, shares = _kinds(docs, group, most_groups)
    number = F.lit(len(names) - 1)
    for i, name in enumerate(names[:-1]):
        number = F.when(F.col(group) == name, i).otherwise(number)
    docs = gathered(docs.select(*kept, F.when(F.col("_learn"), number).otherwise(-1).alias("_group"), "text"))
    groups = len(names)
    parts = buckets_for(docs)
    tables = written(_chunk_tables(docs, parts, groups, depth), "ctw-chunks")
    book, strings = tables.where("words is not null"), tables.where("strings is not null")
    words = written(book.select("bucket", "words", "sizes", "n").groupBy("bucket").applyInArrow(
        _distinct(groups), "cell int, word binary, n array<long>"), "ctw-words")
    every = F.aggregate("n", F.lit(0).cast("long"), lambda s, x: s + x)
    total, distinct = words.agg(F.coalesce(F.sum(every), F.lit(0)), F.count(F.when(every > 0, 1))).first()
    counted = written(strings.select("bucket", "strings", "times").groupBy("bucket").applyInArrow(
        _counted(groups), "string long, " + ", ".join(f"n{g} long" for g in range(groups))), "ctw-strings")
    predicted = _predicted(counted, groups, depth).withColumn("bucket", _bucket_of("string", parts))
    blank = F.lit(b"").alias("pos")
    values = book.select("bucket", "chunk", "pos", "words", "sizes").groupBy("bucket").cogroup(words.groupBy("cell")).applyInArrow(
        _values(groups), "chunk long, pos binary, a binary, b binary").unionByName(
        strings.select("bucket", "chunk", "strings").groupBy("bucket").cogroup(predicted.groupBy("bucket")).applyInArrow(
            _string_values(groups), "chunk long, a binary, b binary").select("chunk", blank, "a", "b"))

    def prepare(numbers: np.ndarray, spans: list, a: list[bytes], b: list[bytes]) -> tuple:
        trim()
        n, sizes, texts, strings, p = [], [], [], [], []
        for (first, last), counts, data in zip(spans, a, b):
            if first == last:  # byte strings and what their last bytes have
                strings.append(np.frombuffer(counts, "<i8"))
                p.append(np.frombuffer(data, "<f4").reshape(-1, groups))
                continue
            for part, own in zip((n, sizes), unpack(counts).reshape(2, -1)):
                part.append(own)
            texts.append(data)
        n, keys, p = np.concatenate(n), pd.Index(np.concatenate(strings)), np.concatenate([*p, np.zeros((1, groups), np.float32)])
        words = _Words(b"".join(texts), np.concatenate(sizes).astype(np.int64), depth)
        inner = np.zeros((len(n), groups))
        for found, of in words.inner():
            begins = np.flatnonzero(np.diff(of, prepend=-1))
            if len(begins):
                inner[of[begins]] += np.add.reduceat(p.take(_places(keys, found), axis=0), begins, axis=0, dtype=np.float64)
        place = np.empty(len(n), np.int32)
        place[numbers] = np.arange(len(n), dtype=np.int32)
        base, known = np.log10((n + 0.1) / (total + 0.1 * (distinct + 1))), n > 0
        del strings, texts, sizes, n
        trim()
        return base, known, words, inner, place, keys, p

    def work(table: tuple, codes: list[np.ndarray]) -> dict:
        base, known, words, inner, place, keys, p = table
        codes = [place[c] for c in codes]
        each = np.zeros((len(codes), groups))
        ends = np.cumsum([len(c) for c in codes])
        begins, stream, at = np.concatenate([[0], ends[:-1]]), np.concatenate(codes), 0
        for pairs, tails in words.pairs(codes):
            which, pairs = pd.factorize(pairs)
            of_pair = np.zeros((len(pairs), groups))
            for found, of in words.heads_of(pairs, tails):
                row = np.full(len(pairs), len(keys))
                row[of] = _places(keys, found)
                of_pair += p.take(row, axis=0)
            values = of_pair.take(which, axis=0) + inner.take(stream[at:at + len(which)], axis=0)
            first, last = np.searchsorted(ends, at, "right"), np.searchsorted(begins, at + len(which))
            each[first:last] += np.add.reduceat(values, np.maximum(begins[first:last] - at, 0), axis=0)
            at += len(which)
        each += shares
        top = each.max(axis=1)
        scores = top + np.log10((10 ** (each - top[:, None])).sum(axis=1))
        length = np.array([(words.size[c] + 1).sum() for c in codes])
        return {"n_tokens": np.array([len(c) for c in codes]), "n_known": np.array([known[c].sum() for c in codes]),
                "train_tokens": np.full(len(codes), total), "base_score": np.array([base[c].sum() for c in codes]),
                "score": scores, "bits_per_byte": -scores * np.log2(10) / length}

    return assembled(coded(docs.drop("_group"), split_tokens, CHUNK_BYTES, most_bytes=CHUNK_BYTES), values, prepare, work,
                     "n_tokens long, n_known long, train_tokens long, base_score double, score double, "
                     "bits_per_byte double")


def _places(keys: pd.Index, strings: np.ndarray) -> np.ndarray:
    at = keys.get_indexer(strings)
    if len(at) and at.min() < 0:
        raise ValueError("the documents were dealt out differently in the two passes")
    return at


def _numbers(rows: pa.Table) -> tuple[list[bytes], list[np.ndarray]]:
    """The distinct words of a bucket, and for each of its rows which they are."""
    known: dict[bytes, int] = {}
    numbers = []
    for data, sizes in zip(rows.column("words").to_pylist(), rows.column("sizes").to_pylist()):
        words = unpack_words(data, sizes)
        numbers.append(np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words)))
    return list(known), numbers


def _distinct(groups: int):
    def distinct(key: tuple, rows: pa.Table) -> pa.Table:
        words, numbers = _numbers(rows)
        n = np.zeros((len(words), groups), np.int64)
        for at, counts in zip(numbers, rows.column("n").to_pylist()):
            n[at] += unpack(counts).reshape(-1, groups)
        return pa.table({"cell": np.full(len(words), key[0].as_py(), np.int32), "word": pa.array(words, pa.binary()),
                         "n": lists(n)})

    return distinct


def _values(groups: int):
    def values(rows: pa.Table, counted: pa.Table) -> pa.Table:
        """``a``: the counts of the words, then their sizes; ``b``: the words."""
        place = {w: i for i, w in enumerate(counted.column("word").to_pylist())}
        n = matrix(counted.column("n"), groups).sum(axis=1)
        words, numbers = _numbers(rows)
        at = np.fromiter((place[w] for w in words), np.int64, len(words))
        size = np.fromiter(map(len, words), np.int64, len(words))
        return pa.table({
            "chunk": rows.column("chunk"), "pos": rows.column("pos"),
            "a": pa.array([pack(np.concatenate([n[at[i]], size[i]])) for i in numbers], pa.binary()),
            "b": rows.column("words").cast(pa.binary())})

    return values


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct strings of some parts, and the sums of their numbers."""
    strings, n = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(strings)
    strings = strings[order]
    begins = np.flatnonzero(np.concatenate([[True], strings[1:] != strings[:-1]]))
    return strings[begins], np.add.reduceat(n[order], begins)


def _string_counts(words: _Words, texts: dict[int, list[np.ndarray]], n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct byte strings of a chunk, and how often they occur in each group. ``texts`` has the word numbers of its texts by
    group, ``n`` the counts of its words per group; group -1 counts nowhere."""
    found: dict[int, tuple] = {}
    for group, codes in texts.items():
        parts = []
        for pairs, tails in words.pairs(codes):
            pairs, times = np.unique(pairs, return_counts=True)
            times = times.astype(np.int32)
            parts.append(_summed([(strings, times[of]) for strings, of in words.heads_of(pairs, tails)]))
            if len(parts) >= 8:
                parts = [_summed(parts)]
        found[group] = _summed(parts)
    inner = []
    for strings, of in words.inner():
        distinct, at = np.unique(strings, return_inverse=True)
        inner.append((distinct, _sums(at, n[of], len(distinct)).astype(np.int32)))
    strings = np.unique(np.concatenate([x for x, _ in [*found.values(), *inner]]))
    counts = np.zeros((len(strings), n.shape[1]), np.int32)
    for group, (own, times) in found.items():
        if group >= 0:
            counts[np.searchsorted(strings, own), group] = times
    for own, times in inner:
        counts[np.searchsorted(strings, own)] += times
    return strings, counts


def _bucket(strings: np.ndarray, buckets: int) -> np.ndarray:
    return (strings ^ (strings >> 17) ^ (strings >> 31)) % 1_000_003 % buckets


def _bucket_of(column: str, buckets: int):
    """``_bucket`` of a column."""
    x = F.col(column)
    mixed = x.bitwiseXOR(F.shiftright(x, 17)).bitwiseXOR(F.shiftright(x, 31))
    return F.pmod(F.pmod(mixed, F.lit(1_000_003)), F.lit(buckets)).cast("int")


def _chunk_tables(docs: DataFrame, buckets: int, groups: int, depth: int) -> DataFrame:
    """The rows of ``chunks.dictionaries`` and, in rows of their own, the distinct byte strings of every chunk (``strings``), those of one
    bucket together, and how often they occur in its texts of each group (``times``)."""
    schema = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()),
                        *((c, pa.binary()) for c in ("pos", "words", "sizes", "n", "strings", "times"))])

    def run(batches: Batches) -> Batches:
        book, texts = None, {}

        def of_words() -> pa.RecordBatch:
            rows = book.rows(buckets, True)
            none = [None] * len(rows["bucket"])
            return pa.RecordBatch.from_pydict(rows | {"strings": none, "times": none}, schema)

        def of_strings() -> pa.RecordBatch:
            words = list(book.codes)
            size = np.fromiter(map(len, words), np.int64, len(words))
            strings, n = _string_counts(_Words(b"".join(words), size, depth), texts, book.n)
            bucket = _bucket(strings, buckets)
            order = np.argsort(bucket, kind="stable")
            parts = np.split(order, np.searchsorted(bucket[order], np.arange(1, buckets)))
            used = [b for b, mine in enumerate(parts) if len(mine)]
            none = [None] * len(used)
            return pa.RecordBatch.from_pydict({
                "bucket": used, "chunk": [book.id] * len(used), "pos": none, "words": none, "sizes": none, "n": none,
                "strings": [strings[parts[b]].tobytes() for b in used],
                "times": [pack(n[parts[b]].ravel()) for b in used]}, schema)

        for batch in batches:
            book = book or Dictionary(CHUNK_BYTES, batch.column("_part")[0].as_py(), CHUNK_BYTES, groups)
            for text, group in zip(utf8(batch), batch.column("_group").to_pylist()):
                texts.setdefault(group, []).append(book.code(text, split_tokens))
                if book.full:
                    book.tally_all(texts)
                    yield of_words()
                    yield of_strings()
                    book.renew()
                    texts.clear()
                    trim()
        if book and book.codes:
            book.tally_all(texts)
            yield of_words()
            yield of_strings()
        del book
        texts.clear()
        trim()

    return docs.select("text", "_group", F.spark_partition_id().alias("_part")).mapInArrow(
        run, "bucket int, chunk long, pos binary, words binary, sizes binary, n binary, strings binary, times binary")


def _counted(groups: int):
    def counted(key: tuple, rows: pa.Table) -> pa.Table:
        each = [np.frombuffer(x, "<i8") for x in rows.column("strings").to_pylist()]
        strings = np.unique(np.concatenate(each))
        n = np.zeros((len(strings), groups), np.int64)
        for own, times in zip(each, rows.column("times").to_pylist()):
            n[np.searchsorted(strings, own)] += unpack(times).reshape(-1, groups)
        return pa.table({"string": strings, **{f"n{g}": n[:, g] for g in range(groups)}})

    return counted


def _string_values(groups: int):
    def values(rows: pa.Table, predicted: pa.Table) -> pa.Table:
        """``a``: the byte strings; ``b``: the log10 probabilities of their last bytes as 32-bit numbers, per group."""
        strings = predicted.column("string").to_numpy()
        order = np.argsort(strings)
        strings, p = strings[order], matrix(predicted.column("log10_p"), groups).astype("<f4")[order]
        each = [p[np.searchsorted(strings, np.frombuffer(x, "<i8"))].tobytes() for x in rows.column("strings").to_pylist()]
        out = pa.table({"chunk": rows.column("chunk"), "a": rows.column("strings").cast(pa.binary()), "b": pa.array(each, pa.binary())})
        del strings, order, p, each
        trim()
        return out

    return values


def _kinds(docs: DataFrame, group: str | None, most: int) -> tuple[list, list[float]]:
    """The most frequent groups of the learning rows, the last standing for all others, and the log10 of their shares."""
    if group is None:
        return [None], [0.0]
    n = docs.where("_learn").groupBy(group).agg(F.count(F.lit(1)).alias("n"))
    rest = int(n.agg(F.sum("n")).first()[0] or 0)
    found = n.where(F.col(group).isNotNull()).orderBy(F.desc("n"), group).limit(most - 1).collect()
    rest -= sum(r.n for r in found)
    sizes = [r.n for r in found] + [rest]
    shares = [(x + 0.5) / (sum(sizes) + 0.5 * len(sizes)) for x in sizes]
    return [*(r[0] for r in found), None], [float(np.log10(x)) for x in shares]


def score_held_out(docs: DataFrame, group: str | None = None, depth: int = DEPTH, folds: int = 10) -> DataFrame:
    """``score`` with a model of the rows whose crc32(doc_id) is not divisible by ``folds``, and ``held_out``."""
    held = crc_mod("doc_id", folds) == 0
    kept = without(docs, ["held_out", "_in"])
    return score(docs.select(*kept, held.alias("held_out"), (~held).alias("_in")), "_in", group, depth)
