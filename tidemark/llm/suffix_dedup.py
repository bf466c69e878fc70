"""Repeated passages by sparse suffix arrays.

Suffixes are kept only at positions that their content selects: a word position whose hash over the
next ``PREFIX`` words is the smallest in some window of neighbouring positions. Two occurrences of a
passage of ``least`` words select the same position inside it. What is known of a suffix whose first words are those of no other
document never leaves the first shuffle.

The others are sorted by their content, with the words before them behind it. Each is compared with its neighbour; in
the sorted order, all that share a number of words to the right lie side by side, without a smaller match between them.
For each number of words that a passage may reach to the left of a suffix, those of a run are told apart by these words, and
passages in two documents are matches. All lengths together are the extension to the left and right, and the result is exact: every
word in a passage of ``least`` words that another document has too.

Texts that are equal as a whole are found by their digests, and only the smallest is looked at further. A group of
suffixes with equal first words is compared in one task, in pieces of many small groups, up to ``GROUP`` suffixes; larger groups are
compared by a shuffle of the digests of their passages, with the same result.

Every removed word is justified by an equal word of a smaller (document, position), so one copy of
each passage always stays.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.text import Batches, row_key, utf8
from tidemark.session import written

PREFIX = 16   # words of a suffix that are hashed
WORDS_KEPT = 200_000    # words whose hashes a task remembers
GROUP = 100_000  # suffixes with equal first words that are compared in one task
CHUNK = 30_000   # suffixes compared at a time, whole groups
ROWS_OUT = 50_000  # spans handed on at a time

SPANS = "doc long, row long, start int, end int, first_doc long, kept boolean"

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


class _Hashes(dict):
    """64-bit hashes of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word, 7)
        return value

    def of(self, text: bytes) -> np.ndarray:
        words = text.split()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def _prefix_hashes(words: np.ndarray) -> np.ndarray:
    """Hash of the ``PREFIX`` (a power of two) words from each position on."""
    h, n = words, 1
    while n < PREFIX:
        mixed = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (mixed[:-n] ^ (mixed[:-n] >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15) + mixed[n:]
        n *= 2
    return h


def _sliding(h: np.ndarray, window: int, pick) -> np.ndarray:
    """Smallest or largest of every ``window`` neighbours."""
    n = 1
    while 2 * n <= window:
        h = pick(h[:-n], h[n:])
        n *= 2
    return pick(h[:len(h) - (window - n)], h[window - n:]) if n < window else h


def minimisers(words: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Selected positions of a text and the hashes of their prefixes; none below ``least`` words."""
    if len(words) < least:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h, window = _prefix_hashes(words), least - PREFIX + 1
    low = _sliding(h, window, np.minimum)
    edge = np.zeros(window - 1, np.uint64)
    at = np.flatnonzero(_sliding(np.concatenate([edge, low, edge]), window, np.maximum) == h)
    return at, h[at]


def suffixes(docs: DataFrame, least: int) -> DataFrame:
    """The selected suffixes of all documents: ``hash``, ``doc``, ``row``, ``pos``; and a row for each text with ``pos`` -1, its number
    of words and a digest in ``hash`` and ``more``."""
    def run(batches: Batches) -> Batches:
        hashes = _Hashes()
        for batch in batches:
            hash_, more, pos, words, index = [], [], [], [], []
            for i, text in enumerate(utf8(batch)):
                w = hashes.of(text)
                at, h = minimisers(w, least)
                digest = np.frombuffer(xxhash.xxh3_128_digest(text), np.int64)
                hash_ += [digest[:1], h.view(np.int64)]
                more += [digest[1:], np.zeros(len(at), np.int64)]
                pos += [[-1], at]
                words += [[len(w)], np.zeros(len(at), np.int64)]
                index.append(np.full(1 + len(at), i))
            if not index:
                continue
            of = pa.array(np.concatenate(index))
            yield pa.RecordBatch.from_pydict({
                "hash": np.concatenate(hash_), "more": np.concatenate(more), "doc": batch.column("doc").take(of),
                "row": batch.column("row").take(of), "pos": np.concatenate(pos).astype(np.int32),
                "words": np.concatenate(words).astype(np.int32)})

    return docs.mapInArrow(run, "hash long, more long, doc long, row long, pos int, words int")


def _contexts(docs: DataFrame, wanted: DataFrame, copies: DataFrame, reach: int) -> DataFrame:
    """The ``reach`` words behind the prefix of the wanted (``doc``, ``row``, ``pos``, ``hash``) and the ``reach`` before it, nearest first, as
    32-bit hashes in ``around``, which sorts like the text; how many there are is ``left`` and ``right``. Places of a document
    (of ``CHUNK`` at a time) with the same words around them are one row, with all of them in ``pos``; of equal texts only the first has any."""
    lists = wanted.groupBy("doc", "row").agg(F.collect_set(F.struct("pos", "hash")).alias("at"))
    lists = lists.join(copies.where("not kept"), ["doc", "row"], "left_anti")
    texts = lists.join(docs, ["doc", "row"]).dropDuplicates(["doc", "row"]).select("doc", "row", "at", "text")

    def run(batches: Batches) -> Batches:
        hashes = _Hashes()
        steps = np.concatenate([np.arange(PREFIX, PREFIX + reach), np.arange(-1, -reach - 1, -1)])
        for batch in batches:
            for i, text in enumerate(utf8(batch)):
                words = hashes.of(text).astype(np.uint32)
                chosen = batch.column("at")[i].values
                every = chosen.field("pos").to_numpy()
                padded = np.concatenate([np.zeros(reach, np.uint32), words, np.zeros(reach, np.uint32)])
                for a in range(0, len(every), CHUNK):
                    at = every[a:a + CHUNK]
                    around = np.ascontiguousarray(padded[at[:, None] + reach + steps].astype(">u4"))
                    left, right = np.minimum(at, reach), np.minimum(len(words) - at - PREFIX, reach)
                    places: dict[tuple, list[int]] = {}
                    for key in zip(chosen.field("hash").slice(a, CHUNK).to_pylist(), map(bytes, around), left.tolist(), right.tolist(), at.tolist()):
                        places.setdefault(key[:4], []).append(key[4])
                    hash_, around, left, right = zip(*places)
                    k = pa.array(np.full(len(places), i))
                    yield pa.RecordBatch.from_pydict({
                        "hash": pa.array(hash_, pa.int64()), "doc": batch.column("doc").take(k), "row": batch.column("row").take(k),
                        "pos": pa.array(list(places.values()), pa.list_(pa.int32())), "around": pa.array(around, pa.binary()),
                        "left": pa.array(left, pa.int32()), "right": pa.array(right, pa.int32())})

    return texts.mapInArrow(run, "hash long, doc long, row long, pos array<int>, around binary, left int, right int")


def _left_hashes(words: np.ndarray) -> np.ndarray:
    """Hashes of the first 0, 1, ... words of each row: (number, rows)."""
    out = np.zeros((words.shape[1] + 1, len(words)), np.uint64)
    for o in range(words.shape[1]):
        mixed = (out[o] ^ (out[o] >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + words[:, o] + np.uint64(1)
        out[o + 1] = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return out


def _compared(rows: pa.Table, reach: int) -> Batches:
    """Spans of whole groups of suffixes, sorted by ``hash`` and ``around``."""
    hash_, doc, row, left, right = (rows.column(c).to_numpy() for c in ("hash", "doc", "row", "left", "right"))
    pos = rows.column("pos").combine_chunks()
    many, places = pos.value_lengths().to_numpy(), pos.flatten().to_numpy()
    around = np.frombuffer(b"".join(rows.column("around").to_pylist()), ">u4").reshape(-1, 2 * reach).astype(np.uint32)
    # words shared with the suffix before, to the right
    same = around[1:, :reach] == around[:-1, :reach]
    shared = np.where(same.all(axis=1), reach, same.argmin(axis=1))
    shared = np.concatenate([[-1], np.where(hash_[1:] == hash_[:-1], shared, -1)])
    before = _left_hashes(around[:, reach:])
    # rows by document, so that the first of a class has its smallest
    order = np.lexsort((row, doc))
    new_doc = np.concatenate([[True], (doc[order][1:] != doc[order][:-1]) | (row[order][1:] != row[order][:-1])])
    document = np.empty(len(doc), np.int64)
    document[order] = np.cumsum(new_doc) - 1
    first = np.full((len(doc), reach + 1), -1, np.int64)
    for o in range(reach + 1):
        run = np.cumsum(shared < reach - o).astype(np.uint64)
        key = (run * np.uint64(0x9E3779B97F4A7C15)) ^ before[o]
        able = order[(left[order] >= o) & (right[order] >= reach - o)]
        if not len(able):
            continue
        by_key = able[np.argsort(key[able], kind="stable")]
        begins = np.flatnonzero(np.concatenate([[True], key[by_key[1:]] != key[by_key[:-1]]]))
        sizes = np.diff(np.concatenate([begins, [len(by_key)]]))
        heads = by_key[begins]
        meets = document[heads] != document[by_key[begins + sizes - 1]]
        first[by_key, o] = np.repeat(np.where(meets, heads, -1), sizes)
    # neighbouring passages of one first document are one span
    own = np.where(first >= 0, document[first], -1)
    state = np.where(first >= 0, 2 * own + (own == document[:, None]), -1)
    edge = np.full((len(doc), 1), -2)
    changes = np.diff(np.concatenate([edge, state, edge], axis=1), axis=1) != 0
    at, a = np.nonzero(changes[:, :-1] & (state >= 0))
    _, b = np.nonzero(changes[:, 1:] & (state >= 0))
    source = first[at, a]
    # the same for all places of a row, some spans at a time
    begins, n = np.cumsum(many) - many, many[at]
    for some in np.split(np.arange(len(at)), np.flatnonzero(np.diff(np.cumsum(n) // ROWS_OUT)) + 1):
        each = np.repeat(some, n[some])
        nth = np.arange(len(each)) - np.repeat(np.cumsum(n[some]) - n[some], n[some])
        for c in range(0, len(each), ROWS_OUT):
            i = each[c:c + ROWS_OUT]
            place = places[begins[at[i]] + nth[c:c + ROWS_OUT]]
            yield pa.RecordBatch.from_pydict({
                "doc": doc[at[i]], "row": row[at[i]], "start": (place - b[i]).astype(np.int32),
                "end": (place - a[i] + PREFIX + reach).astype(np.int32), "first_doc": doc[source[i]],
                "kept": document[source[i]] == document[at[i]]})


def _in_groups(contexts: DataFrame, reach: int) -> DataFrame:
    """Spans of groups of at most ``GROUP`` suffixes."""
    def run(batches: Batches) -> Batches:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(len(b.column("pos").flatten()) for b in held) < CHUNK:  # places, of which a row may have many
                continue
            rows = pa.Table.from_batches(held)
            hash_ = rows.column("hash").to_numpy()
            whole = int(np.searchsorted(hash_, hash_[-1]))  # the last group may go on
            if whole:
                yield from _compared(rows.slice(0, whole), reach)
            held = rows.slice(whole).to_batches()
        if held:
            yield from _compared(pa.Table.from_batches(held), reach)

    return contexts.repartition("hash").sortWithinPartitions("hash", "around").mapInArrow(run, SPANS)


def _by_digest(contexts: DataFrame, reach: int) -> DataFrame:
    """The same for larger groups: a row for each passage of ``least`` words around a suffix, shuffled by its digest. Rows of many
    places travel with the first only, and get the others back when it is known which passages are shared."""
    contexts = written(contexts.withColumn("at", F.element_at("pos", 1)), "suffix-large")

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for part in (batch.slice(a, 1000) for a in range(0, batch.num_rows, 1000)):
                index, before, key = [], [], []
                columns = (part.column(c).to_pylist() for c in ("around", "hash", "left", "right"))
                for i, (around, hash_, left, right) in enumerate(zip(*columns)):
                    for o in range(max(0, reach - right), left + 1):
                        index.append(i)
                        before.append(o)
                        key.append(xxhash.xxh64_intdigest(around[:4 * (reach - o)] + around[4 * reach:4 * (reach + o)], (hash_ + o) % 2**64))
                of = pa.array(index, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.array(key, np.uint64).view(np.int64)), *(part.column(c).take(of) for c in ("hash", "doc", "row", "at")),
                     pa.array(before, pa.int32())], ["key", "hash", "doc", "row", "at", "before"])

    own = ["hash", "doc", "row", "at"]
    passages = contexts.select(*own, "around", "left", "right").mapInArrow(
        run, "key long, hash long, doc long, row long, at int, before int")
    place = F.struct("doc", "row")
    shared = passages.groupBy("key").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first <> last")
    found = passages.join(shared.select("key", "first"), "key").join(contexts.select(*own, "pos"), own)
    start = F.col("start") - F.col("before")
    return found.withColumn("start", F.explode("pos")).select(
        "doc", "row", start.alias("start"), (start + PREFIX + reach).alias("end"), F.col("first.doc").alias("first_doc"),
        (F.struct("doc", "row") == F.col("first")).alias("kept"))


def _merged(spans: DataFrame) -> DataFrame:
    """Overlapping or touching spans of one document and first document as one."""
    keys = ["doc", "row", "first_doc", "kept"]
    order = Window.partitionBy(*keys).orderBy("start", "end")
    reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    starts = F.coalesce((F.col("start") > reached).cast("int"), F.lit(1))
    return spans.distinct().withColumn("new", starts).withColumn("part", F.sum("new").over(order)).groupBy(
        *keys, "part").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("part")


def repeated_spans(docs: DataFrame, least: int = 50) -> DataFrame:
    """(``doc``, ``row``, ``start``, ``end``, ``first_doc``, ``kept``): passages of ``least`` words or more (from word ``start``
    up to ``end``) that two documents share; together they cover exactly the words in such passages. ``kept`` spans are those
    that stay, in the smallest document; the others repeat text of ``first_doc``. ``least`` is more than ``PREFIX``.

    ``docs`` has doc_id, source and text. ``row`` tells apart rows with one doc_id; rows without an id take no part, null texts are empty,
    and rows equal in id, source and text count as one document."""
    reach = least - PREFIX
    rows = docs.select(F.col("doc_id").cast("long").alias("doc"), row_key(docs).alias("row"), "text").where(
        "doc is not null")
    found = written(suffixes(rows, least), "suffixes")
    place = F.struct("doc", "row")
    texts = found.where(F.col("pos") == -1).where(F.col("words") >= least)
    digest = ["hash", "more", "words"]
    equal = texts.groupBy(*digest).agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first <> last")
    copies = written(texts.join(equal, digest).select(
        "doc", "row", F.lit(0).alias("start"), F.col("words").alias("end"), F.col("first.doc").alias("first_doc"),
        (place == F.col("first")).alias("kept")).distinct(), "suffix-copies")
    some = found.where("pos >= 0").select("hash", "doc", "row", "pos")
    repeated = written(some.groupBy("hash").agg(
        F.min(place).alias("first"), F.max(place).alias("last"), F.count(F.lit(1)).alias("n")).where("first <> last").select(
        "hash", (F.col("n") > GROUP).alias("hot")), "suffix-groups")
    spans = copies
    for hot, compare in ((False, _in_groups), (True, _by_digest)):
        groups = repeated.where(F.col("hot") == hot).select("hash")
        if not hot or not groups.isEmpty():
            spans = spans.union(compare(_contexts(rows, some.join(groups, "hash"), copies, reach), reach))
    return _merged(spans)


def cut(text: bytes, starts: list[int], ends: list[int]) -> bytes:
    """The text without the words in the spans; white space around them stays."""
    places = [m.span() for m in _WORD.finditer(text)]
    out, at = [], 0
    for a, b in sorted(zip(starts, ends)):
        first, last = places[a][0], places[min(b, len(places)) - 1][1]
        if last > at:
            out.append(text[at:max(at, first)])
            at = last
    return b"".join([*out, text[at:]])


def without_repeats(docs: DataFrame, least: int = 50) -> DataFrame:
    """The documents with repeated passages cut out of all texts but the first; all rows stay, also those that
    become empty. Null texts stay null."""
    spans = repeated_spans(docs, least).where("not kept").groupBy("doc", "row").agg(
        F.collect_list("start").alias("_starts"), F.collect_list("end").alias("_ends"))
    schema = docs.schema
    names = docs.columns
    joined = docs.withColumns({"_doc": F.col("doc_id").cast("long"), "_row": row_key(docs)}).join(
        spans, (F.col("_doc") == spans["doc"]) & (F.col("_row") == spans["row"]), "left").select(
        *[docs[c] for c in names], "_starts", "_ends")

    def run(batches: Batches) -> Batches:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for i, starts in enumerate(batch.column("_starts").to_pylist()):
                if starts:
                    texts[i] = cut(texts[i].encode(), starts, batch.column("_ends")[i].as_py()).decode()
            arrays = [pa.array(texts, pa.string()) if c == "text" else batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return joined.mapInArrow(run, schema)
