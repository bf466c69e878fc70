"""Documents as codes of a chunk's own words, to give every word of a large corpus a value.

One row per word occurrence is far too much to shuffle, and so is one row per document and word. The
documents of a partition therefore share a dictionary, and a document travels as the list of its
words' numbers in it (a byte or two each). The dictionaries go to buckets by the hash of the word, a
packed list per chunk and bucket: in its bucket each distinct word of the corpus is worked on once,
and the values go back to the chunks as packed lists too. A chunk ends when its dictionary or its
share of text is full, so memory does not follow the input. No word is hot: it occurs once per chunk
however often the texts repeat it.

The dictionaries and the coded documents are two passes over the same input. Chunks are named after
the partition, so the input must give the same partitions twice, as files do; hand a derived
DataFrame over as a written table.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable
from itertools import count
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.text import Batches, fields, utf8

WORDS_PER_CHUNK = 500_000
BYTES_PER_CHUNK = 64 << 20
ROWS_OUT = 512

Split = Callable[[bytes], list[bytes]]


def pack(codes: np.ndarray) -> bytes:
    """Small numbers as variable-length bytes: seven bits each, the last byte below 128."""
    codes = codes.astype(np.uint32)
    if not len(codes) or codes.max() < 128:
        return codes.astype(np.uint8).tobytes()
    length = 1 + (codes >= 1 << 7).astype(np.int8) + (codes >= 1 << 14) + (codes >= 1 << 21) + (codes >= 1 << 28)
    end = np.cumsum(length, dtype=np.int64)
    out = np.empty(int(end[-1]), np.uint8)
    for back in range(int(length.max())):
        has = length > back if back else slice(None)
        part = (codes[has] >> np.uint32(7 * back)) & np.uint32(127)
        out[end[has] - 1 - back] = part.astype(np.uint8) | (128 if back else 0)
    return out.tobytes()


def unpack(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    last = raw < 128
    if last.all():
        return raw.astype(np.int32)
    end = np.flatnonzero(last)
    length = np.diff(end, prepend=-1)
    out = raw[end].astype(np.int32)
    for back in range(1, int(length.max())):
        has = np.flatnonzero(length > back)
        out[has] |= (raw[end[has] - back].astype(np.int32) & 127) << (7 * back)
    return out


def pack_words(words: list[bytes]) -> tuple[bytes, bytes]:
    return b"".join(words), pack(np.fromiter(map(len, words), np.int64, len(words)))


def unpack_words(data: bytes, sizes: bytes) -> list[bytes]:
    ends = np.cumsum(unpack(sizes), dtype=np.int64).tolist()
    return [data[a:b] for a, b in zip([0, *ends], ends)]


def lists(rows: np.ndarray) -> pa.Array:
    """The rows of a matrix as lists."""
    ends = np.arange(0, rows.size + 1, rows.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.ascontiguousarray(rows).ravel()))


def matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Lists of one length as the rows of a matrix."""
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return whole.flatten().to_numpy().reshape(-1, width)


def gathered(docs: DataFrame) -> DataFrame:
    """Fewer, larger partitions, as larger chunks repeat fewer words: up to four input splits each, but
    at least two per core."""
    parts = docs.rdd.getNumPartitions()
    cores = docs.sparkSession.sparkContext.defaultParallelism
    return docs.coalesce(max(1, min(parts, max(2 * cores, -(-parts // 4)))))


def buckets_for(docs: DataFrame) -> int:
    """Two for each partition: what meets in a bucket is about half a chunk's words, however many chunks there are."""
    return max(8, 2 * docs.rdd.getNumPartitions())


class Dictionary:
    """The chunks of one partition, in order."""

    def __init__(self, limit: int, part: int, most_bytes: int = BYTES_PER_CHUNK, groups: int = 1):
        self.limit, self.part, self.most_bytes, self.groups, self.chunk = limit, part, most_bytes, groups, -1
        self.renew()

    def renew(self) -> None:
        self.chunk += 1
        self.bytes = 0
        self.codes = defaultdict(count().__next__)
        self.n = np.zeros((1024, self.groups), np.int32)  # a chunk is full long before a count is
        self.id = (self.part << 24) + self.chunk

    def code(self, text: bytes, split: Split) -> np.ndarray:
        self.bytes += len(text)
        words = split(text)
        return np.fromiter(map(self.codes.__getitem__, words), np.int32, len(words))

    def tally(self, codes: np.ndarray, group: int | None) -> None:
        """Count the words of a text for its group; those of other numbers than 0, 1, ... below ``groups`` count nowhere."""
        if len(self.codes) > len(self.n):
            self.n = np.concatenate([self.n, np.zeros((len(self.codes) + (len(self.codes) >> 2) - len(self.n) + 1, self.groups), np.int32)])
        if group is not None and 0 <= group < self.groups and len(codes):
            numbers, times = np.unique(codes, return_counts=True)
            self.n[numbers, group] += times

    def tally_all(self, texts: dict[int, list[np.ndarray]]) -> None:
        """``tally`` for the texts of a chunk at once, by group."""
        self.n = np.zeros((len(self.codes), self.groups), np.int32)
        for group in texts.keys() & range(self.groups):
            self.n[:, group] = np.bincount(np.concatenate(texts[group]), minlength=len(self.codes))

    def rows(self, buckets: int, counted: bool) -> dict[str, list]:
        """The columns of ``dictionaries`` for the chunk."""
        words = list(self.codes)
        bucket = np.fromiter((crc32(w) % buckets for w in words), np.int32, len(words))
        order = np.argsort(bucket, kind="stable")
        out: dict[str, list] = {c: [] for c in ("bucket", "chunk", "pos", "words", "sizes", "n")}
        for b, mine in enumerate(np.split(order, np.searchsorted(bucket[order], np.arange(1, buckets)))):
            if len(mine):
                data, sizes = pack_words([words[i] for i in mine.tolist()])
                row = (b, self.id, pack(np.diff(mine, prepend=0)), data, sizes, pack(self.n[mine].ravel()) if counted else b"")
                for c, v in zip(out, row):
                    out[c].append(v)
        return out

    @property
    def full(self) -> bool:
        return len(self.codes) >= self.limit or self.bytes >= self.most_bytes


def dictionaries(docs: DataFrame, split: Split, buckets: int, group: str | None = None, groups: int = 1,
                 limit: int = WORDS_PER_CHUNK) -> DataFrame:
    """(``bucket``, ``chunk``, ``pos``, ``words``, ``sizes``, ``n``): the distinct words of every chunk, those of one bucket packed
    together, with the steps between their numbers (``pos``). ``n`` packs, word by word, their occurrences in
    rows whose column ``group`` is 0, 1, ... below ``groups``; rows with another number count nowhere, and
    without a column nothing is counted."""
    def run(batches: Batches) -> Batches:
        book = None

        def rows() -> pa.RecordBatch:
            kinds = {"bucket": pa.int32(), "chunk": pa.int64()}
            out = book.rows(buckets, bool(group))
            return pa.RecordBatch.from_pydict({c: pa.array(v, kinds.get(c, pa.binary())) for c, v in out.items()})

        for batch in batches:
            book = book or Dictionary(limit, batch.column("_part")[0].as_py(), groups=groups)
            of = batch.column(group).to_pylist() if group else [-1] * batch.num_rows
            for text, g in zip(utf8(batch), of):
                codes = book.code(text, split)
                if group:
                    book.tally(codes, g)
                if book.full:
                    yield rows()
                    book.renew()
        if book and book.codes:
            yield rows()

    columns = ["text"] + ([group] if group else [])
    return docs.select(*columns, F.spark_partition_id().alias("_part")).mapInArrow(
        run, "bucket int, chunk long, pos binary, words binary, sizes binary, n binary")


def coded(docs: DataFrame, split: Split, limit: int = WORDS_PER_CHUNK, *, most_bytes: int = BYTES_PER_CHUNK) -> DataFrame:
    """The columns of ``docs`` but the text, and ``_chunk`` and ``_codes``: its words as packed numbers of the
    chunk's dictionary."""
    kept = [c for c in docs.columns if c != "text"]
    schema = T.StructType(fields(docs, kept) + list(
        T.StructType.fromDDL("_chunk long, _codes binary").fields))

    def run(batches: Batches) -> Batches:
        book = None
        for batch in batches:
            book = book or Dictionary(limit, batch.column("_part")[0].as_py(), most_bytes)
            chunk, codes = [], []
            for text in utf8(batch):
                chunk.append(book.id)
                codes.append(pack(book.code(text, split)))
                if book.full:
                    book.renew()
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(chunk, pa.int64()), pa.array(codes, pa.binary())],
                [*kept, "_chunk", "_codes"])

    return docs.select(*docs.columns, F.spark_partition_id().alias("_part")).mapInArrow(run, schema)


def assembled(coded_docs: DataFrame, values: DataFrame,
              prepare: Callable[[np.ndarray, list[tuple[int, int]], list[bytes], list[bytes]], object],
              work: Callable[[object, Iterable[np.ndarray]], dict], added: str) -> DataFrame:
    """Give every document the values of its words.

    ``values`` has (``chunk``, ``pos``, ``a``, ``b``): for each row of ``dictionaries`` the values of its words in two packed
    forms. Per chunk, they come first: ``prepare`` gets the numbers of the words in the order of the rows, the
    parts of that order that each row holds, and the rows' ``a`` and ``b``; then ``work`` turns what it
    returned and the word numbers of a few documents at a time into the columns ``added``."""
    kept = [c for c in coded_docs.columns if c not in ("_chunk", "_codes")]
    extra = T.StructType.fromDDL(added)
    schema = T.StructType(fields(coded_docs, kept) + list(extra.fields))
    none = [F.lit(None).cast(coded_docs.schema[c].dataType).alias(c) for c in kept]
    blank = F.lit(None).cast("binary")
    rows = values.select(F.col("chunk").alias("_chunk"), F.lit(0).alias("_kind"), F.col("pos").alias("_codes"),
                         F.col("a").alias("_a"), F.col("b").alias("_b"), *none).union(
        coded_docs.select("_chunk", F.lit(1).alias("_kind"), "_codes", blank.alias("_a"), blank.alias("_b"), *kept))

    def run(batches: Batches) -> Batches:
        chunk, parts, state = None, [], None
        for batch in batches:
            names = np.stack([batch.column("_chunk").to_numpy(), batch.column("_kind").to_numpy()])
            cuts = [0, *(np.flatnonzero((names[:, 1:] != names[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for begin, end in zip(cuts, cuts[1:]):
                if begin == end:
                    continue
                if names[0, begin] != chunk:
                    chunk, parts, state = names[0, begin], [], None
                part = batch.slice(begin, end - begin)
                if names[1, begin] == 0:
                    parts += zip(*(part.column(c).to_pylist() for c in ("_codes", "_a", "_b")))
                    continue
                if state is None:
                    numbers = [np.cumsum(unpack(p[0]), dtype=np.int64) for p in parts]
                    ends = np.cumsum([0, *map(len, numbers)]).tolist()
                    total = ends[-1]
                    state = prepare(np.concatenate([*numbers, np.zeros(0, np.int64)]), list(zip(ends, ends[1:])),
                                    [p[1] for p in parts], [p[2] for p in parts])
                    parts = []
                for at in range(0, part.num_rows, ROWS_OUT):
                    some = part.slice(at, ROWS_OUT)
                    codes = [unpack(v) for v in some.column("_codes").to_pylist()]
                    if any(len(c) and c.max() >= total for c in codes):
                        raise ValueError("the documents were dealt out differently in the two passes")
                    made = work(state, codes)
                    yield pa.RecordBatch.from_arrays(
                        [*(some.column(c) for c in kept), *(pa.array(made[f.name]) for f in extra.fields)],
                        [*kept, *(f.name for f in extra.fields)])

    return rows.repartition("_chunk").sortWithinPartitions("_chunk", "_kind").mapInArrow(run, schema)
