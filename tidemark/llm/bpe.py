"""Byte-level BPE over a corpus: every distinct word is encoded once.

Texts are cut into words in Spark, at the places where no merge can reach across: a word is a run
of non-space characters with one leading space, or the white space between. The distinct words are
dealt to buckets and encoded there by the public tokenizer, the ids go back to each chunk's
dictionary, and documents are put together by position (``chunks``). Decoding looks the ids up in the table of
pieces, which has one row per id of the vocabulary (50,257), and joins the pieces' bytes.
"""

from __future__ import annotations

import os
import re
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.llm.chunks import assembled, buckets_for, coded, dictionaries, gathered, pack, unpack, unpack_words
from tidemark.llm.text import Batches, fields, without

#: Characters that the tokenizer's pattern takes as white space.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPECIAL = "<|endoftext|>"

_WORDS = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")


def split_words(text: bytes) -> list[bytes]:
    """The words of a text, which they are when joined. A special token's string is a word of its own."""
    whole = text.decode()
    if SPECIAL not in whole:
        return [w.encode() for w in _WORDS.findall(whole)]
    words = []
    for i, part in enumerate(whole.split(SPECIAL)):
        words += ([SPECIAL.encode()] if i else []) + [w.encode() for w in _WORDS.findall(part)]
    return words


def _tokenizer(model: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a task per core
    from tokenizers import Tokenizer

    loaded = Tokenizer.from_str(model)
    loaded.no_truncation()
    loaded.no_padding()
    return loaded


def _pieces(model: str) -> pa.Array:
    """The bytes of every id, in the order of ids; empty for ids that are not used."""
    tokenizer = _tokenizer(model)
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    # the vocabulary writes a byte as the character of the same number, or as the next free one from 256
    byte = {chr(b): b for b in shown}
    byte |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))}
    out = [b""] * tokenizer.get_vocab_size(with_added_tokens=True)
    for piece, i in tokenizer.get_vocab(with_added_tokens=True).items():
        plain = all(c in byte for c in piece)
        out[i] = bytes(byte[c] for c in piece) if plain else piece.encode()
    return pa.array(out, pa.binary())


def _joined(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray, index: np.ndarray) -> np.ndarray:
    """The lists of ``index`` one after the other; list i is ``sizes[i]`` values from ``starts[i]`` on."""
    first, size = starts[index], sizes[index]
    end = np.cumsum(size, dtype=np.int64)
    total = int(end[-1]) if len(end) else 0
    return values[np.repeat(first - (end - size), size) + np.arange(total)]


def encode_words(book: DataFrame, model: str) -> DataFrame:
    """The ids of the words of ``chunks.dictionaries``, for ``chunks.assembled``: ``a`` packs how many ids each word has, ``b``
    the ids. Each distinct word of a bucket, and so of the corpus, is encoded once. ``model`` is the text of a
    tokenizer file, about a megabyte, that travels with the tasks."""
    def encode(rows: pa.Table) -> pa.Table:
        tokenizer, known = _tokenizer(model), {}
        numbers = []
        for data, sizes in zip(rows.column("words").to_pylist(), rows.column("sizes").to_pylist()):
            words = unpack_words(data, sizes)
            numbers.append(np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words)))
        table, flat, size = list(known), [], []
        for at in range(0, len(table), 5_000):
            some = [w.decode() for w in table[at:at + 5_000]]
            ids = [e.ids for e in tokenizer.encode_batch_fast(some, add_special_tokens=False)]
            size.append(np.fromiter(map(len, ids), np.int64, len(ids)))
            flat.append(np.fromiter((i for x in ids for i in x), np.int32, int(size[-1].sum())))
        flat, size = np.concatenate(flat), np.concatenate(size)
        starts = np.cumsum(size) - size
        return pa.table({
            "chunk": rows.column("chunk"), "pos": rows.column("pos"),
            "a": pa.array([pack(size[n]) for n in numbers], pa.binary()),
            "b": pa.array([pack(_joined(flat, starts, size, n)) for n in numbers], pa.binary())})

    return book.select("bucket", "chunk", "pos", "words", "sizes").groupBy("bucket").applyInArrow(
        encode, "chunk long, pos binary, a binary, b binary")


def encode(docs: DataFrame, model: str) -> DataFrame:
    """Replace ``text`` by ``ids`` (array of int), as the tokenizer encodes each whole text without adding special
    tokens. A null or empty text has no ids. Rows that are equal stay separate rows. ``docs`` must give
    the same partitions when it is read twice (files, or a written table)."""
    docs = gathered(docs.select(*without(docs, ["text", "ids", "_chunk", "_kind", "_codes", "_a", "_b"]), "text"))
    ids = encode_words(dictionaries(docs, split_words, buckets_for(docs)), model)

    def prepare(numbers: np.ndarray, spans: list, a: list[bytes], b: list[bytes]) -> tuple:
        size = np.zeros(len(numbers), np.int64)
        starts = np.zeros(len(numbers), np.int64)
        flat, at = [np.zeros(0, np.int32)], 0
        for (first, last), sizes, packed in zip(spans, a, b):
            own = unpack(sizes).astype(np.int64)
            size[numbers[first:last]] = own
            starts[numbers[first:last]] = at + np.cumsum(own) - own
            flat.append(unpack(packed))
            at += len(flat[-1])
        return np.concatenate(flat), starts, size

    def work(table: tuple, codes: list[np.ndarray]) -> dict:
        index = np.concatenate([*codes, np.zeros(0, np.int32)])
        per_word = np.cumsum(np.concatenate([[0], table[2][index]]))
        ends = per_word[np.cumsum([0, *map(len, codes)])]
        return {"ids": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(_joined(*table, index), pa.int32()))}

    return assembled(coded(docs, split_words), ids, prepare, work, "ids array<int>")


def _decoded(pieces: pa.Array, ids: pa.ListScalar) -> str:
    found = pieces.take(ids.values) if ids.is_valid and len(ids.values) else pieces[:0]
    if not len(found):
        return ""
    offsets, data = np.frombuffer(found.buffers()[1], np.int32), found.buffers()[2]
    first, last = int(offsets[found.offset]), int(offsets[found.offset + len(found)])
    return data[first:last].to_pybytes().decode(errors="replace") if last > first else ""


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """Add ``text``, the text of ``ids``; bytes that are no UTF-8 become the replacement character. Null ids are
    taken as none."""
    kept = without(encoded, ["text"])
    schema = T.StructType([*fields(encoded, kept), T.StructField("text", T.StringType())])

    def run(batches: Batches) -> Batches:
        pieces = _pieces(model)
        for batch in batches:
            texts = [_decoded(pieces, ids) for ids in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([*batch.select(kept).columns, pa.array(texts, pa.string())], [*kept, "text"])

    return encoded.select(*kept).mapInArrow(run, schema)


def digests(encoded: DataFrame, model: str) -> DataFrame:
    """``doc_id``, ``n_tokens`` and the SHA-256 of the ids (little-endian unsigned 32-bit) and of the text they decode to."""
    def run(batches: Batches) -> Batches:
        pieces = _pieces(model)
        for batch in batches:
            ids = batch.column("ids")
            of_ids = [sha256(np.asarray(v.values, "<u4").tobytes() if v.is_valid else b"").hexdigest() for v in ids]
            of_text = [sha256(_decoded(pieces, v).encode()).hexdigest() for v in ids]
            tokens = pc.fill_null(pc.list_value_length(ids), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), tokens, pa.array(of_ids), pa.array(of_text)],
                                             ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return encoded.select("doc_id", "ids").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
