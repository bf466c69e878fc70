"""Rule-based quality: base counts of every text, and lines that too many documents of a host share.

Lines are compared by the hash of their normalised form. For every host, distinct documents per line
are counted with partial sums, so that a line or host with a third of all rows meets as one small
row per task. Lines above the limit are taken out; a document that keeps too little is rejected.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import WHITE, arrow_map, row_key, utf8, without
from tidemark.session import written

#: Fixed values of the base rules: the bytes counted as symbols.
SYMBOLS = b"#*$%&|<>"

_IS_SYMBOL = np.isin(np.arange(256), np.frombuffer(SYMBOLS, np.uint8))
_IS_WHITE = np.isin(np.arange(256), np.frombuffer(b" \t\n\x0b\x0c\r", np.uint8))
_STARTS = (np.arange(256) & 0xC0) != 0x80  # the first byte of a code point

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _sums(flags: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Number of true flags up to each end, per text."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])[ends]
    return np.diff(np.concatenate([[0], total]))


def _repeated_words(words: list[list[bytes]]) -> np.ndarray:
    """Words of each text that lie in a three-word window found at least twice in it."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    text = np.repeat(np.arange(len(words)), size)
    flat = np.empty(len(text), object)
    flat[:] = [w for ws in words for w in ws]
    if len(flat) < 3:
        return np.zeros(len(words), np.int64)
    one = pd.factorize(flat)[0].astype(np.int64)
    n = int(one.max()) + 1
    two = pd.factorize(one[:-1] * n + one[1:])[0].astype(np.int64)
    three = pd.factorize(two[:-1] * n + one[2:])[0].astype(np.int64)
    whole = text[:-2] == text[2:]
    key = pd.factorize(text[:-2] * (int(three.max()) + 1) + three)[0]
    twice = whole & (np.bincount(key, whole, int(key.max()) + 1)[key] >= 2)
    covered = np.zeros(len(flat), bool)
    for ahead in range(3):
        covered[ahead:len(flat) - 2 + ahead] |= twice
    return np.bincount(text, covered, len(words)).astype(np.int64)


def _duplicate_lines(text: bytes) -> int:
    seen: set[bytes] = set()
    found = 0
    for line in text.split(b"\n"):
        if line.strip():  # strips the bytes that separate words
            found += line in seen
            seen.add(line)
    return found


def base_counts(docs: DataFrame) -> DataFrame:
    """Replace ``text`` by its counts: words, their code points, symbols, lines with a word that equal an earlier
    line, and words in repeated three-word windows. A null text has none."""
    kept = without(docs, ["text", *COUNTS])

    def work(batch: pa.RecordBatch) -> dict:
        texts = list(utf8(batch))
        ends = np.cumsum([len(t) for t in texts])
        data = np.frombuffer(b"".join(texts), np.uint8)
        words = [t.split() for t in texts]
        return {
            "n_words": np.array([len(w) for w in words], np.int64),
            "word_chars": _sums(_STARTS[data] & ~_IS_WHITE[data], ends),
            "n_symbols": _sums(_IS_SYMBOL[data], ends),
            "n_dup_lines": np.array([_duplicate_lines(t) for t in texts], np.int64),
            "n_repeat_words": _repeated_words(words),
        }

    return arrow_map(docs.select(*kept, "text"), work, kept, ", ".join(f"{c} long" for c in COUNTS))


def base_failed(least_words: int = 50, repeat_percent: int = 50) -> Column:
    return (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words"))


def _normal(line: Column) -> Column:
    """Lower case, digits as 0, white space as one space."""
    return F.trim(F.regexp_replace(F.translate(F.lower(line), "123456789", "000000000"), f"{WHITE}+", " "))


def lines(docs: DataFrame, host: str = "source") -> DataFrame:
    """(``doc``, ``host``, ``line``, ``words``): the lines with a word of every document, by hash, and their words."""
    text = F.explode(F.split("text", "\n")).alias("raw")
    raw = docs.select(row_key(docs).alias("doc"), F.col(host).alias("host"), text)
    line = raw.select("doc", "host", _normal(F.col("raw")).alias("normal")).where("normal <> ''")
    spaces = F.length("normal") - F.length(F.translate("normal", " ", ""))
    return line.select("doc", "host", F.xxhash64("normal").alias("line"), (spaces + 1).cast("long").alias("words"))


def frequent_lines(found: DataFrame, share: float, least: int, most: int | None = None) -> DataFrame:
    """(``host``, ``line``, ``docs``): lines in more than ``share`` of their host's documents and at least ``least``, or in more
    than ``most`` whatever the share: the limit does not grow with a large host."""
    per_doc = found.groupBy("host", "line", "doc").agg(F.lit(1).alias("one"))
    counted = per_doc.groupBy("host", "line").agg(F.count(F.lit(1)).alias("docs"))
    sizes = found.groupBy("host", "doc").agg(F.lit(1).alias("one")).groupBy("host").agg(
        F.count(F.lit(1)).alias("all"))
    over = F.lit(False) if most is None else F.col("docs") > most
    common = counted.where((F.col("docs") >= least) | over)
    kept = common.join(sizes, common["host"].eqNullSafe(sizes["host"])).drop(sizes["host"])
    of_host = (F.col("docs") >= least) & (F.col("docs") > share * F.col("all"))
    return kept.where(of_host | over).select("host", "line", "docs")


def judge(docs: DataFrame, host: str = "source", share: float = 0.1, least: int = 5, keep_words: int = 50,
          keep_share: float = 0.5, most: int = 40) -> DataFrame:
    """Base counts of every document, ``base_failed``, ``words_left`` without the lines that more than ``share`` of
    the host's documents (and at least ``least``) or more than ``most`` of them have, and ``kept``: false if the
    base rules fail, or if lines were taken out and fewer than ``keep_words`` words or ``keep_share`` of them are left.

    A null host is a host like any other. Documents are counted by id, source and text: rows equal in
    all three are one document for the counts, and stay separate rows of the result."""
    found = written(lines(docs, host), "lines")  # texts are cut and hashed once; a row of it has four numbers
    common = written(frequent_lines(found, share, least, most), "frequent-lines")
    taken = found.join(common, found["host"].eqNullSafe(common["host"]) & (found["line"] == common["line"])).groupBy(
        "doc").agg(F.sum("words").alias("taken"))
    copies = docs.groupBy(row_key(docs).alias("doc")).agg(F.count(F.lit(1)).alias("copies"))
    # rows that are equal in all three were exploded together: their sum is a multiple
    taken = taken.join(copies, "doc").select("doc", (F.col("taken") / F.col("copies")).cast("long").alias("taken"))
    kept = without(docs, ["text", *COUNTS, "base_failed", "words_left", "kept", "_doc"])
    counts = base_counts(docs.select(*kept, row_key(docs).alias("_doc"), "text"))
    left = F.col("n_words") - F.coalesce("taken", F.lit(0))
    depleted = F.col("taken").isNotNull() & ((left < keep_words) | (left < keep_share * F.col("n_words")))
    return counts.join(taken, F.col("_doc") == F.col("doc"), "left").select(
        *kept, *COUNTS, base_failed().alias("base_failed"), left.alias("words_left"),
        (~base_failed() & ~depleted).alias("kept"))


def without_common_lines(docs: DataFrame, common: DataFrame, host: str = "source") -> DataFrame:
    """The documents with the lines in ``common`` (from ``frequent_lines``) taken out of their texts."""
    key = F.struct(row_key(docs).alias("doc"), F.col(host).alias("host"))
    hashed = F.transform(F.split("text", "\n"), lambda raw: F.xxhash64(_normal(raw)))
    numbered = docs.select(key.alias("_key"), F.explode(F.array_distinct(hashed)).alias("line"))
    bad = numbered.join(common, numbered["_key.host"].eqNullSafe(common["host"]) & (numbered["line"] == common["line"]))
    bad = bad.groupBy("_key.doc").agg(F.collect_set(numbered["line"]).alias("_bad"))
    joined = docs.withColumn("_doc", row_key(docs)).join(bad, F.col("_doc") == bad["doc"], "left")
    clean = F.array_join(F.filter(F.split("text", "\n"), lambda raw: ~F.array_contains(
        F.col("_bad"), F.xxhash64(_normal(raw)))), "\n")
    text = F.when(F.col("_bad").isNull(), F.col("text")).otherwise(clean)
    return joined.select(*[text.alias(c) if c == "text" else F.col(c) for c in docs.columns])
