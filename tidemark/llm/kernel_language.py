"""Language of texts by a string kernel: blended-spectrum presence of n-grams, Nyström landmarks, ridge regression.

Two texts are as near as the number of different n-grams of one to three characters that both hold, divided by the
geometric mean of how many each holds. A bounded sample of labelled texts (``Sample``) is learned from: some of it become
landmarks, whose kernel matrix turns kernel values into features (Nyström), and for each language a ridge regression
on these features separates it from the rest. What travels with a task is the landmarks' n-grams, which of them each landmark
holds (a bit each) and a weight for each landmark and language, a megabyte or so.

Scoring is one pass without a shuffle. A text is cut into pieces of equal length that cover all of it; the pieces of a batch are a
0/1 matrix over the landmarks' n-grams, its product with the landmarks gives all kernel values and a second product the
languages' scores. A text has the mean of its pieces' scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.text import arrow_map, crc_mod, utf8, without

LONGEST = 3
BLOCK = 128
#: The answer for texts without a letter.
NONE = "und"


@dataclass(frozen=True)
class Sample:
    """Bounds of what is learned from: ``rows`` labelled rows, the first of each language by the hash of the row, with a piece of
    ``piece`` characters of each, at a place that the hash draws; the first ``landmarks`` of them become landmarks. Languages
    take turns, so that a rare one is learned like a common one."""

    rows: int = 2000
    landmarks: int = 128
    piece: int = 4096
    ridge: float = 0.1


@dataclass
class Model:
    """grams: sorted n-grams of the landmarks; held: a bit for each landmark and gram; sizes: n-grams of each landmark;
    weights: (landmarks, languages)."""

    grams: np.ndarray
    held: np.ndarray
    sizes: np.ndarray
    weights: np.ndarray
    languages: list[str]

    def landmarks(self) -> np.ndarray:
        """(grams, landmarks) as 0 and 1."""
        bits = np.unpackbits(self.held, axis=1, count=len(self.grams))
        return np.ascontiguousarray(bits.T).astype(np.float32)


def grams(text: str) -> np.ndarray:
    """The different n-grams of one to ``LONGEST`` characters, lower-cased, as sorted numbers of 21 bits a character."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
    every, longer = [points], points
    for n in range(1, LONGEST):
        longer = (longer[:-1] << np.uint64(21)) | points[n:]
        every.append(longer)
    return np.unique(np.concatenate(every))


def pieces(text: str, most: int) -> list[str]:
    """The text in as few pieces of at most ``most`` characters as it takes, equally long but for one character; they overlap by
    a gram less one character, so that no gram is lost between them."""
    n = max(1, -(-len(text) // most))
    cuts = [len(text) * i // n for i in range(n + 1)]
    return [text[max(0, a - LONGEST + 1):b] for a, b in zip(cuts, cuts[1:])]


def _kernel(held: list[np.ndarray], vocabulary: np.ndarray, landmarks: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Normalised kernel of texts, given by their grams, with all landmarks."""
    seen = np.zeros((len(held), len(vocabulary)), np.float32)
    for i, g in enumerate(held):
        at = np.minimum(np.searchsorted(vocabulary, g), len(vocabulary) - 1)
        seen[i, at[vocabulary[at] == g]] = 1
    norm = np.sqrt(np.maximum(1, [len(g) for g in held]))
    return (seen @ landmarks) / norm[:, None] / np.sqrt(sizes)


def _in_blocks(held: list[np.ndarray], *landmarks) -> np.ndarray:
    return np.concatenate([_kernel(held[a:a + BLOCK], *landmarks) for a in range(0, len(held), BLOCK)])


def train(texts: list[str], languages: list[str], sample: Sample = Sample()) -> Model | None:
    """Landmarks are the first texts. None without texts."""
    if not texts:
        return None
    names = sorted(set(languages))
    held = [grams(t) for t in texts]
    first = held[:sample.landmarks]
    vocabulary = np.unique(np.concatenate(first))
    bits = np.stack([np.isin(vocabulary, g, assume_unique=True) for g in first])
    sizes = np.array([len(g) for g in first], np.float64)
    model = Model(vocabulary, np.packbits(bits, axis=1), sizes, np.zeros((len(first), len(names))), names)
    around = (vocabulary, model.landmarks(), sizes)
    # Nystrom: features whose inner products are the kernel, as far as the landmarks span it
    values, vectors = np.linalg.eigh(_in_blocks(first, *around))
    good = values > 1e-6 * values[-1]
    features = vectors[:, good] / np.sqrt(values[good])
    x = _in_blocks(held, *around) @ features
    y = (np.array(languages)[:, None] == np.array(names)).astype(np.float64)
    w = np.linalg.solve(x.T @ x + sample.ridge * np.eye(x.shape[1]), x.T @ y)
    model.weights = features @ w
    return model


def sample_of(docs: DataFrame, sample: Sample = Sample()) -> list[tuple[str, str]]:
    """(text, lang) of at most ``sample.rows`` rows, languages taking turns; rows with a null lang or a text without a letter
    are left out. Ids are chosen first, by their hash, from the columns doc_id and lang alone; those of one language are ranked in 64
    groups before they are ranked together, so that a language of a third of all rows is no task of its own."""
    ids = docs.where("lang is not null").select("lang", "doc_id", F.xxhash64("doc_id").alias("key"))
    for by in (["lang", F.pmod("key", F.lit(64))], ["lang"]):
        place = F.row_number().over(Window.partitionBy(*by).orderBy("key", "doc_id"))
        ids = ids.withColumn("turn", place).where(F.col("turn") <= sample.rows)
    chosen = ids.orderBy("turn", "key", "lang", "doc_id").limit(sample.rows).groupBy(
        F.col("lang").alias("_lang"), F.col("doc_id").alias("_doc_id"), F.col("key").alias("_key")).agg(F.min("turn").alias("_turn"))
    same = (F.col("lang") == F.col("_lang")) & F.col("doc_id").eqNullSafe(F.col("_doc_id"))
    at = F.pmod("_key", F.greatest(F.char_length("text") - sample.piece, F.lit(0)) + 1) + 1
    texts = docs.select("doc_id", "lang", "text").where(F.col("text").rlike(r"\p{L}"))
    rows = texts.join(F.broadcast(chosen), same).select(
        "lang", "_turn", "_key", "_doc_id", F.substring(F.col("text"), at.cast("int"), F.lit(sample.piece)).alias("piece"))
    taken = rows.orderBy("_turn", "_key", "lang", "_doc_id", "piece").limit(sample.rows)
    return [(r.piece, r.lang) for r in taken.select("piece", "lang").collect()]


def fit(docs: DataFrame, sample: Sample = Sample()) -> Model | None:
    """Train on ``docs`` (doc_id, text, lang)."""
    taken = sample_of(docs, sample)
    return train([t for t, _ in taken], [n for _, n in taken], sample)


def scores(texts: Iterator[str], model: Model, landmarks: np.ndarray, most: int) -> Iterator[np.ndarray]:
    """For every text the mean score of its pieces by language, with the pieces of many texts in one product."""
    def answered(held: list[np.ndarray]) -> np.ndarray:
        return _kernel(held, model.grams, landmarks, model.sizes) @ model.weights

    def by_piece() -> Iterator[tuple[int, np.ndarray]]:
        owners, held = [], []
        for number, text in enumerate(texts):
            for piece in pieces(text, most):
                owners.append(number)
                held.append(grams(piece))
                if len(held) == BLOCK:
                    yield from zip(owners, answered(held))
                    owners, held = [], []
        if held:
            yield from zip(owners, answered(held))

    for _, rows in groupby(by_piece(), itemgetter(0)):
        yield np.round(np.mean([row for _, row in rows], axis=0), 9)


def predict(docs: DataFrame, model: Model | None, piece: int = Sample.piece) -> DataFrame:
    """Replace ``text`` by ``lang_pred`` and ``score`` (0 to 1). A null or empty text and one without a letter are ``und``
    with score 0, and so is every text if nothing could be learned; of equally likely languages the first by name is taken. Only
    the text counts."""
    kept = without(docs, ["text", "lang_pred", "score"])

    def work(batch: pa.RecordBatch) -> dict:
        names, found = [], []
        lettered = [any(map(str.isalpha, t)) for t in _texts(batch)]
        spoken = (t for t, letters in zip(_texts(batch), lettered) if letters)
        answers = iter(()) if model is None else scores(spoken, model, model.landmarks(), piece)
        for letters in lettered:
            row = next(answers) if letters and model is not None else None
            best = -1 if row is None else int(row.argmax())
            names.append(NONE if row is None else model.languages[best])
            found.append(0.0 if row is None else float(np.clip(row[best], 0, 1)))
        return {"lang_pred": pa.array(names, pa.string()), "score": np.array(found, np.float64)}

    return arrow_map(docs.select(*kept, "text"), work, kept, "lang_pred string, score double")


def _texts(batch: pa.RecordBatch) -> Iterator[str]:
    return (t.decode("utf-8", "replace") for t in utf8(batch))


def predict_held_out(docs: DataFrame, folds: int = 5, sample: Sample = Sample()) -> DataFrame:
    """(``doc_id``, ``held_out``, ``lang_pred``, ``score``) of ``docs`` (doc_id, lang, text), learned from the other folds."""
    model = fit(docs.where(crc_mod("doc_id", folds) != 0), sample)
    return predict(docs.select("doc_id", "text"), model, sample.piece).select(
        "doc_id", (crc_mod("doc_id", folds) == 0).alias("held_out"), "lang_pred", "score")
