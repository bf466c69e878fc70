"""Vector codes, progressive clusters and string kernels, against brute force and on odd rows."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import centroids, kernel_language, vector_codes
from tidemark.session import written

NAN, INF = float("nan"), float("inf")


def vectors(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, vector array<float>, label int")
    return written(df.withColumns({c: F.lit("own") for c in ("code", "cluster", "error", "slot", "distance")}), "test-vectors")


def random_rows(n, length, seed=5, copies=0):
    r = np.random.default_rng(seed)
    x = r.normal(0, 0.2, (n, length)).astype(np.float32)
    x[n - copies:] = x[0]
    return [(i * 3 % n, x[i].tolist(), int(r.integers(0, 4)) if i % 5 else None) for i in range(n)]


ODD_VECTORS = [(9001, None, 1), (9002, [], 1), (9003, [None] * 64, 1), (9004, [NAN] + [0.0] * 63, 1), (9005, [INF] + [0.0] * 63, 1),
               (9006, [0.5] * 63, None), (9007, [1e30] * 64, 2), (None, [0.25] * 64, None), (9008, [0.0] * 64, 3), (9008, [0.0] * 64, 3)]


def plain_nearest(x, entries):
    d = ((x[:, None] - entries[None]) ** 2).sum(axis=2)
    return d.argmin(axis=1), d.min(axis=1)


@pytest.mark.parametrize("seed", range(6))
def test_searches_equal_brute_force(seed):
    """Also with many ties: small integers, equal entries, equal sums."""
    r = np.random.default_rng(seed)
    top = [1, 2, 3, 10, 1000, 2**24][seed]
    x, entries = r.integers(-top, top + 1, (500, 64)), r.integers(-top, top + 1, (16, 64))
    entries[7] = entries[3]
    x[:50] = x[0]
    x[50:66] = entries
    for a, b in zip(centroids.nearest(x, entries), plain_nearest(x, entries)):
        assert (a == b).all()
    book = r.integers(-top, top + 1, (256, 16))
    book[200] = book[100]
    for a, b in zip(vector_codes.nearest(x[:, :16], book), plain_nearest(x[:, :16], book)):
        assert (a == b).all()
    for k in (1, 2):
        assert (vector_codes.nearest(x[:, :16], book[:k])[0] == plain_nearest(x[:, :16], book[:k])[0]).all()


def test_transform_keeps_distances():
    r = np.random.default_rng(3)
    x = r.integers(-99, 99, (20, 64))
    y = centroids.transformed(x)
    assert (((y[0] - y) ** 2).sum(axis=1) == 64 * ((x[0] - x) ** 2).sum(axis=1)).all()
    assert (y[:, 0] == x.sum(axis=1)).all()


def plain_codes(kept, parts, entries, rounds):
    """kept: [(vec_id, ints, label)]"""
    first = {}
    for i, v, _ in sorted(kept, key=lambda k: (k[0] is None, k[0] or 0, k[1])):
        first.setdefault(i, v)
    x = np.array([v for _, v, _ in kept])
    start = np.array(list(first.values())[:entries])
    w = x.shape[1] // parts
    books, cuts = [start[:, p * w:(p + 1) * w].copy() for p in range(parts)], [x[:, p * w:(p + 1) * w] for p in range(parts)]
    for _ in range(rounds):
        for part, book in zip(cuts, books):
            at, _ = plain_nearest(part, book)
            for e in set(at.tolist()):
                book[e] = [sum(c) // len(c) for c in part[at == e].T.tolist()]
    found = [plain_nearest(part, book) for part, book in zip(cuts, books)]
    codes = ["".join(f"{f[0][i]:02x}" for f in found) for i in range(len(x))]
    error = sum(f[1] for f in found)
    of = Counter()
    for (_, _, label), e in zip(kept, error.tolist()):
        of[label] += e
    digest = hashlib.sha256(",".join(str(v) for b in books for v in b.ravel().tolist()).encode()).hexdigest()
    return sorted([(i, c, e, of[label], digest) for (i, _, label), c, e in zip(kept, codes, error.tolist())], key=repr)


@pytest.mark.parametrize("n, copies", [(600, 200), (40, 3)])
def test_codes(spark, n, copies):
    rows = random_rows(n, 64, copies=copies) + ODD_VECTORS
    kept = [(i, np.floor(1024 * np.array(v, np.float64)).astype(np.int64).tolist(), label) for i, v, label in rows
            if v is not None and len(v) == 64 and i not in (9003, 9004, 9005, 9007)]
    coded = vector_codes.compress(vectors(spark, rows), rounds=3)
    assert coded.columns == ["vec_id", "label", "vector", "code", "error", "codebooks_sha256"]
    got = vector_codes.errors(coded).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()
    assert sorted(map(tuple, got), key=repr) == plain_codes(kept, 4, 256, 3)


def test_clusters(spark):
    rows = random_rows(500, 64, copies=170) + ODD_VECTORS
    kept = [(i, np.floor(64 * np.array(v, np.float64)).astype(np.int64)) for i, v, _ in rows
            if v is not None and len(v) == 64 and i not in (9003, 9004, 9005, 9007)]
    key = [hashlib.sha256(f"1:{'null' if i is None else i}".encode()).hexdigest() for i, _ in kept]
    x = np.array([v for _, v in kept])
    book = x[sorted(range(len(x)), key=lambda k: (key[k], x[k].tolist()))[:16]]
    for _ in range(3):
        at, _ = plain_nearest(x, book)
        for c in set(at.tolist()):
            book[c] = [sum(v) // len(v) for v in x[at == c].T.tolist()]
    at, d = plain_nearest(x, book)
    want = [(i, int(c), int(e), int(d[at == c].sum()), int(d.sum()), hashlib.sha256(",".join(map(str, book[c].tolist())).encode()).hexdigest())
            for (i, _), c, e in zip(kept, at, d)]
    got = centroids.inertias(*centroids.cluster(vectors(spark, rows))).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("rows", [[], ODD_VECTORS[:7], [(5, [0.5] * 64, None)]])
def test_few_vectors(spark, rows):
    df = vectors(spark, rows)
    n = sum(1 for i, *_ in rows if i == 5)
    assert centroids.inertias(*centroids.cluster(df)).count() == n
    coded = vector_codes.errors(vector_codes.compress(df, length=64)).collect()
    assert len(coded) == n and all((r.code, r.error, r.label_error) == ("00000000", 0, 0) for r in coded)


def test_length_of_codes(spark):
    """The most frequent length that can be cut is coded."""
    df = vectors(spark, [(i, [0.1 * i] * (8 if i < 5 else 12), 1) for i in range(8)])
    assert {r.vec_id for r in vector_codes.compress(df, entries=2).collect()} == set(range(5))


# ---------------------------------------------------------------- language

SAID = {"en": "the cat and the dog went to the market with the old man", "fr": "le chat et le chien étaient où l'été français commença",
        "de": "der Hund und die Katze gingen über die große Straße zurück", "el": "η γάτα και ο σκύλος πήγαν στην αγορά με τον γέρο"}


def spoken(seed, n):
    r = np.random.default_rng(seed)
    out = []
    for i in range(n):
        lang = sorted(SAID)[i % 4]
        out.append((i, lang, " ".join(r.choice(SAID[lang].split(), 12 + i % 30))))
    return out


def test_kernel_equals_sets():
    texts = [t for _, _, t in spoken(1, 12)] + ["", "a", "AB", "\U0001f600é", "日本語" * 9]

    def plain(t):
        t = t.lower()
        return {t[i:i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)}

    held = [kernel_language.grams(t) for t in texts]
    assert [len(h) for h in held] == [len(plain(t)) for t in texts]
    model = kernel_language.train(texts[:6], ["x", "y"] * 3)
    got = kernel_language._kernel(held, model.grams, model.landmarks(), model.sizes)
    for a, t in enumerate(texts):
        for b, landmark in enumerate(texts[:6]):
            both, sizes = len(plain(t) & plain(landmark)), max(1, len(plain(t))) * len(plain(landmark))
            assert got[a, b] == pytest.approx(both / sizes**0.5, abs=1e-12)


def test_nystroem_with_all_landmarks_is_kernel_ridge():
    """With every row a landmark the answers are those of kernel ridge regression on the whole kernel matrix."""
    rows = spoken(2, 40)
    texts, names = [t for _, _, t in rows], [n for _, n, _ in rows]
    model = kernel_language.train(texts, names, kernel_language.Sample(landmarks=40))
    held = [kernel_language.grams(t) for t in texts]
    k = kernel_language._kernel(held, model.grams, model.landmarks(), model.sizes)
    y = (np.array(names)[:, None] == np.array(model.languages)).astype(float)
    want = k @ np.linalg.solve(k + 0.1 * np.eye(40), y)
    assert np.abs(k @ model.weights - want).max() < 1e-4


def test_pieces_cover_the_text():
    text = "".join(chr(97 + i % 26) for i in range(10_001))
    cut = kernel_language.pieces(text, 4096)
    assert len(cut) == 3 and cut[0] + "".join(p[2:] for p in cut[1:]) == text
    assert set(kernel_language.grams(text)) == set(np.concatenate([kernel_language.grams(p) for p in cut]))
    assert kernel_language.pieces("", 9) == [""]


ODD_TEXTS = [(1, "en", None), (2, None, ""), (3, "en", "123 --- !!! 456"), (4, None, "é"), (5, "fr", SAID["de"] * 2000),
             (None, None, SAID["el"]), (None, "en", None), (6, "en", SAID["en"]), (6, "en", SAID["en"]), (7, "de", "x" * 50_000)]


def test_languages(spark):
    rows = spoken(3, 400) + [(i and i + 1000, n, t) for i, n, t in ODD_TEXTS]
    docs = written(spark.createDataFrame(rows, "doc_id long, lang string, text string").withColumns(
        {c: F.lit("own") for c in ("lang_pred", "score", "_turn", "held_out", "piece")}), "test-spoken")
    got = kernel_language.predict_held_out(docs)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    out = got.collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    said = {i: n for i, n, _ in spoken(3, 400)}
    held = [r for r in out if r.held_out and r.doc_id in said]
    assert len(held) > 50 and all(r.lang_pred == said[r.doc_id] for r in held)
    of = {}
    for r in out:
        of.setdefault(r.doc_id, []).append(r.lang_pred)
    assert of[1001] == of[1002] == of[1003] == ["und"] and of[1005] == ["de"] and of[1006] == ["en"] * 2
    assert sorted(of[None]) == ["el", "und"]


def test_batches_do_not_matter(spark):
    """A text's answer does not depend on its neighbours."""
    docs = written(spark.createDataFrame(spoken(4, 90), "doc_id long, lang string, text string"), "test-spoken")
    model = kernel_language.fit(docs)
    one = {r.doc_id: r.score for r in kernel_language.predict(docs.coalesce(1), model, 50).collect()}
    many = {r.doc_id: r.score for r in kernel_language.predict(docs.repartition(7, "text"), model, 50).collect()}
    assert one == many


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, None, "some text"), (2, "en", None)], "doc_id long, lang string, text string")
    assert [r.lang_pred for r in kernel_language.predict_held_out(docs).collect()] == ["und", "und"]
    assert kernel_language.predict_held_out(docs.limit(0)).count() == 0


def test_rare_language_is_learned(spark):
    """The sample takes languages in turn."""
    rows = [(i, "en", SAID["en"]) for i in range(300)] + [(1000 + i, "el", SAID["el"]) for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    taken = Counter(n for _, n in kernel_language.sample_of(docs, kernel_language.Sample(rows=20)))
    assert taken == {"en": 16, "el": 4}
