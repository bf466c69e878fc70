"""Training-data operators on texts, against brute force and on odd rows."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import bpe, chunks, ctw, mixing, quality_net, quality_rules, simhash, suffix_dedup
from tidemark.llm.components import connected
from tidemark.llm.queries import tokenizer
from tidemark.session import written

WORD = re.compile("[^\x20\x09-\x0d]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns named like those the operators make.
CLASH = ["ids", "score", "kept", "bits", "fingerprint", "rate", "_chunk", "n_words", "held_out"]


def frame(spark, texts, extra=False):
    rows = [(i, t, "en" if (i or 0) % 3 else "fr", "s" if (i or 0) % 2 else None, 0 if t is None else len(t)) for i, t in texts]
    df = spark.createDataFrame(rows, SCHEMA)
    if extra:
        df = df.withColumns({c: F.lit("own") for c in CLASH})
    return written(df, "test-docs")


def prose(rnd, n, words=400):
    return " ".join(rnd.choice(VOCABULARY[:words]) for _ in range(n))


RND = random.Random(4)
VOCABULARY = ["".join(RND.choice("abcdeéñœ") for _ in range(RND.randint(1, 7))) for _ in range(400)]
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "two words"), (6, "  lead\n\n\ttabs \x0b x\x1cy z  "),
       (7, "x" * 30_000), (8, "it's <|endoftext|> and <|endoftext|><|endoftext|>, we'll\r\nsee  "),
       (9, "Ünïcode ß 漢字 \U0001f600 é 12345 --- ***"), (None, "no id at all"), (None, None),
       (10, "again and again and again and again"), (10, "again and again and again and again")]


@pytest.fixture(scope="module")
def odd(spark):
    return frame(spark, ODD, extra=True)


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, [])


def test_packing():
    rnd = np.random.default_rng(1)
    for top in (2, 200, 20_000, 3_000_000, 2**31 - 1):
        numbers = rnd.integers(0, top, 1000)
        assert (chunks.unpack(chunks.pack(numbers)) == numbers).all()
    assert len(chunks.unpack(chunks.pack(np.zeros(0)))) == 0
    assert chunks.unpack_words(*chunks.pack_words([b"a", b"", b"bcd"])) == [b"a", b"", b"bcd"]


def library_ids(texts):
    from tokenizers import Tokenizer
    reference = Tokenizer.from_str(tokenizer())
    reference.no_truncation()
    reference.no_padding()
    return [reference.encode(t or "", add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("limit", [3, 10**6])
def test_bpe_equals_library(spark, odd, monkeypatch, limit):
    monkeypatch.setattr(chunks.dictionaries, "__defaults__", (None, 1, limit))
    monkeypatch.setattr(chunks.coded, "__defaults__", (limit,))
    rnd = random.Random(2)
    marks = ["'s", " ", "  ", "\n", " ", " ", "\x1c", "<|endoftext|>", "<|", "é", "漢", "7", "a", "B", "!", "'", "\t"]
    noise = [(100 + i, "".join(rnd.choice(marks) for _ in range(40))) for i in range(60)]
    docs = odd.unionByName(frame(spark, noise, extra=True))
    docs = written(docs, "test-bpe")
    got = bpe.decode(bpe.encode(docs, tokenizer()), tokenizer()).collect()
    texts = [t for _, t in ODD + noise]
    want = sorted(zip(library_ids(texts), [t or "" for t in texts]))
    assert sorted((list(r.ids), r.text) for r in got) == want
    assert {r.kept for r in got} == {"own"}


def test_bpe_digests(spark, odd):
    rows = bpe.digests(bpe.encode(odd, tokenizer()), tokenizer()).collect()
    want = sorted((len(i), hashlib.sha256(np.array(i, "<u4").tobytes()).hexdigest(),
                   hashlib.sha256((t or "").encode()).hexdigest()) for i, (_, t) in zip(library_ids([t for _, t in ODD]), ODD))
    assert sorted((r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows) == want


def test_decode_bad_ids(spark):
    df = spark.createDataFrame([(1, [220, 33]), (2, [160]), (3, []), (4, None)], "doc_id long, ids array<int>")
    texts = {r.doc_id: r.text for r in bpe.decode(df, tokenizer()).collect()}
    assert texts[1] == " B" and texts[2] == "�" and texts[3] == texts[4] == ""


def test_empty_tables(spark, empty):
    assert bpe.decode(bpe.encode(empty, tokenizer()), tokenizer()).count() == 0
    assert simhash.components(empty).count() == 0
    assert simhash.one_of_each(empty).count() == 0
    assert quality_rules.judge(empty).count() == 0
    assert suffix_dedup.repeated_spans(empty).count() == 0
    assert suffix_dedup.without_repeats(empty).count() == 0
    assert ctw.score_held_out(empty, "lang").count() == 0
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality_net.score_held_out(empty, labels).count() == 0
    none = spark.createDataFrame([], "doc_id long, domain string")
    assert mixing.rates(empty, none, {"a": 1.0}).count() == 0
    assert mixing.mixed(empty, none, {"a": 1.0}).count() == 0


def fingerprint(text, words=4):
    w = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    parts = [" ".join(w[i:i + words]) for i in range(max(1, len(w) - words + 1))] if w else []
    h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def near_texts():
    rnd = random.Random(11)
    out = []
    for i in range(40):
        base = prose(rnd, 150).split()
        for j in range(4):
            copy = list(base)
            for _ in range(j):
                copy[rnd.randrange(150)] = rnd.choice(VOCABULARY)
            out.append((100 + 10 * i + j, " ".join(copy)))
    return out


@pytest.mark.parametrize("size", [2000, 10**7])
def test_simhash_components(spark, odd, monkeypatch, size):
    """All pairs by brute force; small cells are cut again and again."""
    monkeypatch.setattr(simhash.links, "__defaults__", (4, size))
    near = near_texts()
    docs = odd.unionByName(frame(spark, near, extra=True))
    rows = ODD + near
    prints = [fingerprint(t) for _, t in rows]
    label = list(range(len(rows)))

    def find(a):
        while label[a] != a:
            a = label[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                label[find(a)] = find(b)
    least = {}
    for a, (i, _) in enumerate(rows):
        if i is not None:
            least[find(a)] = min(i, least.get(find(a), i))
    want = sorted(((i, f"{prints[a]:016x}", least.get(find(a))) for a, (i, _) in enumerate(rows)), key=repr)
    got = [(r.doc_id, r.fingerprint, r.component_id) for r in simhash.components(docs).collect()]
    assert sorted(got, key=repr) == want
    left = simhash.one_of_each(docs)
    assert left.columns == docs.columns
    assert left.count() == len({find(a) for a in range(len(rows))})


def test_components_of_long_chains(spark):
    pairs = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (101, 100), (200, 200), (None, 5), (300, 100)]
    df = spark.createDataFrame(random.Random(1).sample(pairs, len(pairs)), "a long, b long")
    got = {r.node: r.label for r in connected(df).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 300: 100}


def test_base_counts(spark, odd):
    texts = ODD + [(200 + i, prose(random.Random(i), 60, 6).replace(" ", "\n", 12) + " #*$%&|<> a\na\n\n \n \n") for i in range(20)]
    got = sorted(quality_rules.base_counts(frame(spark, texts)).select("doc_id", *quality_rules.COUNTS).collect(), key=repr)
    want = []
    for i, t in texts:
        w = WORD.findall(t or "")
        windows = Counter(zip(w, w[1:], w[2:]))
        covered = {k for j in range(len(w) - 2) if windows[tuple(w[j:j + 3])] > 1 for k in (j, j + 1, j + 2)}
        seen, again = set(), 0
        for line in (t or "").split("\n"):
            if WORD.search(line):
                again += line in seen
                seen.add(line)
        want.append((i, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), again, len(covered)))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_frequent_lines(spark):
    rnd = random.Random(3)
    menu = "Home  ABOUT 2024"
    texts = [(i, "\n".join([menu.replace("2024", str(1000 + i)), prose(rnd, 80), prose(rnd, 20)])) for i in range(1, 60, 2)]
    texts += [(i, "\n".join([prose(rnd, 45), *["home about 0000"] * 10])) for i in range(101, 131, 2)]
    docs = frame(spark, texts)
    rows = {r.doc_id: r for r in quality_rules.judge(docs, share=0.5).collect()}
    assert all(rows[i].words_left == rows[i].n_words - 3 and rows[i].kept for i in range(1, 60, 2) if not rows[i].base_failed)
    assert all(rows[i].words_left == 45 and not rows[i].kept for i in range(101, 131, 2))
    common = quality_rules.frequent_lines(quality_rules.lines(docs), 0.5, 20)
    assert [r.docs for r in common.collect()] == [45]
    clean = quality_rules.without_common_lines(docs, quality_rules.frequent_lines(quality_rules.lines(docs), 0.2, 10))
    assert clean.columns == docs.columns and clean.where(F.lower("text").contains("home about 0000")).count() == 0


def test_frequent_lines_of_a_hot_source(spark):
    """The limit does not grow with the host: 41 of 1,000 documents are too many, 40 are not, and small hosts have the share."""
    rnd = random.Random(31)
    line = lambda i: "too many have this" if i < 41 else "some have this" if i < 81 else prose(rnd, 4)
    hot = [(i, f"{prose(rnd, 70)}\n{line(i)}", "hot") for i in range(1000)]
    cold = [(i, f"{prose(rnd, 70)}\n" + ("menu of all" if i % 2 else prose(rnd, 3)), "cold") for i in range(2000, 2050)]
    tiny = [(i, f"{prose(rnd, 70)}\n" + ("tiny menu" if i < 3008 else prose(rnd, 3)), "tiny") for i in range(3000, 3015)]
    docs = spark.createDataFrame(hot + cold + tiny, "doc_id long, text string, source string")
    found = quality_rules.lines(docs)
    assert [r.docs for r in quality_rules.frequent_lines(found, 0.1, 20).collect()] == [25]
    rows = {r.doc_id: r for r in quality_rules.judge(written(docs, "test-hot")).collect()}
    taken = {i for i, r in rows.items() if r.words_left < r.n_words}
    assert taken == set(range(41)) | set(range(2001, 2050, 2)) | set(range(3000, 3008))


def test_kept_by_brute_force(spark):
    """Every line of every document looked up in the documents of its host."""
    rnd = random.Random(77)
    shared = [f"{' '.join(rnd.choice('abcdefg') for _ in range(rnd.randint(1, 30)))} {i}x" for i in range(12)]
    rows = []
    for i in range(400):
        host = rnd.choice(["big", "big", "big", "small", None, f"h{i % 9}"])
        own = [" ".join(f"w{rnd.randint(0, 5000)}" for _ in range(rnd.randint(1, 40))) for _ in range(rnd.randint(1, 4))]
        more = [rnd.choice(shared).replace(" ", rnd.choice([" ", "  ", "\t"])).upper() for _ in range(rnd.randint(0, 3))]
        text = own + more
        rnd.shuffle(text)
        rows.append((i, "\n".join(text), host))
    rows += [(1000, None, "big"), (1001, "", None), rows[5], rows[5]]

    def normal(line):
        return " ".join(re.sub("[1-9]", "0", line.lower()).split())

    of_host, lines_in = {}, {}
    for i, text, host in set(rows):
        seen = {normal(x) for x in (text or "").split("\n")} - {""}
        if seen:
            of_host[host] = of_host.get(host, 0) + 1
        for x in seen:
            lines_in[host, x] = lines_in.get((host, x), 0) + 1
    got = {r.doc_id: r for r in quality_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    taken_any = 0
    for i, text, host in rows:
        left = taken = 0
        for x in (text or "").split("\n"):
            n, words = lines_in.get((host, normal(x)), 0), len(x.split())
            common = n > 40 or n >= 5 and n > 0.1 * of_host[host]
            taken, left = (taken + words, left) if common else (taken, left + words)
        r, words = got[i], taken + left
        depleted = taken > 0 and (left < 50 or left < 0.5 * words)
        taken_any += taken > 0
        assert (r.n_words, r.words_left) == (words, left) and r.kept == (not r.base_failed and not depleted), i
    assert taken_any > 50


def test_judge_odd_rows(spark, odd):
    rows = quality_rules.judge(odd, least=1, share=0.0).collect()
    assert len(rows) == len(ODD) and all(r.ids == "own" for r in rows)
    assert sorted(r.words_left for r in rows) == [0] * len(ODD)  # with no limit every line is taken out


def repeats(texts, least):
    """Words of every text that lie in a run of ``least`` words which another document has too."""
    words = [WORD.findall(t or "") for _, t in texts]
    where = {}
    for a, w in enumerate(words):
        for i in range(len(w) - least + 1):
            where.setdefault(tuple(w[i:i + least]), set()).add(texts[a][0])
    out = [np.zeros(len(w), bool) for w in words]
    for a, w in enumerate(words):
        for i in range(len(w) - least + 1):
            if len(where[tuple(w[i:i + least])]) > 1:
                out[a][i:i + least] = True
    return out


def shared_texts():
    rnd = random.Random(8)
    passages = [prose(rnd, n) for n in (50, 51, 70, 300, 49)]
    texts = []
    for i in range(40):
        parts = [prose(rnd, rnd.randint(0, 60)), passages[i % 5], prose(rnd, rnd.randint(0, 90))]
        if i % 7 == 0:
            parts.insert(1, passages[(i + 2) % 5])
        texts.append((i + 20, "  \n".join(parts)))
    return texts + [(1000, texts[3][1]), (1001, texts[3][1])]


@pytest.mark.parametrize("group, chunk", [(100_000, 30_000), (100_000, 40), (2, 40), (0, 1)])
def test_repeated_passages(spark, monkeypatch, group, chunk):
    """Also in small pieces, and where groups count as large."""
    monkeypatch.setattr(suffix_dedup, "GROUP", group)
    monkeypatch.setattr(suffix_dedup, "CHUNK", chunk)
    texts = shared_texts()
    want = repeats(texts, 50)
    got = [np.zeros(len(w), bool) for w in want]
    place = {i: a for a, (i, _) in enumerate(texts)}
    spans = suffix_dedup.repeated_spans(frame(spark, texts)).collect()
    for r in spans:
        got[place[r.doc]][r.start:r.end] = True
    assert all((found == right).all() for found, right in zip(got, want))
    assert all(r.first_doc <= r.doc for r in spans)
    assert all(r.kept == (r.first_doc == r.doc) for r in spans)


def test_passages_shared_past_the_first_document(spark):
    """The smallest document has the middle of a passage only; two others share all of it."""
    rnd = random.Random(21)
    passage = prose(rnd, 60).split()
    texts = [(1, " ".join([prose(rnd, 40), *passage[20:42], prose(rnd, 40)]))]
    texts += [(i, " ".join([prose(rnd, 30), *passage, prose(rnd, 30)])) for i in (2, 3)]
    want = repeats(texts, 50)
    got = [np.zeros(len(w), bool) for w in want]
    for r in suffix_dedup.repeated_spans(frame(spark, texts)).collect():
        got[r.doc - 1][r.start:r.end] = True
    assert all((a == b).all() for a, b in zip(got, want))


def test_passages_at_a_later_place_of_the_first_document(spark):
    """A line of 16 words, the only suffix that is sure to be selected, stands in the smallest document twice: first
    elsewhere, then in the passage it shares."""
    rnd = random.Random(22)
    hashes = suffix_dedup._Hashes()
    of = lambda line: int(suffix_dedup._prefix_hashes(hashes.of(line.encode()))[0])
    texts = []
    for i in range(0, 20, 2):
        line = min((prose(rnd, 16) for _ in range(500)), key=of)
        passage = f"{prose(rnd, 17)} {line} {prose(rnd, 17)}"
        texts.append((i + 1, " ".join([prose(rnd, 40), line, prose(rnd, 120), passage, prose(rnd, 40)])))
        texts.append((i + 2, " ".join([prose(rnd, 45), passage, prose(rnd, 45)])))
    docs, want = frame(spark, texts), repeats(texts, 50)
    got = [np.zeros(len(w), bool) for w in want]
    for r in suffix_dedup.repeated_spans(docs).collect():
        assert r.kept == (r.doc % 2 == 1)
        got[r.doc - 1][r.start:r.end] = True
    assert all(b.sum() >= 50 and (a == b).all() for a, b in zip(got, want))
    clean = suffix_dedup.without_repeats(docs).collect()
    assert not any(x.any() for x in repeats([(r.doc_id, r.text) for r in clean], 50))


def test_passages_of_every_kind(spark):
    """Near copies, copies, passages inside others, repeats inside a text, at its ends and in a very long one."""
    rnd = random.Random(31)
    long = prose(rnd, 400).split()
    inner = long[100:160]
    texts = [(1, " ".join(long)), (2, " ".join(long[:200] + ["changed"] + long[201:])), (3, " ".join([prose(rnd, 30), *inner, prose(rnd, 9)])),
             (4, " ".join(inner)), (5, " ".join(inner[:50])), (6, " ".join(inner[10:60])), (7, " ".join(inner[:49])), (8, " ".join(long[230:]))]
    texts += [(9, " ".join([*inner[:55], prose(rnd, 5), *inner[5:]])), (10, " ".join(["again"] * 300)), (11, " ".join(["again"] * 120)),
              (12, " ".join(long)), (13, " ".join([prose(rnd, 20_000), *inner[3:58], prose(rnd, 9_000)])), (14, None), (15, "")]
    for j in range(20):
        copy = list(long)
        for at in rnd.sample(range(400), 8):
            copy[at] = f"new{j % 3}"
        texts.append((100 + j, " ".join(copy)))
    want = repeats(texts, 50)
    got = {i: np.zeros(len(w), bool) for (i, _), w in zip(texts, want)}
    for r in suffix_dedup.repeated_spans(frame(spark, texts)).collect():
        got[r.doc][r.start:r.end] = True
    assert all((got[i] == w).all() for (i, _), w in zip(texts, want))
    clean = suffix_dedup.without_repeats(frame(spark, texts)).collect()
    assert not any(x.any() for x in repeats([(r.doc_id, r.text) for r in clean], 50))
    assert {r.doc_id: r.text for r in clean}[1] == texts[0][1]


def test_cut_passages(spark, odd):
    texts = shared_texts()
    docs = frame(spark, texts, extra=True).unionByName(odd)
    clean = suffix_dedup.without_repeats(docs)
    assert clean.columns == docs.columns
    rows = clean.collect()
    assert len(rows) == len(texts) + len(ODD)
    assert not any(x.any() for x in repeats([(r.doc_id, r.text) for r in rows], 50))
    before = {g for _, t in texts for g in zip(*[WORD.findall(t)[k:] for k in range(3)])}
    after = {g for r in rows for g in zip(*[WORD.findall(r.text or "")[k:] for k in range(3)])}
    assert {w for g in before for w in g} <= {w for g in after for w in g}  # no word is lost everywhere
    assert suffix_dedup.cut(b"a b  c d", [1, 2], [3, 3]) == b"a  d"
    assert sorted(r.text for r in rows if r.doc_id == 8) == [ODD[7][1]]


def tree_log10(train, word, depth):
    """The weighted context tree of one binary decision after the other, by recursion on exact contexts."""
    from math import exp, lgamma, log

    def steps(w):
        data = bytes(depth - 1) + b" " + (w + b" " if w else b"\n")
        for i in range(depth, len(data)):
            yield data[i - depth:i], data[i]

    counts = {}
    for w, n in train.items():
        for context, symbol in steps(w):
            for k in range(8):
                node, bit = (1 << k) | (symbol >> (8 - k)), symbol >> (7 - k) & 1
                for d in range(depth + 1):
                    c = counts.setdefault((context[depth - d:], node), [0, 0])
                    c[bit] += n

    def estimate(a, b):
        return lgamma(a + 0.5) + lgamma(b + 0.5) - lgamma(a + b + 1) - log(3.141592653589793)

    children = {}
    for context, node in counts:
        if context:
            children.setdefault((context[1:], node), set()).add((context, node))

    def weighted(at):
        pe = estimate(*counts[at])
        if len(at[0]) == depth:
            return pe
        below = sum(weighted(c) for c in children[at])
        top = max(pe, below)
        return top + log((exp(pe - top) + exp(below - top)) / 2)

    total = 0.0
    for context, symbol in steps(word):
        for k in range(8):
            node, bit = (1 << k) | (symbol >> (8 - k)), symbol >> (7 - k) & 1
            p, rest = 0.0, 1.0
            for d in range(depth + 1):
                at = (context[depth - d:], node)
                if at not in counts:
                    p += rest * 0.5
                    break
                a, b = counts[at]
                w = 1.0 if d == depth else exp(estimate(a, b) - weighted(at)) / 2
                p += rest * w * ((b if bit else a) + 0.5) / (a + b + 1)
                rest *= 1 - w
            total += log(p) / log(10)
    return total


def test_tree_equals_recursion(spark):
    train = {b"ab": 3, b"abba": 2, b"b": 1, "é".encode(): 1, b"": 2}
    seen = {**train, b"abc": 0, b"zz": 0}
    words = spark.createDataFrame([(i % 2, bytearray(w), [n, 2 * n]) for i, (w, n) in enumerate(seen.items())],
                                  "cell int, word binary, n array<long>")
    got = {bytes(r.word): r.log10_p for r in ctw.score_words(words, 2, depth=3).collect()}
    double = {w: 2 * n for w, n in train.items()}
    for w in seen:
        assert got[w][0] == pytest.approx(tree_log10(train, w, 3), abs=1e-6)
        assert got[w][1] == pytest.approx(tree_log10(double, w, 3), abs=1e-6)


def test_tree_is_a_distribution(spark):
    """Over all one-byte words, longer words and the end, probabilities come to at most one."""
    words = [(0, bytearray([b]), [1 if b < 100 else 0]) for b in range(33, 256)] + [(0, bytearray(b""), [3])]
    got = ctw.score_words(spark.createDataFrame(words, "cell int, word binary, n array<long>"), 1, 4).collect()
    assert 0.1 < sum(10 ** r.log10_p[0] for r in got) < 1


def test_context_tree_scores(spark, odd):
    rnd = random.Random(13)
    texts = [(i, prose(rnd, 200, 60 if i % 3 else 400)) for i in range(300, 420)]
    docs = written(odd.unionByName(frame(spark, texts, extra=True)), "test-ctw")
    rows = ctw.score_held_out(docs, "lang").collect()
    assert len(rows) == len(texts) + len(ODD) and {r.kept for r in rows} == {"own"}
    from math import log10
    from zlib import crc32
    every = [(i, t) for i, t in ODD + texts]
    split = lambda t: [*(t or "").encode().lower().split(), b""]
    held = lambda i: crc32(b"" if i is None else str(i).encode()) % 10 == 0
    count = Counter(w for i, t in every if not held(i) for w in split(t))
    total = sum(count.values())
    base = lambda t: sum(log10((count[w] + 0.1) / (total + 0.1 * (len(count) + 1))) for w in split(t))
    want = sorted((repr(i), held(i), len(split(t)), sum(count[w] > 0 for w in split(t)), total, round(base(t), 6))
                  for i, t in every)
    assert sorted((repr(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))
                  for r in rows) == want
    outside = [r for r in rows if r.held_out and r.doc_id and r.doc_id >= 300]
    assert outside and all(r.score < 0 and r.bits_per_byte > 0 for r in outside)


def test_context_tree_reads_the_running_text(spark, monkeypatch):
    """The score of a whole text against the recursive tree over its bytes, across words; other orders of the words score otherwise."""
    texts = ["ab ba ab", "abba ab", "Ba  ba\nab é", "", "ab ab ba", "zz ab ba", None, "ba ab ab"]
    learn = [True, True, True, True, False, False, False, False]
    docs = written(spark.createDataFrame(list(zip(range(8), texts, learn)), "doc_id long, text string, learn boolean"), "test-ctw-running")
    running = lambda t: Running("".join(w + " " for w in (t or "").lower().split()).encode())
    train = Counter(running(t) for t, own in zip(texts, learn) if own)
    got = {r.doc_id: r.score for r in ctw.score(docs, "learn", depth=3).collect()}
    for i, text in enumerate(texts):
        assert got[i] == pytest.approx(tree_log10(train, running(text), 3), abs=1e-4)
    assert got[4] != pytest.approx(got[7], abs=1e-3)
    tokens = ctw.split_tokens(texts[2].encode() * 5)
    whole = ctw._strings(ctw._pieces(tokens, 5), 5)[0].tolist()
    monkeypatch.setattr(ctw, "PIECE", 4)
    assert len(ctw._pieces(tokens, 5)) > 10 and ctw._strings(ctw._pieces(tokens, 5), 5)[0].tolist() == whole


@pytest.mark.parametrize("depth", [2, 3, 5, 6, 7])
def test_strings_of_texts_come_from_their_words(monkeypatch, depth):
    """The byte strings of running texts, counted word by word, against those of every byte; what repeats is looked at once."""
    rnd = random.Random(depth)
    odd = [b"a", b"b", b"\0", b"ab", b"\0a", b"abc", "é漢".encode(), b"abcdefg", b"x" * 300, bytes(range(33, 60)), b"\xff" * 7]
    texts = [[*(rnd.choice(odd) for _ in range(rnd.choice([0, 1, 2, 5, 60]))), b""] for _ in range(90)]
    of = [rnd.choice([-1, 0, 1]) for _ in texts]
    book = chunks.Dictionary(10**6, 0, 10**6, 2)
    coded = {}
    for text, group in zip(texts, of):
        codes = book.code(b" ".join(text), ctw.split_tokens)
        book.tally(codes, group)
        coded.setdefault(group, []).append(codes)
    monkeypatch.setattr(ctw, "PIECE", 50)
    monkeypatch.setattr(ctw, "SPAN", 70)
    monkeypatch.setattr(ctw, "KEY_BITS", 63 if depth < 6 else 20)
    words = ctw._Words(b"".join(book.codes), np.array([len(w) for w in book.codes]), depth)
    strings, n = ctw._string_counts(words, coded, book.n[:len(book.codes)])
    want = {-1: Counter(), 0: Counter(), 1: Counter()}
    for text, group in zip(texts, of):
        want[group].update(ctw._strings(ctw._pieces([w.lower() for w in text], depth), depth)[0].tolist())
    assert strings.tolist() == sorted(want[-1] | want[0] | want[1])
    assert n.tolist() == [[want[0][s], want[1][s]] for s in strings.tolist()]
    again = [codes for same in coded.values() for codes in same] * 40
    monkeypatch.setattr(ctw, "SPAN", 10**6)
    looked = sum(len(s) for s, _ in words.inner()) + sum(
        len(s) for pairs, tails in words.pairs(again) for s, _ in words.heads_of(np.unique(pairs), tails))
    assert looked < sum(len(w) + 1 for text in texts for w in text)


def test_spans_are_handed_on_in_small_batches():
    """Rows of many places become many spans, which leave a task some at a time."""
    n = 3 * suffix_dedup.ROWS_OUT
    places = [list(range(100, 100 + n)), [100]]
    rows = pa.table({"hash": [5, 5], "doc": [1, 2], "row": [1, 2], "pos": pa.array(places, pa.list_(pa.int32())),
                     "around": [bytes(16), bytes(16)], "left": [2, 2], "right": [2, 2]})
    batches = list(suffix_dedup._compared(rows, 2))
    assert sum(b.num_rows for b in batches) == n + 1 and max(b.num_rows for b in batches) <= suffix_dedup.ROWS_OUT
    starts = {(d, s) for b in batches for d, s in zip(b.column("doc").to_pylist(), b.column("start").to_pylist())}
    assert starts == {(1, p - 2) for p in places[0]} | {(2, 98)}


class Running(bytes):
    """Words with a space behind each, which ``tree_log10`` spells with the line feed that ends a text."""

    def __add__(self, _):
        return bytes(self) + b"\n"


def test_network_gradients():
    rnd = np.random.default_rng(2)
    net = quality_net.Net.fresh()
    for x in net.parts():
        x[:] = rnd.normal(0, 0.3, x.shape)
    text = bytes(rnd.integers(0, 256, 1200).astype(np.uint8))
    slopes = quality_net._gradients(net, text, 1, 1.0)
    for part, slope in zip(net.parts(), slopes):
        at = np.unravel_index(np.abs(slope).argmax(), slope.shape)
        kept = part[at]
        loss = []
        for d in (1e-2, -1e-2):
            part[at] = kept + d
            loss.append(-np.log(quality_net.probability(net, text)))
        part[at] = kept
        assert (loss[0] - loss[1]) / 2e-2 == pytest.approx(float(slope[at]), rel=0.1)


def test_network_forward_pass_by_loops():
    """The probability of a text, byte by byte, filter by filter, chunk by chunk."""
    rnd = np.random.default_rng(12)
    net = quality_net.Net.fresh(d=3, width=4, f=5, seed=3)
    net.offsets[:] = rnd.normal(0, 0.2, 5)
    for n in (0, 1, 3, 4, 511, 512, 515, 516, 1500):
        text = bytes(rnd.integers(0, 256, n, dtype=np.uint8))
        data = text + bytes(max(0, 4 - n))
        places = len(data) - 3
        pooled = []
        for start in range(0, places, quality_net.CHUNK):
            best = []
            for f in range(5):
                answers = []
                for at in range(start, min(start + quality_net.CHUNK, places)):
                    total = float(net.offsets[f])
                    for k in range(4):
                        for c in range(3):
                            total += float(net.vectors[data[at + k], c]) * float(net.filters[3 * k + c, f])
                    answers.append(total)
                best.append(max(0.0, max(answers)))
            pooled.append(best)
        both = [max(p[f] for p in pooled) for f in range(5)] + [sum(p[f] for p in pooled) / len(pooled) for f in range(5)]
        z = float(net.bias[0]) + sum(float(w) * b for w, b in zip(net.weights, both))
        assert quality_net.probability(net, text) == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-5)


def test_network_covers_whole_texts():
    """A pattern counts wherever it stands, also across the border of chunks."""
    net = quality_net.Net.fresh()
    plain = b"a" * 3000
    for at in (0, 510, 511, 512, 1022, 2995):
        marked = plain[:at] + b"#*#*#" + plain[at + 5:]
        best = quality_net._pooled(net, *quality_net.chunked(marked, net.width)).max(axis=0)
        own = quality_net._pooled(net, *quality_net.chunked(b"a" * 20 + b"#*#*#" + b"a" * 20, net.width)).max(axis=0)
        inside = at in range(6, 2990)
        assert not inside or np.allclose(best, own, atol=1e-5)


def test_network_held_out(spark, odd):
    rnd = random.Random(5)
    good = [(i, prose(rnd, rnd.randint(20, 300))) for i in range(1000, 1240)]
    bad = [(i, prose(rnd, rnd.randint(20, 300)).replace(" ", "*** ")) for i in range(2000, 2060)]
    docs = frame(spark, good + bad + ODD)
    labels = spark.createDataFrame([(i, int(i < 2000), 0) for i, _ in good + bad] + [(None, 1, 0), (1, None, 0), (1000, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    rows = quality_net.score_held_out(docs, labels).collect()
    assert len(rows) == len(good + bad + ODD) and all(0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == int(r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.held_out and (r.doc_id or 0) >= 1000]
    assert len(held) > 30 and np.mean([r.predicted == int(r.doc_id < 2000) for r in held]) > 0.9
    one = labels.where("quality = 1")
    assert all(r.predicted == 1 for r in quality_net.score_held_out(docs, one).collect())


def test_one_long_text_leaves_the_sample_whole(spark):
    """A labelled text of 10 MB, wherever it comes in the order, takes its share of the sample and drops no other."""
    rnd = random.Random(9)
    texts = [(i, prose(rnd, 60) if i % 2 else prose(rnd, 60).replace(" ", "*** ")) for i in range(1000, 1100)]
    labels = spark.createDataFrame([(i, i % 2) for i, _ in texts], "doc_id long, quality int")
    order = [r.doc_id for r in labels.where(quality_net.crc_mod("doc_id", 5) != 0).orderBy(
        F.xxhash64("doc_id", F.lit("train")), "doc_id").collect()]
    whole = {i: t.encode() for i, t in texts}
    for long in (order[0], order[len(order) // 2]):
        pieces = [t if i != long else (t + " ") * (10_000_000 // len(t) + 1) for i, t in texts]
        docs = written(frame(spark, [(i, t) for (i, _), t in zip(texts, pieces)]), "test-long")
        rows = quality_net.sample_of(docs, labels)
        assert [(t, y) for i, (t, y) in zip(order, rows) if i != long] == [(whole[i], i % 2) for i in order if i != long]
        assert 0 < len(rows[order.index(long)][0]) <= quality_net.Sample().longest
        assert sum(len(t) for t, _ in rows) <= quality_net.Sample().bytes
    net = quality_net.fit(docs, labels)
    assert quality_net.probability(net, whole[1001]) > 0.5 > quality_net.probability(net, whole[1000])


def test_sample_holds_both_labels(spark):
    """Rows of the rarer label come late in the order, and the texts before them fill all bytes."""
    texts = [(i, prose(random.Random(i), 60)) for i in range(1000, 1060)]
    docs = frame(spark, texts)
    order = [r.doc_id for r in docs.where(quality_net.crc_mod("doc_id", 5) != 0).orderBy(
        F.xxhash64("doc_id", F.lit("train")), "doc_id").collect()]
    labels = spark.createDataFrame([(i, int(i not in order[-3:])) for i, _ in texts], "doc_id long, quality int")
    small = quality_net.Sample(bytes=6_000)
    rows = quality_net.sample_of(docs, labels, small)
    assert {y for _, y in rows} == {0, 1} and sum(len(t) for t, _ in rows) <= small.bytes


def test_sample_of_texts_that_share_the_bytes():
    assert quality_net.drawn(b"x" * 100, 200) == b"x" * 100
    text = bytes(np.random.default_rng(1).integers(1, 255, 50_000).astype(np.uint8))
    part = quality_net.drawn(text, 4 * quality_net.CHUNK)
    assert len(part) == 4 * quality_net.CHUNK and part[:512] == text[:512] and part[-512:] == text[-512:]


def test_mixing(spark, odd):
    rnd = random.Random(6)
    kinds = {"a": VOCABULARY[:100], "b": VOCABULARY[100:200], "c": VOCABULARY[200:300]}
    texts, domain = [], {}
    for i in range(1000, 1300):
        domain[i] = rnd.choice("aaaabbc")
        texts.append((i, " ".join(rnd.choice(kinds[domain[i]]) for _ in range(rnd.randint(20, 200)))))
    docs = frame(spark, texts + ODD, extra=True)
    labelled = spark.createDataFrame([(i, d) for i, d in domain.items() if i % 2] + [(None, "a"), (1, None)],
                                     "doc_id long, domain string")
    targets = {"a": 0.2, "b": 0.5, "c": 0.3}
    rows = mixing.rates(docs, labelled, targets).collect()
    assert len(rows) == len(texts) + len(ODD) and all(0 <= r.rate for r in rows) and {r.kept for r in rows} == {"own"}
    known = [r for r in rows if r.doc_id in domain]
    assert np.mean([max(r.domains, key=r.domains.get) == domain[r.doc_id] for r in known if r.doc_id % 2 == 0]) > 0.95
    assert all(sum(r.domains.values()) == pytest.approx(1) for r in rows)
    size = sum(r.n_tokens for r in rows)
    for d, share in targets.items():
        assert sum(r.n_tokens * r.rate * r.domains[d] for r in rows) == pytest.approx(share * size, abs=1e-3 * size)
    # plain projected gradient from the same start also reaches the targets, and ends near the same rates
    held = np.array([[r.n_tokens * r.domains[d] for d in "abc"] for r in rows])
    step, rate = 1 / np.linalg.eigvalsh(held.T @ held)[-1], np.ones(len(rows))
    for _ in range(5000):
        rate = np.maximum(rate - step * held @ (held.T @ rate - np.array([0.2, 0.5, 0.3]) * size), 0)
    assert np.abs(held.T @ rate - np.array([0.2, 0.5, 0.3]) * size).max() < 1e-3 * size
    assert np.abs(rate - np.array([r.rate for r in rows])).max() < 0.05
    mix = mixing.mixed(docs, labelled, targets)
    assert mix.columns == docs.columns
    times = Counter(r.doc_id for r in mix.collect())
    for r in known:
        assert int(r.rate) <= times[r.doc_id] <= int(r.rate) + 1
    assert mixing.rates(docs, labelled.where("false"), targets).where("rate <> 1").count() == 0


def test_mixing_reaches_rare_domains(spark):
    """A domain with a hundredth of its target share gets it; what cannot be reached is said."""
    rnd = random.Random(41)
    rows = []
    for i in range(2000):
        b = rnd.uniform(0.001, 0.03)
        rows.append((i, 1, rnd.randint(20, 400), [0.999 - b, b, 0.001] if i % 200 else [0.01, 0.03, 0.96]))
    members = spark.createDataFrame(rows, "doc long, copies long, tokens long, p array<double>")
    size, targets = sum(r[2] for r in rows), {"a": 0.84, "b": 0.01, "c": 0.15}
    fitted = mixing.fit_rates(written(members, "test-members"), list("abc"), targets).collect()
    assert all(r.rate >= 0 for r in fitted) and max(r.rate for r in fitted) > 4
    for i, d in enumerate("abc"):
        assert sum(r.tokens * r.rate * r.p[i] for r in fitted) == pytest.approx(targets[d] * size, abs=1e-3 * size)
    with pytest.warns(UserWarning, match="b 0.5000 wanted"):
        mixing.fit_rates(members, list("abc"), {"a": 0.25, "b": 0.5, "c": 0.25})


def test_mixing_is_native(spark, odd):
    labelled = spark.createDataFrame([(4, "a"), (5, "b")], "doc_id long, domain string")
    plan = mixing.rates(odd, labelled, {"a": 0.5, "b": 0.5})._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
