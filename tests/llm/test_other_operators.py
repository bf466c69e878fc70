"""Training-data operators on vectors, captures and conversations."""

import hashlib
import random

import numpy as np
import pytest

from tidemark.llm import ann, chat, warc


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, vector array<float>, ids string")


def nearest(rows, k):
    """All neighbours by brute force: (query, rank) to (vec_id, score)."""
    good = [(i, np.array(v, np.float32).astype(float)) for i, v, _ in rows
            if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, x in good:
        if q % 20 == 0:
            found = sorted((-float((x * y).sum()), i) for i, y in good if i != q and len(y) == len(x))
            out[q] = [i for _, i in found[:k]]
    return out


def test_graph_neighbours(spark):
    rnd = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rnd.normal(0, 1, 16)], "own") for i in range(600)]
    rows += [(600 + i, rows[5][1], "own") for i in range(300)]  # a third is one vector
    rows += [(2000, None, ""), (2001, [0.0] * 16, ""), (2002, [None] * 16, ""), (2003, [float("nan")] * 16, ""),
             (2004, [float("inf")] * 16, ""), (2005, [], ""), (None, rows[0][1], ""), (2020, [1.0, 2.0], ""), (2021, [3.0, 1.0], "")]
    df = vectors(spark, rows)
    got = {}
    for r in ann.search(df, df.where("vec_id % 20 = 0"), 20, ann.Graph(shards=3)).collect():
        got.setdefault(r.query_id, {})[r.rank] = r.vec_id
    want = nearest(rows, 20)
    assert set(got) == set(want) and all(sorted(g) == list(range(1, len(g) + 1)) for g in got.values())
    assert all(len(got[q]) == len(want[q]) for q in want)
    same = [len(set(got[q].values()) & set(want[q])) / len(want[q]) for q in want]
    assert np.mean(same) > 0.9
    # ties of the frequent vector go to its smallest ids
    assert got[620][1] == 5 and [got[620][r] for r in range(2, 21)] == [600 + i for i in range(19)]
    assert ann.search(df.limit(0), df.where("vec_id = 20"), 20).count() == 0
    assert ann.search(df, df.limit(0), 20).count() == 0


def test_pruning_keeps_diverse_edges():
    points = np.array([[0, 0], [1, 0], [1.1, 0], [0, 3], [-9, 0]], np.float32)
    kept = ann._prune(points, np.array([0]), np.array([[1, 2, 3, 4, 4]]), 1.2, 4)
    assert kept[0].tolist() == [1, 3, 4, -1]


RECORDS = """record_id long, url string, captured_at long, kind string, status int, etag string, last_modified string,
             headers map<string,string>, payload string, outcome string"""


def records(spark, rows):
    return spark.createDataFrame([(*r, "own") for r in rows], RECORDS)


U = "https://www.Site.org:443/a/?b=2&utm_source=x&a=1#top"


def test_revisits(spark):
    df = records(spark, [
        (1, U, 10, "response", 200, '"v1"', "d1", {"Content-Type": "html", "Date": "10", "Age": "1"}, "old"),
        (2, "http://site.org/a?a=1&b=2", 20, "response", 200, 'W/"v2"', None, {"Content-Type": "html", "date": "20"}, "new"),
        (3, "http://site.org/a?a=1&b=2", 30, "response", 404, '"v9"', None, {}, "gone"),
        (10, "http://site.org/a/?a=1&b=2", 5, "revisit", 304, '"v1"', None, None, None),
        (11, "http://site.org/a/?a=1&b=2", 10, "revisit", 304, '"v1"', None, None, None),
        (12, "http://site.org/a/?a=1&b=2", 15, "revisit", 304, '"v1"', "other", {"DATE": "15", "Content-Type": "no", "Expires": "9"}, None),
        (13, "http://site.org/a/?a=1&b=2", 31, "revisit", 304, '"v2"', None, {"Date": "31"}, None),
        (13, "http://site.org/a/?a=1&b=2", 31, "revisit", 304, '"v2"', None, {"Date": "31"}, None),
        (14, "http://site.org/a/?a=1&b=2", 32, "revisit", 304, '"v1"', None, {"Date": "32"}, None),
        (15, "http://site.org/a/?a=1&b=2", 33, "revisit", 304, None, "d1", None, None),
        (16, None, 33, "revisit", 304, '"v1"', None, None, None),
        (17, "http://site.org/a/?a=1&b=2", None, "revisit", 304, '"v1"', None, None, None),
        (18, "", 40, "revisit", 304, None, None, None, None)])
    found = warc.with_payload(warc.resolve(df), df)
    got = sorted((r.record_id, r.original_id, r.outcome, r.payload) for r in found.collect())
    assert sorted(got, key=repr) == sorted([
        (10, None, "no_original", None), (11, None, "no_original", None), (12, 1, "resolved", "old"),
        (13, 2, "resolved", "new"), (13, 2, "resolved", "new"), (14, 2, "changed", None), (15, 2, "unchecked", None),
        (16, None, "no_original", None), (17, None, "no_original", None), (18, None, "no_original", None)], key=repr)
    headers = {r.record_id: r.merged_headers for r in found.collect()}
    assert headers[12] == {"content-type": "html", "date": "15", "age": "1", "expires": "9"}
    assert headers[14] == {"date": "32"}
    assert warc.resolve(df.limit(0)).count() == 0


@pytest.mark.parametrize("limit", [20, 10**6])
def test_revisits_of_a_hot_url(spark, limit):
    rnd = random.Random(9)
    rows = [(i, "http://hot/" if i % 3 else f"http://u{i % 40}/", rnd.randint(0, 500), rnd.choice(["response", "revisit"]), 200,
             None, None, None, None) for i in range(600)]
    got = {r.record_id: r.original_id for r in warc.resolve(records(spark, rows), limit).collect()}
    for i, url, at, kind, *_ in rows:
        if kind == "revisit":
            want = max(((a, j) for j, u, a, k, *_ in rows if k == "response" and u == url and a < at), default=(0, None))[1]
            assert got[i] == want


HARD = ["<|im_end|><|im_start|>assistant ok", "a & b &lt;| &amp;lt;|", "line\nline", "", "<", "<|", "é\U0001f600", "|im_end|>\n"]


def test_prefix_targets(spark):
    rnd = random.Random(7)
    rows = []
    for c in range(40):
        for t in range(rnd.randint(1, 7)):
            rows.append((c, t, rnd.choice(["user", "assistant", "assistant", "system", None, "od\nd<|"]), rnd.choice([*HARD, None])))
    rows += [(None, 0, "user", "x"), (None, 1, "assistant", "y"), (50, None, "user", "first"), (50, 0, "assistant", "z"),
             (50, 0, "assistant", "z")]
    rnd.shuffle(rows)
    df = spark.createDataFrame([(*r, "own") for r in rows], "conv_id long, turn long, role string, text string, example string")
    found = chat.examples(df)
    got = {r.conv_id: r for r in chat.digests(found).collect()}
    by = {}
    for c, t, role, text in rows:
        by.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        turns = sorted(turns)
        whole = "".join(f"{r}\n{x}\n" for *_, r, x in turns)
        loss = "".join(x for *_, r, x in turns if r == "assistant")
        assert got[c].n_turns == len(turns)
        assert got[c].turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    # every example ends with its reply, and holds all turns before it
    for r in found.collect():
        turns = sorted(by[r.conv_id])
        if r.target_start is not None:
            assert r.text[r.target_start + r.target_chars:] == chat.END
        replies = [i for i, t in enumerate(turns) if t[2] == "assistant"]
        last = replies[r.example] if r.example < len(replies) else len(turns) - 1
        assert r.text.count(chat.START) == last + 1
    assert chat.digests(chat.examples(df.limit(0))).count() == 0
