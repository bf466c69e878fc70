"""Streams fed file by file: literal cases, and the batch operators on the same rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators.warehouse import read_final
from tidemark.streaming import joins, patterns, streams, windows
from tidemark.streaming.sinks import batched_sink, drain

BASE = 1_700_000_000  # seconds, a multiple of 10


@pytest.fixture
def feed(spark, tmp_path):
    """A stream that reads one file per micro-batch, each given as rows of (key, value, second)."""
    count = iter(range(100))

    def build(*batches, schema="key string, value string, at double"):
        folder = tmp_path / f"in{next(count)}"
        folder.mkdir()
        for i, rows in enumerate(batches):
            part = folder / f"{i:03d}.csv"
            part.write_text("".join(
                ",".join("" if v is None else str(v) for v in row) + "\n" for row in rows))
            stamp = BASE + i
            import os
            os.utime(part, (stamp, stamp))
        df = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).csv(str(folder))
        return df.withColumn("et", F.timestamp_seconds(F.col("at") + BASE))
    return build


def sec(value):
    """Seconds since BASE of a collected timestamp."""
    if value is None:
        return None
    return (value - dt.datetime.fromtimestamp(BASE)).total_seconds()


def test_three_failed_logins(feed):
    rows = [("user-1", "fail", 1), ("user-1", "fail", 2), ("user-2", "success", 3),
            ("user-1", "fail", 4), ("user-1", "fail", 5)]
    df = feed(rows[:2], rows[2:], [("z", "success", 500)])
    out = drain(patterns.consecutive_match(df, "key", "et", F.col("value") == "fail"))
    got = sorted((r.key, [sec(t) for t in r.match_times]) for r in out.collect())
    assert got == [("user-1", [1, 2, 4]), ("user-1", [2, 4, 5])]


def test_failed_logins_out_of_order(feed):
    df = feed([("u", "fail", 4), ("u", "fail", 1)], [("u", "ok", 3), ("u", "fail", 2)],
              [("u", "fail", 5), ("u", "fail", 6)], [("z", "ok", 500)])
    out = drain(patterns.consecutive_match(df, "key", "et", F.col("value") == "fail", delay="10 seconds"))
    assert [[sec(t) for t in r.match_times] for r in out.collect()] == [[4, 5, 6]]


ORDERS = [("order-1", "create", 1), ("order-2", "create", 2), ("order-1", "pay", 3)]


def test_sequence_match_and_timeout(feed):
    df = feed(ORDERS[:2], ORDERS[2:], [("order-3", "create", 20), ("order-3", "other", 21)],
              [("order-4", "create", 40), ("order-4", "pay", 45)], [("z", "x", 900)])
    out = drain(patterns.sequence_within(
        df, "key", "et", F.col("value") == "create", F.col("value") == "pay", 5))
    got = sorted((r.key, r.kind, sec(r.first_ts), sec(r.second_ts)) for r in out.collect())
    assert got == [("order-1", "match", 1, 3), ("order-2", "timeout", 2, None),
                   ("order-4", "timeout", 40, None)]


def test_order_timeout(feed):
    df = feed(ORDERS, [("order-4", "create", 40), ("order-4", "pay", 45)],
              [("order-5", "create", 50), ("order-5", "create", 53), ("order-5", "pay", 57)],
              [("order-6", "pay", 60)], [("z", "pay", 900)])
    out = drain(patterns.order_timeout(
        df, "key", "et", F.col("value") == "create", F.col("value") == "pay", 5))
    got = sorted((r.key, r.kind, sec(r.at)) for r in out.collect() if r.key != "z")
    assert got == [("order-1", "paid", 3), ("order-2", "timeout", 7), ("order-4", "paid", 45),
                   ("order-5", "paid", 57), ("order-6", "paid", 60)]


def test_tumbling_count_late(feed):
    df = feed([("a", "", 1), ("a", "", 2)], [("a", "", 12)], [("a", "", 3), ("a", "", 4)],
              [("a", "", 16)], [("a", "", 5)], [("z", "", 500)])
    out = drain(windows.tumbling_count_late(df, "key", "et", "10 seconds", lateness=5))
    got = sorted((sec(r.window_start), r.kind, sec(r.at) or 0, r.n) for r in out.collect() if r.key == "a")
    assert got == [(0, "again", 3, 3), (0, "again", 4, 4), (0, "late", 5, None), (0, "main", 0, 2),
                   (10, "main", 0, 2)]


def test_no_late_row_is_lost(feed):
    """Rows hours behind, long after their window was given up."""
    df = feed([("a", "", 1)], [("a", "", 8000), ("a", "", 8001)], [("a", "", 20)], [("z", "", 90000)], [("a", "", 3)],
              [("z", "", 99000)])
    out = drain(windows.tumbling_count_late(df, "key", "et", "10 seconds", lateness=5))
    got = sorted((sec(r.window_start), r.kind, sec(r.at) or 0, r.n) for r in out.collect() if r.key == "a")
    assert got == [(0, "late", 3, None), (0, "main", 0, 1), (20, "late", 20, None), (8000, "main", 0, 2)]


def test_null_keys_match_nothing(feed):
    left = feed([(None, "l", 1), ("a", "l", 1)], CLOSE)
    right = feed([(None, "r", 1), ("a", "r", 1)], CLOSE)
    out = drain(joins.interval_join_late(left, right, "key", "et", -2, 2, delay=3))
    assert [(r.kind, r.left.key, r.right.key) for r in out.collect() if r.left.key != "y"] == [("match", "a", "a")]
    log = drain(joins.changelog_join(feed([(None, "l", 1)]).drop("et"), feed([(None, "r", 2)]).drop("et"), "key", "at", "full"))
    got = [(r.op, r.left and r.left.at, r.right and r.right.at) for r in log.collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, [("+I", 1.0, None), ("+I", None, 2.0)]))


def test_eager_window(feed):
    df = feed([("a", "", 1), ("a", "", 2)], [("a", "", 3), ("b", "", 4)], [("a", "", 11)],
              [("a", "", 5)], [("z", "", 500)])
    out = drain(windows.eager_window(df, "key", "et", "10 seconds"))
    got = sorted((r.key, sec(r.window_start), r.kind, r.n) for r in out.collect() if r.key != "z")
    assert got == [("a", 0, "final", 3), ("a", 0, "running", 1), ("a", 0, "running", 2),
                   ("a", 0, "running", 3), ("a", 10, "final", 1), ("a", 10, "running", 1),
                   ("b", 0, "final", 1), ("b", 0, "running", 1)]


def test_update_mode_counts(feed):
    df = feed([("a", "", 1)], [("a", "", 2), ("a", "", 3)])
    out = drain(windows.tumbling_count(df, "key", "et", "10 seconds", "0 seconds"), "update")
    assert sorted((r.batch_id, r.n) for r in out.collect()) == [(0, 1), (1, 3)]


def test_hot_items_and_uv(feed):
    rows = [("p1", "u1", 0), ("p1", "u2", 10), ("p2", "u1", 20), ("p3", "u3", 30), ("p3", "u3", 40),
            ("p4", "u1", 50), ("p1", "u1", 400)]
    df = feed(rows[:4], rows[4:], [("z", "z", 90000)])
    top = drain(windows.hot_items(df, "key", "et", "10 minutes", "5 minutes", 2)).where("key != 'z'")
    start = dt.datetime.fromtimestamp(BASE - BASE % 300)
    got = sorted((int((r.window_start - start).total_seconds()), r["rank"], r.key, r.view_count)
                 for r in top.collect())
    first = BASE % 300  # offset of BASE in its pane
    early = [r for r in rows if r[2] + first < 300]
    assert got[0] == (-300, 1, "p1", sum(1 for r in early if r[0] == "p1"))
    assert all(rank in (1, 2) for _, rank, _, _ in got)
    for uv in (windows.window_uv_exact, windows.window_uv_approx):
        out = drain(uv(feed(rows[:4], rows[4:], [("z", "z", 90000)]), "value", "et", "1 day"))
        assert [r.uv for r in out.collect()] == [3]


def test_top_n_keyed(feed):
    df = feed([("p1", "3", 1), ("p2", "5", 2)], [("p3", "4", 3)], [("z", "0", 100)])
    marked = streams.watermark(df, "et", "20 seconds").withColumn("score", F.col("value").cast("long"))
    ended = marked.withColumn("until", F.timestamp_seconds(F.lit(BASE + 10))).where("key != 'z'")
    out = drain(windows.top_n_keyed(ended.unionByName(marked.withColumn(
        "until", F.timestamp_seconds(F.lit(BASE + 1000))).where("key = 'z'")), "until", "et", "key", "score", 2))
    assert sorted((r["rank"], r.key, r.score) for r in out.collect()) == [(1, "p2", 5), (2, "p3", 4)]


def test_filter_never_counts_too_many(spark, feed):
    """Batch, stream and merged filters agree; shortfalls stay near their mean."""
    rows = [(f"u{i % 5000}", "", i / 100) for i in range(8000)] + [(None, "", 1.0)]
    df = spark.createDataFrame(rows, "key string, value string, at double").withColumn("et", F.timestamp_seconds(F.col("at") + BASE))
    exact = {r.window_start: r.uv for r in _exact(df).collect()}
    for capacity, error in ((20_000, 0.001), (500, 0.01)):
        m = windows.bitmaps_of(capacity, error)
        for parts in (1, 7):
            got = windows.window_uv_filter(df.repartition(parts), "key", "et", "1 minute", capacity=capacity, error=error).collect()
            found = {r.window_start: r.uv for r in got}
            assert found.keys() == exact.keys()
            for w, n in exact.items():
                mean = windows.missed(n, m)
                assert n - mean - 5 * mean ** 0.5 - 1 <= found[w] <= n
    fed = [(k, "", a) for k, _, a in rows if k]
    out = drain(windows.window_uv_filter(feed(fed[:3000], fed[3000:], [("z", "", 9000)]), "key", "et", "1 minute", capacity=500, error=0.01))
    assert {r.window_start: r.uv for r in out.collect()} == found


def _exact(df):
    from tidemark.operators import windows as batch
    return batch.window_uv_exact(df, "key", "et", "1 minute")


def test_as_of_join_of_streams(feed):
    """Versions before, at and after a row; one that comes late but within the delay; one behind the watermark, for later rows only."""
    left = feed([("a", "r5", 5), ("a", "r0", 0), (None, "none", 5)], [("a", "r20", 20), ("b", "r21", 21)], [("a", "r130", 130), ("b", "b131", 131)],
                [("z", "end", 9000)])
    right = feed([("a", "v1", 1)], [("a", "v5", 5), ("a", "v20", 20)], [("a", "v90", 90), ("b", "v3", 3)], [("z", "end", 9000)])
    for shards in (1, 3):
        out = drain(joins.as_of_join(left, right, "key", "et", "et", delay=30, shards=shards)).where("key is null or key <> 'z'")
        assert sorted((r.value, r.right_value) for r in out.collect()) == [
            ("b131", "v3"), ("none", None), ("r0", None), ("r130", "v90"), ("r20", "v20"), ("r21", "v3"), ("r5", "v5")]


def test_as_of_join_equals_batch(spark, shuffled):
    from tidemark.operators import joins as batch
    rows, df = shuffled

    def sides(d):
        return d.where("value <> 'pay' or key = 'z'"), d.where("value = 'pay'").select("key", "et", F.col("at").alias("n"))

    for how in ("left", "inner"):
        same(spark, rows, joins.as_of_join(*sides(df), "key", "et", "et", how, 20).withColumns({c: F.col(c).cast("double") for c in ("at", "right_n")}),
             lambda d: batch.as_of_join(*sides(d), "key", "et", "et", how).withColumns({c: F.col(c).cast("double") for c in ("at", "right_n")}))


def test_session_join_of_streams(feed):
    """A late row merges two open sessions, whose rows then meet."""
    left = feed([("a", "l1", 1), ("b", "l2", 2)], [("a", "l40", 40)], [("z", "", 9000)])
    right = feed([("a", "r14", 14), ("a", "r2", 2)], [("a", "r8", 8), ("c", "r9", 9)], [("z", "", 9000)])
    out = drain(joins.session_window_join(left, right, "key", "et", "10 seconds", "60 seconds"))
    got = sorted((r.value, r.right_value, sec(r.window_start)) for r in out.where("key <> 'z'").collect())
    assert got == [("l1", "r14", 1), ("l1", "r2", 1), ("l1", "r8", 1)]


def test_session_join_equals_batch(spark, shuffled):
    from tidemark.operators import joins as batch
    rows, df = shuffled

    def sides(d):
        return (d.where(f"value = '{v}' or key = 'z'").select("key", "et", F.col("at").cast("double").alias("at")) for v in ("create", "pay"))

    same(spark, rows, joins.session_window_join(*sides(df), "key", "et", "12 seconds", "20 seconds").drop("window_start", "window_end"),
         lambda d: batch.session_window_join(*sides(d), "key", "et", 12).drop("session"))


def test_sessions(feed):
    df = feed([("a", "", 1), ("a", "", 5)], [("a", "", 30)], [("z", "", 500)])
    out = drain(windows.session_counts(df, "key", "et", "10 seconds"))
    assert sorted((r.key, sec(r.window_start), r.n) for r in out.collect()) == [("a", 1, 2), ("a", 30, 1)]


LEFT = [("a", "l", 1), ("a", "l", 2), ("b", "l", 3), ("c", "l", 4)]
RIGHT = [("a", "r", 1), ("a", "r", 11), ("b", "r", 2), ("b", "r", 12), ("c", "r", 14), ("d", "r", 15)]
CLOSE = [("y", "", 9000)]
MEET = [("a", 1, 1), ("a", 2, 1), ("b", 3, 2)]


def pairs(df):
    return sorted((r.key, r.at, r.right_at) for r in df.collect() if r.key != "y")


def test_window_and_interval_join(feed):
    for join in (lambda l, r: joins.window_join(l, r, "key", "et", "10 seconds"),
                 lambda l, r: joins.interval_join(l, r, "key", "et", -2, 2)):
        assert pairs(drain(join(feed(LEFT, CLOSE), feed(RIGHT, CLOSE)))) == MEET


def test_interval_join_drops_state(feed, spark, tmp_path):
    late = [("a", "l", 5000)]
    joined = joins.interval_join(feed(LEFT, late, CLOSE), feed(RIGHT, late, CLOSE), "key", "et", -2, 2)
    query = batched_sink(joined, str(tmp_path / "o"), str(tmp_path / "c"), available_now=True)
    query.awaitTermination()
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 8


@pytest.mark.parametrize("how,extra", [
    ("left", [("c", 4, None)]), ("right", [("a", None, 11), ("b", None, 12), ("c", None, 14), ("d", None, 15)]),
    ("full", [("c", 4, None), ("a", None, 11), ("b", None, 12), ("c", None, 14), ("d", None, 15)])])
def test_outer_join(feed, how, extra):
    out = drain(joins.outer_join(feed(LEFT, CLOSE), feed(RIGHT, CLOSE), "key", "et", -2, 2, how))
    got = sorted(((r.key, r.at, r.right_at) for r in out.collect() if r.key != "y"), key=repr)
    assert got == sorted(MEET + extra, key=repr)


def test_interval_join_late(feed):
    left = feed([("a", "l", 1)], [("a", "l", 50)], [("a", "l", 2), ("a", "l", 51)], CLOSE)
    right = feed([("a", "r", 2)], [("a", "r", 60)], [("a", "r", 49), ("a", "r", 3)], CLOSE)
    out = drain(joins.interval_join_late(left, right, "key", "et", -2, 2, delay=3))
    got = sorted((r.kind, r.left and r.left.at, r.right and r.right.at) for r in out.collect()
                 if (r.left or r.right).key == "a")
    assert got == [("left_late", 2, None), ("match", 1, 2), ("match", 50, 49), ("match", 51, 49),
                   ("right_late", None, 3)]


GOLDEN = {
    "inner": ("L1001 R1002 L1002 R1001", ["+I 1002 10:01:02 100", "+I 1001 10:00:00 80"]),
    "left": ("L1001 R1002 L1002 R1001", ["+I 1001 10:00:00 None", "+I 1002 10:01:02 100",
                                         "-D 1001 10:00:00 None", "+I 1001 10:00:00 80"]),
    "right": ("R1001 L1002 R1002 L1001", ["+I 1001 None 80", "+I 1002 10:01:02 100",
                                          "-D 1001 None 80", "+I 1001 10:00:00 80"]),
    "full": ("R1001 L1002 L1001 R1002", [
        "+I 1001 None 80", "+I 1002 10:01:02 None", "-D 1001 None 80", "+I 1001 10:00:00 80",
        "-D 1002 10:01:02 None", "+I 1002 10:01:02 100"]),
}


@pytest.mark.parametrize("how", GOLDEN)
@pytest.mark.parametrize("one_batch, shards", [(True, 1), (False, 1), (False, 3)])
def test_changelog(feed, how, one_batch, shards):
    values = {"L1001": "10:00:00", "L1002": "10:01:02", "R1001": "80", "R1002": "100"}
    arrivals, want = GOLDEN[how]
    sides = {"L": [], "R": []}
    for i, name in enumerate(arrivals.split()):
        for side in "LR":
            rows = [(name[1:], values[name], i)] if name[0] == side else []
            sides[side].append(rows)
    if one_batch:
        sides = {s: [[r for b in batches for r in b]] for s, batches in sides.items()}
    left, right = (feed(*sides[s]).drop("et") for s in "LR")
    log = drain(joins.changelog_join(left, right, "key", "at", how, shards)).collect()
    got = [f"{r.op} {r.key} {r.left and r.left.value} {r.right and r.right.value}"
           for r in sorted(log, key=lambda r: (r.at, r.step))]
    assert got == want


@pytest.mark.parametrize("how", ["left", "full"])
def test_changelog_of_a_hot_key(feed, spark, how):
    """The same log as of the tables, in cells that hold a share of each side."""
    import random
    rnd = random.Random(9)
    rows = [("hot" if i % 3 else f"k{rnd.randint(0, 9)}", f"{rnd.choice('LR')}{i}", float(i)) for i in range(240)]
    rows = [r for r in rows if r[0] != "hot" or r[1][0] == "L" or r[2] > 90]  # the hot key's left rows wait at first
    left, right = ([r for r in rows if r[1][0] == s] for s in "LR")
    fed = [feed(*[[r for r in side if n * 80 <= r[2] < n * 80 + 80] for n in range(3)]).drop("et") for side in (left, right)]
    log = drain(joins.changelog_join(*fed, "key", "at", how, 3))
    name = lambda side: F.col(f"{side}.value")
    got = sorted(map(tuple, log.select("op", "at", "step", "key", name("left"), name("right")).collect()), key=repr)
    sides = [spark.createDataFrame(side, "key string, value string, at double") for side in (left, right)]
    want = _batch_log(sides, how)
    assert got == want
    cells = joins._in_cells(joins.side_by_side(*sides, "key").withColumn("seq", F.lit(0)), "key", 3).where("key = 'hot' and not mark")
    assert cells.groupBy("i", "j").count().count() == 9


def _batch_log(sides, how):
    from tidemark.operators.joins import outer_join_changelog
    named = [side.withColumnRenamed("at", "n") for side in sides]
    log = outer_join_changelog(*named, "key", "n", how).select("op", "at", "step", "key", "value", "right_value")
    return sorted(map(tuple, log.collect()), key=repr)


def test_union_and_connect(feed, spark):
    a, b, c = (feed([(k, v, 0) for k, v in zip("xyz", vs)]) for vs in ("123", "223", "223"))
    out = drain(streams.union_streams(a, b, c, schema="value int"))
    assert sorted(r.value for r in out.collect()) == [1, 2, 2, 2, 2, 2, 3, 3, 3]
    mapped = drain(streams.connect_map(
        a, b, [F.concat(F.lit("number "), "value").alias("s")], [F.concat(F.lit("key "), "key").alias("s")]))
    assert sorted(r.s for r in mapped.collect()) == ["key x", "key y", "key z", "number 1", "number 2", "number 3"]


def test_event_stream(spark, tmp_path):
    (tmp_path / "a.txt").write_text("u1 10\nu2 20\n")
    df = streams.event_stream(spark, str(tmp_path), "user string, ts long", "ts", separator=" ")
    assert sorted((r.user, r.et.timestamp()) for r in drain(df).collect()) == [("u1", 10.0), ("u2", 20.0)]


def test_batched_sink_replay_is_idempotent(feed, spark, tmp_path):
    path = str(tmp_path / "out")
    df = feed([("a", "1", 1)], [("a", "2", 2)])
    for checkpoint in ("c1", "c2"):  # a lost checkpoint replays every batch, beside what is there
        batched_sink(df, path, str(tmp_path / checkpoint), available_now=True).awaitTermination()
    written = spark.read.parquet(path)
    assert sorted((r.key, r.value) for r in written.collect()) == [("a", "1"), ("a", "1"), ("a", "2"), ("a", "2")]
    assert read_final(written, ["key", "value"], ["batch_id"]).count() == 2


@pytest.fixture
def shuffled(feed):
    """Random events in five files, out of order by less than 20 seconds, then a closing row."""
    import random
    rnd = random.Random(4)
    kinds = ["create", "pay", "other"]
    rows = [(f"k{rnd.randint(0, 5)}", rnd.choice(kinds), at) for at in rnd.sample(range(1000), 300)]
    arrivals = sorted(rows, key=lambda r: r[2] + rnd.uniform(0, 19))
    return rows, feed(*[arrivals[i:i + 60] for i in range(0, 300, 60)], [("z", "pay", 99000)])


def same(spark, rows, stream, batch):
    data = spark.createDataFrame(rows, "key string, value string, at int").withColumn(
        "et", F.timestamp_seconds(F.col("at") + BASE))
    got, want = (sorted(map(tuple, df.where("key != 'z'").collect()), key=repr)
                 for df in (drain(stream), batch(data)))
    assert got == want and got


def test_streamed_patterns_equal_batch(spark, shuffled):
    from tidemark.operators import patterns as batch
    rows, df = shuffled
    create, pay = F.col("value") == "create", F.col("value") == "pay"
    wait = "20 seconds"
    for times, cell in ((3, 86_400), (3, 40), (2, 7), (4, 30), (1, 40)):
        same(spark, rows, patterns.consecutive_match(df, "key", "et", pay, times, wait, cell),
             lambda d: batch.consecutive_match(d, "key", "et", pay, times))
    for how in ("drop", "timeout"):
        for cell in (None, 15, 40):
            same(spark, rows, patterns.sequence_within(df, "key", "et", create, pay, 15, how, wait, cell),
                 lambda d: batch.sequence_within(d, "key", "et", create, pay, 15, how))
    for cell in (None, 15, 40):
        same(spark, rows, patterns.order_timeout(df, "key", "et", create, pay, 15, wait, cell),
             lambda d: batch.order_timeout(d, "key", "et", create, pay, 15))


def test_hot_key_patterns_are_spread(spark, feed):
    """A key with all rows is many groups, and patterns across their borders are found."""
    rows = [("hot", "pay", t) for t in range(0, 4000, 10)]
    df = feed(rows[:150], rows[150:], [("z", "other", 99000)])
    out = drain(patterns.consecutive_match(df, "key", "et", F.col("value") == "pay", 3, cell=100)).collect()
    assert sorted(sec(r.match_times[0]) for r in out) == [float(t) for t in range(0, 3980, 10)]
    grouped = patterns._by_key(df, "key", "et", "0 seconds", F.lit(1), 100, 15)
    cells = [r for r in drain(grouped.select("cell", "flag", "at")).collect() if r["at"] < (BASE + 5000) * 1_000_000]
    assert len({r.cell for r in cells}) == 41 and sum(r.flag > 3 for r in cells) == 2 * 39 + 2


def test_streamed_windows_equal_batch(spark, shuffled):
    from tidemark.operators import windows as batch
    rows, df = shuffled
    same(spark, rows, windows.hot_items(df, "key", "et", "1 minute", "20 seconds", 2, "20 seconds"),
         lambda d: batch.hot_items(d, "key", "et", "1 minute", "20 seconds", 2))
    same(spark, rows, windows.window_uv_exact(df, "value", "et", "1 minute", "20 seconds").withColumn("key", F.lit("")).where(
        F.col("window_start") < F.timestamp_seconds(F.lit(BASE + 2000))),
         lambda d: batch.window_uv_exact(d, "value", "et", "1 minute").withColumn("key", F.lit("")))


def test_table_stream_reads_folders_and_files(spark, tmp_path):
    spark.range(10).repartition(3).write.parquet(str(tmp_path / "t.parquet"))
    assert drain(streams.table_stream(spark, str(tmp_path), "t", "id long")).count() == 10
    one = next((tmp_path / "t.parquet").glob("*.parquet"))
    (tmp_path / "u.parquet").write_bytes(one.read_bytes())
    assert 0 < drain(streams.table_stream(spark, str(tmp_path), "u", "id long")).count() < 10


def _state_rows(stream, tmp_path):
    """Entries that the first stateful operator of a stream holds after its last micro-batch with rows."""
    query = batched_sink(stream, str(tmp_path / "o"), str(tmp_path / "c"), available_now=True)
    query.awaitTermination()
    return max(p["stateOperators"][-1]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"])


MANY = [(f"k{i}", "fail" if i % 2 else "ok", i % 5) for i in range(1500)]


def test_interval_join_late_keys_share_groups(feed, tmp_path):
    rows = feed(MANY)
    assert 0 < _state_rows(joins.interval_join_late(rows, rows, "key", "et", -10, 10, 5), tmp_path) < 300


def test_changelog_keys_share_groups(feed, tmp_path):
    rows = feed(MANY).drop("et")
    assert 0 < _state_rows(joins.changelog_join(rows, rows, "key", "at", "full", 1, buckets=4), tmp_path) < 300


def test_as_of_keys_share_groups(feed, tmp_path):
    rows = feed(MANY)
    assert 0 < _state_rows(joins.as_of_join(rows, rows, "key", "et", "et", delay=5, buckets=4), tmp_path) < 300


def test_runs_keys_share_groups(feed, tmp_path):
    runs = patterns.consecutive_match(feed(MANY), "key", "et", F.col("value") == "fail", buckets=4)
    assert 0 < _state_rows(runs, tmp_path) < 300


def test_sequence_keys_share_groups(feed, tmp_path):
    found = patterns.sequence_within(feed(MANY), "key", "et", F.col("value") == "ok", F.col("value") == "fail", 5, buckets=4)
    assert 0 < _state_rows(found, tmp_path) < 300


def test_as_of_versions_over_many_batches(feed):
    """Versions in more chunks than a page keeps apart, late ones and replaced ones among them."""
    n = 20
    left = feed(*[[("a", f"r{i}", 10 * i + 5), ("b", f"s{i}", 10 * i)] for i in range(n)], [("z", "", 9000)])
    right = feed(*[[("a", f"v{i}", 10 * i), ("a", f"w{i}", max(10 * i - 8, 0)), ("b", f"u{i}", 1)] for i in range(n)], [("z", "", 9000)])
    for delay in (0, 25):
        got = drain(joins.as_of_join(left, right, "key", "et", "et", delay=delay, buckets=1)).where("key = 'a'").collect()
        # w, 8 seconds before the next v, is the newest at r if it comes before r is answered
        assert sorted((r.value, r.right_value) for r in got) == sorted(
            (f"r{i}", f"w{i + 1}" if i + 1 < n else f"v{i}") for i in range(n))


def test_pattern_keys_of_any_type(feed):
    """Keys that Python would not tell apart, or not find again, as they are: NaN, times to the microsecond, bytes."""
    rows = [(k, "fail", i) for i in range(3) for k in ("NaN", "1.5", None)]
    df = feed(rows[:4], rows[4:], [("9", "ok", 500)])
    number = F.col("key").cast("double")
    for key in (number, F.timestamp_micros((F.when(F.isnan(number), 7).otherwise(number * 2)).cast("long")), F.encode("key", "utf-8")):
        out = drain(patterns.consecutive_match(df.withColumn("k", key), "k", "et", F.col("value") == "fail"))
        assert out.schema["k"].dataType == df.select(key.alias("k")).schema["k"].dataType
        assert [[sec(t) for t in r.match_times] for r in out.collect()] == [[0, 1, 2]] * 3
        assert len({str(r.k) for r in out.collect()}) == 3
