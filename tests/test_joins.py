import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import joins, patterns, windows

LEFT = [("a", 1), ("a", 2), ("b", 3), ("c", 4)]
RIGHT = [("a", 1), ("a", 11), ("b", 2), ("b", 12), ("c", 14), ("d", 15)]


def timed(spark, data):
    return spark.createDataFrame(data, "k string, s long").withColumn("et", F.timestamp_seconds("s"))


def pairs(df):
    return sorted((r.k, r.s, r.right_s) for r in df.collect())


def test_regular_join(spark):
    left = spark.createDataFrame([(1, "a1"), (1, "a2"), (2, "b"), (3, "c")], "id int, l string")
    right = spark.createDataFrame([(1, "aa1", 1), (1, "aa2", 2), (2, "bb", 1), (3, "cc", 1)], "id int, r string, n int")
    assert joins.regular_join(left, right, ["id"]).count() == 6


def test_interval_and_window_join(spark):
    left, right = timed(spark, [("key-1", 10)]), timed(spark, [("key-1", s) for s in (2, 8, 12, 22)])
    assert pairs(joins.interval_join(left, right, "k", "et", -5, 5)) == [("key-1", 10, 8), ("key-1", 10, 12)]
    left = timed(spark, [("key-1", 2), ("key-1", 6), ("key-2", 13)])
    right = timed(spark, [("key-1", 2), ("key-1", 8), ("key-2", 12), ("key-2", 22)])
    assert pairs(joins.window_join(left, right, "k", "et", "5 seconds")) == [
        ("key-1", 2, 2), ("key-1", 6, 8), ("key-2", 13, 12)]
    for found in (joins.window_join(timed(spark, LEFT), timed(spark, RIGHT), "k", "et", "10 seconds"),
                  joins.interval_join(timed(spark, LEFT), timed(spark, RIGHT), "k", "et", -2, 2)):
        assert pairs(found) == [("a", 1, 1), ("a", 2, 1), ("b", 3, 2)]


@pytest.mark.parametrize("lower,upper", [(-7, 3), (0, 0), (5, 9), (-9, -5), (-0.5, 0.5)])
def test_interval_join_brute_force(spark, lower, upper):
    rnd = random.Random(5)
    left, right = ([(rnd.choice("ab"), rnd.randint(0, 200)) for _ in range(80)] for _ in range(2))
    want = sorted((k, s, r) for k, s in left for q, r in right if k == q and s + lower <= r <= s + upper)
    assert pairs(joins.interval_join(timed(spark, left), timed(spark, right), "k", "et", lower, upper)) == want


@pytest.mark.parametrize("limit", [4, 10**6])
def test_session_window_join(spark, limit):
    got = joins.session_window_join(timed(spark, LEFT), timed(spark, RIGHT), "k", "et", 9, limit)
    assert pairs(got) == [("a", 1, 1), ("a", 1, 11), ("a", 2, 1), ("a", 2, 11), ("b", 3, 2), ("b", 3, 12)]


@pytest.mark.parametrize("limit", [4, 10**6])
def test_as_of_join(spark, limit):
    rnd = random.Random(9)
    left, right = ([(rnd.choice(["a", "b", None]), rnd.randint(0, 99)) for _ in range(n)] for n in (60, 25))
    right = list(set(right))
    got = joins.as_of_join(timed(spark, left), timed(spark, right), "k", "et", "et", rows_per_slice=limit)
    want = [(k, s, max((r for q, r in right if q == k is not None and r <= s), default=None)) for k, s in left]
    assert sorted(((r.k, r.s, r.right_s) for r in got.collect()), key=repr) == sorted(want, key=repr)
    inner = joins.as_of_join(timed(spark, left), timed(spark, right), "k", "et", "et", "inner", limit)
    assert inner.count() == sum(w[2] is not None for w in want)


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
def test_changelog(spark, how):
    values = {"L1001": "10:00:00", "L1002": "10:01:02", "R1001": "80", "R1002": "100"}
    arrivals, want = GOLDEN[how]
    numbered = list(enumerate(arrivals.split()))
    left, right = (spark.createDataFrame([(n[1:], values[n], i) for i, n in numbered if n[0] == side],
                                         "order_id string, v string, seq int") for side in "LR")
    log = joins.outer_join_changelog(left, right, "order_id", "seq", how).orderBy("at", "step")
    assert [f"{r.op} {r.order_id} {r.v} {r.right_v}" for r in log.collect()] == want


def replay(arrivals, how):
    """Row-by-row join with withdrawals, as multiset of (op, key, left, right)."""
    kept, out = {"l": {}, "r": {}}, []
    pad = {"l": how in ("left", "full"), "r": how in ("right", "full")}
    for seq, side, key in arrivals:
        other = "r" if side == "l" else "l"
        mine, partners = kept[side].setdefault(key, []), kept[other].get(key, [])
        if key is None:  # equal to nothing
            mine, partners = [], []

        def row(op, a, b):
            out.append((op, key, *((a, b) if side == "l" else (b, a))))
        if pad[other] and not mine:
            for p in partners:
                row("-D", None, p)
        for p in partners:
            row("+I", seq, p)
        if pad[side] and not partners:
            row("+I", seq, None)
        mine.append(seq)
    return sorted(out, key=repr)


@pytest.mark.parametrize("how", GOLDEN)
def test_changelog_brute_force(spark, how):
    rnd = random.Random(1)
    arrivals = [(i, rnd.choice("lr"), rnd.choice([None, *"abcdefgh"])) for i in range(60)]
    left, right = (spark.createDataFrame([(k, i) for i, s, k in arrivals if s == side], "k string, seq int") for side in "lr")
    log = joins.outer_join_changelog(left, right, "k", "seq", how)
    assert sorted(((r.op, r.k, r.seq, r.right_seq) for r in log.collect()), key=repr) == replay(arrivals, how)


def test_small_side_is_checked(spark):
    big, dim = spark.range(1000), spark.range(100)
    plan = lambda n: big.join(joins.small_side(dim, n), "id")._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan(100) and "broadcast" not in plan(99)
    assert "broadcast" not in big.join(
        joins.small_side(dim, 100, 50), "id")._jdf.queryExecution().optimizedPlan().toString()
    assert joins.lookup_join(big, dim.withColumn("x", F.lit(1)), ["id"]).where("x is null").count() == 900


def test_table_function_join(spark, rows):
    df = spark.createDataFrame([("a", "x y"), ("b", None)], "k string, t string")
    words = F.split(F.col("t").outer(), " ")
    assert rows(joins.table_function_join(df, spark.tvf.explode(words)).select("k", "col")) == [("a", "x"), ("a", "y")]
    assert joins.table_function_join(df, spark.tvf.explode_outer(words)).count() == 3


def test_hot_key_is_split_by_adaptive_execution(spark):
    before = {n: spark.conf.get(n, None) for n in (
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "spark.sql.adaptive.skewJoin.skewedPartitionFactor",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        for name, value in zip(before, ("2KB", "1.5", "20KB", "-1")):
            spark.conf.set(name, value)
        left = spark.range(0, 60000, 1, 6).select(
            F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), F.rand(1).alias("x"))
        right = spark.range(0, 60000).select(F.col("id").alias("k"), F.rand(2).alias("y"))
        df = joins.regular_join(left, right, ["k"])
        assert len(df.collect()) == 60000
        assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def events(spark, data):
    return spark.createDataFrame(data, "k string, v string, s long").withColumn("et", F.timestamp_seconds("s"))


@pytest.mark.parametrize("limit", [1, 10**6])
def test_patterns(spark, limit):
    logins = events(spark, [("user-1", "fail", 1), ("user-1", "fail", 2), ("user-2", "success", 3),
                            ("user-1", "fail", 4), ("user-1", "fail", 5)])
    got = patterns.consecutive_match(logins, "k", "et", F.col("v") == "fail", 3, limit).collect()
    assert sorted([t.timestamp() for t in r.match_times] for r in got) == [[1, 2, 4], [2, 4, 5]]
    orders = events(spark, [("order-1", "create", 1), ("order-2", "create", 2), ("order-1", "pay", 3), ("order-3", "create", 20),
                            ("order-3", "other", 21), ("order-4", "create", 40), ("order-4", "pay", 45), ("order-6", "pay", 60)])
    create, pay = F.col("v") == "create", F.col("v") == "pay"
    at = lambda t: t and t.timestamp()
    got = patterns.sequence_within(orders, "k", "et", create, pay, 5, rows_per_slice=limit).collect()
    assert sorted((r.k, r.kind, at(r.first_ts), at(r.second_ts)) for r in got) == [
        ("order-1", "match", 1, 3), ("order-2", "timeout", 2, None), ("order-4", "timeout", 40, None)]
    also = patterns.sequence_within(orders, "k", "et", create, pay, 5, "timeout", limit)
    assert also.where("k = 'order-3' and kind = 'timeout'").count() == 1
    got = patterns.order_timeout(orders, "k", "et", create, pay, 5, limit).collect()
    assert sorted((r.k, r.kind, at(r.at)) for r in got) == [
        ("order-1", "paid", 3), ("order-2", "timeout", 7), ("order-3", "timeout", 25), ("order-4", "paid", 45),
        ("order-6", "paid", 60)]


def test_late_rows_literal(spark):
    arrivals = [1, 2, 12, 3, 4, 16, 5]
    df = spark.createDataFrame([("a", s, i) for i, s in enumerate(arrivals)], "k string, s long, n long")
    df = df.withColumn("et", F.timestamp_seconds("s"))
    for limit in (2, 10**6):
        got = windows.tumbling_count_late(df, "k", "et", ["n"], "10 seconds", 0, 5, limit).collect()
        assert sorted((r.window_start.timestamp(), r.kind, r.at.timestamp() if r.at else 0, r.n) for r in got) == [
            (0, "again", 3, 3), (0, "again", 4, 4), (0, "late", 5, None), (0, "main", 0, 2), (10, "main", 0, 2)]


def test_hot_items_panes_equal_direct_count(spark):
    rnd = random.Random(2)
    df = events(spark, [(rnd.choice("abcdef"), "pv", rnd.randint(0, 20000)) for _ in range(400)])
    got = windows.hot_items(df, "k", "et", n=6).select("window_start", "k", "view_count")
    want = df.groupBy(F.window("et", "1 hour", "5 minutes").start.alias("window_start"), "k").agg(F.count("*").alias("view_count"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
