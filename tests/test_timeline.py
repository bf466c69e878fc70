"""Cutting a key into slices must not change any running column."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions import timeline as tl


@pytest.fixture(scope="module")
def data(spark):
    rnd = random.Random(7)
    out = []
    for i in range(900):
        key = "hot" if i % 3 == 0 else (None if i % 3 == 1 else f"k{i % 40}")
        # bursts: many rows close together, long quiet stretches
        at = rnd.choice([rnd.randint(0, 20), rnd.randint(0, 100_000)]) * 1000 + i
        out.append((key, at, rnd.choice([None, rnd.randint(0, 9)]), i))
    return spark.createDataFrame(out, "k string, at long, v int, id int").cache()


@pytest.mark.parametrize("limit", [5, 60, 10**6])
@pytest.mark.parametrize("keys", [["k"], []])
def test_slices_equal_plain_windows(data, limit, keys):
    w = Window.partitionBy(*keys).orderBy("at")
    line = tl.Timeline(data, keys, ["at"], limit)
    got = (
        line.running(
            s=tl.running_sum(F.col("v")), rn=tl.row_number(), mb=tl.max_before(F.col("v")),
            p=tl.previous(F.struct("v")), f=tl.following(F.struct("v")), l=tl.latest(F.col("v")))
        .running(r=tl.recent(F.col("id"), 3))
        .rows.select("id", "s", "rn", "mb", "p", "f", "l", "r")
    )
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    want = data.select(
        "id", F.sum("v").over(w).alias("s"), F.row_number().over(w).alias("rn"),
        F.max("v").over(before).alias("mb"), F.lag(F.struct("v")).over(w).alias("p"),
        F.lead(F.struct("v")).over(w).alias("f"),
        F.last("v", True).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("l"),
        F.collect_list("id").over(w.rowsBetween(-3, -1)).alias("r"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_hot_key_is_spread(data):
    line = tl.Timeline(data, ["k"], ["at"], 60)
    sizes = line._df.groupBy("k", tl.SLICE).count().where("k = 'hot' or k is null").collect()
    assert len({(r.k, r[tl.SLICE]) for r in sizes}) > 8
    assert line._df.where("k like 'k%'").where(F.col(tl.SLICE).isNotNull()).count() == 0


def test_wall_clock_order(spark):
    df = spark.sql("select timestamp_ntz'2024-03-10 00:00:00' + make_dt_interval(0, 0, 0, id * 97) at,"
                   " id from range(300)")
    got = tl.Timeline(df, [], ["at"], 10).running(n=tl.row_number()).rows
    assert got.where(F.col("n") != F.col("id") + 1).count() == 0


def test_no_hot_key_leaves_one_plain_window(data):
    df = tl.Timeline(data, ["k"], ["at"], 10**6).running(n=tl.row_number()).rows
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "isFinalPlan=true" in final
    assert "BroadcastHashJoin" not in final


def test_slices_are_of_equal_size(spark):
    """A burst in one second, and one far-off time at each end."""
    limit = 1000
    df = spark.range(30_000).selectExpr(
        "case when id = 0 then -2208988800L when id = 1 then 4070908800L when id < 20000 then 1700000000L * 1 + id / 20000 "
        "else 1700000000L + id end at", "'k' k", "id").selectExpr("cast(at as double) at", "k", "id")
    for keys in (["k"], []):
        line = tl.Timeline(df, keys, ["at"], limit)
        sizes = [r["count"] for r in line._df.groupBy(tl.SLICE).count().collect()]
        assert sum(sizes) == 30_000 and max(sizes) < 2 * limit
