import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import warehouse as wh
from tidemark.sources import tables
from tidemark.sources.tables import read_current

ZIP = "id string, create_time string, operate_time string, start_date string, end_date string, dt string"
CHANGES = "id string, create_time string, operate_time string, ts long, dt string"


def zip_and_changes(spark):
    history = spark.createDataFrame([
        ("a", "c", "o1", "2020-01-01", "2020-03-01", "2020-03-01"), ("a", "c", "o2", "2020-03-02", wh.OPEN_END, wh.OPEN_END),
        ("b", "c", "o1", "2020-01-01", wh.OPEN_END, wh.OPEN_END)], ZIP)
    changes = spark.createDataFrame([
        ("a", "c", "o3", 1, "2020-06-15"), ("a", "c", "o4", 2, "2020-06-15"), ("n", "c", "o1", 1, "2020-06-15"),
        ("b", "c", "o9", 1, "2020-06-14")], CHANGES)
    return history, changes


OPENED = [("a", "c", "o2", "2020-03-02", "2020-06-14", "2020-06-14"), ("a", "c", "o4", "2020-06-15", wh.OPEN_END, wh.OPEN_END),
          ("b", "c", "o1", "2020-01-01", wh.OPEN_END, wh.OPEN_END), ("n", "c", "o1", "2020-06-15", wh.OPEN_END, wh.OPEN_END)]


def test_scd2_methods_agree(spark, rows):
    history, changes = zip_and_changes(spark)
    assert rows(wh.scd2_apply(history, changes, "2020-06-15")) == OPENED
    old = ("a", "c", "o1", "2020-01-01", "2020-03-01", "2020-03-01")
    assert rows(wh.scd2_rebuild(history, changes, "2020-06-15")) == sorted([old, *OPENED])


def test_scd2_rerun_changes_nothing(spark, rows, tmp_path):
    history, changes = zip_and_changes(spark)
    path = str(tmp_path / "zip")
    wh.scd2_publish(history, path)
    seen = []
    for _ in range(2):
        table = read_current(spark, path)
        wh.scd2_publish(wh.scd2_apply(table, changes, "2020-06-15"), path, "2020-06-15")
        seen.append(rows(read_current(spark, path).select("id", "start_date", "end_date")))
    assert seen[0] == seen[1] and len(seen[0]) == 5


def test_scd2_corrected_rerun_loses_nothing(spark, rows, tmp_path):
    schema = "id int, create_time string, operate_time string, start_date string, end_date string, dt string"
    end = wh.OPEN_END
    start = spark.createDataFrame([(i, "c", "o", "2024-01-01", end, end) for i in (1, 2, 3)], schema)
    path = str(tmp_path / "zip")
    wh.scd2_publish(start, path)
    day = "2024-01-05"

    def run(*changed):
        changes = spark.createDataFrame([(i, "c", o, day, n) for n, (i, o) in enumerate(changed)],
                                        "id int, create_time string, operate_time string, dt string, ts int")
        table = read_current(spark, path)
        whole = rows(wh.scd2_rebuild(table, changes, day))
        wh.scd2_publish(wh.scd2_apply(table, changes, day), path, day)
        got = rows(read_current(spark, path))
        assert got == whole
        return [(r[0], r[2], r[3], r[4]) for r in got]

    run((1, "a"), (2, "b"))
    assert run((1, "a2"), (3, "d")) == [
        (1, "a2", day, end), (1, "o", "2024-01-01", "2024-01-04"), (2, "o", "2024-01-01", end),
        (3, "d", day, end), (3, "o", "2024-01-01", "2024-01-04")]
    assert run() == [(i, "o", "2024-01-01", end) for i in (1, 2, 3)]


class Stop(Exception):
    pass


@pytest.mark.parametrize("step", ["before the load", "in the load", "before the pointer", "in the pointer"])
@pytest.mark.parametrize("kind", ["publish", "rebuild"])
def test_stopped_writes_leave_the_old_table(spark, rows, tmp_path, monkeypatch, step, kind):
    """A writer stopped between any two steps: readers see the old table, a rerun gives the new one."""
    history, changes = zip_and_changes(spark)
    path = str(tmp_path / "zip")
    wh.scd2_publish(history, path)
    before = rows(read_current(spark, path))
    new = rows(wh.scd2_rebuild(history, changes, "2020-06-15"))

    def run():
        stored = read_current(spark, path)
        if kind == "publish":
            wh.scd2_publish(wh.scd2_apply(stored, changes, "2020-06-15"), path, "2020-06-15")
        else:
            tables.swap_table(wh.scd2_rebuild(stored, changes, "2020-06-15"), path, "dt")

    def stopped(*args):
        if step == "in the load":  # some of its files are there
            args[0].limit(1).write.partitionBy("dt").parquet(f"{path}/load=half")
        if step == "in the pointer":
            (tmp_path / "zip" / "_pointer" / "_temporary").mkdir(exist_ok=True)
            (tmp_path / "zip" / "_pointer" / "_temporary" / "part.json").write_text('{"version": 9, "lo')
        raise Stop

    with monkeypatch.context() as m:
        m.setattr(tables, "_load" if "load" in step else "_point", stopped)
        with pytest.raises(Stop):
            run()
    assert rows(read_current(spark, path)) == before
    run()
    assert rows(read_current(spark, path)) == new
    run()
    assert rows(read_current(spark, path)) == new


def test_history_is_not_shuffled(spark, tmp_path):
    """The day's changes are broadcast; the only shuffle is that which makes them one row per id."""
    history, changes = zip_and_changes(spark)
    path = str(tmp_path / "zip")
    wh.scd2_publish(history, path)
    plan = wh.scd2_apply(read_current(spark, path), changes, "2020-06-15")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_max_concurrency(spark, rows):
    df = spark.createDataFrame([("r", 0, 100), ("r", 50, 4000), ("r", 100, 200), ("r", 3700, None), ("q", 5, 6)],
                               "room string, a long, b long")
    df = df.select("room", F.timestamp_seconds("a").alias("a"), F.timestamp_seconds("b").alias("b"))
    # leaving and entering at second 100 net out
    assert rows(wh.max_concurrency(df, "room", "a", "b")) == [("q", 1), ("r", 2)]


@pytest.mark.parametrize("limit", [5, 100, 10**6])
def test_max_concurrency_any_slice(spark, limit):
    rnd = random.Random(3)
    data = [(s := rnd.randint(0, 20000), s + rnd.randint(1, 9000)) for _ in range(300)]
    df = spark.createDataFrame(data, "a long, b long").select(
        F.lit("k").alias("k"), F.timestamp_seconds("a").alias("a"), F.timestamp_seconds("b").alias("b"))
    changes = {}
    for a, b in data:
        changes[a] = changes.get(a, 0) + 1
        changes[b] = changes.get(b, 0) - 1
    level = best = 0
    for at in sorted(changes):
        level += changes[at]
        best = max(best, level)
    assert wh.max_concurrency(df, "k", "a", "b", rows_per_slice=limit).first()["max_user_count"] == best


@pytest.mark.parametrize("limit", [2, 10**6])
def test_sessionize(spark, rows, limit):
    t = 1659950435
    df = spark.createDataFrame([(100, "home", t), (100, "x", t + 59), (100, "x", t + 119), (100, "x", t + 178),
                                (100, "x", t + 5000), (7, "home", t)], "user_id int, page_id string, view_timestamp long")
    got = rows(wh.sessionize(df, "user_id", "view_timestamp", 60, limit).select("view_timestamp", "session_id"))
    assert got == sorted([(t, "100-1"), (t + 59, "100-1"), (t + 119, "100-2"), (t + 178, "100-2"), (t + 5000, "100-3"),
                          (t, "7-1")], key=repr)


def test_longest_streak(spark, rows):
    days = ["2021-12-01 19:00:00", "2021-12-01 20:00:00", "2021-12-03 08:00:00", "2021-12-06 08:00:00", "2021-12-07 08:00:00"]
    df = spark.createDataFrame([(100, d) for d in days] + [(5, days[0])], "user_id int, login_datetime string")
    df = df.withColumn("login_datetime", F.to_timestamp("login_datetime"))
    assert rows(wh.longest_streak(df, "user_id", "login_datetime")) == [(100, 3), (5, 1)]


def test_covered_days(spark, rows):
    df = spark.createDataFrame([
        ("oppo", "2021-06-05", "2021-06-09"),
        ("huawei", "2021-10-01", "2021-10-07"), ("huawei", "2021-10-10", "2021-10-17"), ("huawei", "2021-10-15", "2021-10-17"),
        ("other", "2021-06-05", "2021-06-26"), ("other", "2021-06-09", "2021-06-15"), ("other", "2021-06-17", "2021-06-21")],
        "brand string, start_date string, end_date string")
    assert rows(wh.covered_days(df, "brand", "start_date", "end_date")) == [("huawei", 15), ("oppo", 5), ("other", 22)]


def test_covered_days_brute_force(spark):
    rnd = random.Random(11)
    data = [(rnd.choice("abc"), s := rnd.randint(0, 300), s + rnd.randint(0, 30)) for _ in range(200)]
    df = spark.createDataFrame(data, "k string, s int, e int").select(
        "k", F.date_add(F.lit("2020-01-01").cast("date"), F.col("s")).alias("s"),
        F.date_add(F.lit("2020-01-01").cast("date"), F.col("e")).alias("e"))
    want = {k: len({d for key, s, e in data if key == k for d in range(s, e + 1)}) for k in "abc"}
    assert dict(map(tuple, wh.covered_days(df, "k", "s", "e").collect())) == want


def test_pivot_and_explode(spark, rows):
    scores = spark.createDataFrame([(2, "01", 5), (1, "01", 3), (1, "04", 9)], "stu_id int, course_id string, score int")
    wide = wh.pivot_scores(scores, "stu_id", "course_id", "score", ["01", "02", "03", "04"])
    assert [tuple(r) for r in wide.collect()] == [(1, 3, 0, 0, 9), (2, 5, 0, 0, 0)]
    person = spark.createDataFrame([(1, "zs", ["reading", "coding"]), (2, "ls", ["coding", "running"]),
                                    (3, "ww", ["sleeping"]), (4, "no", []), (5, "nu", None)],
                                   "id int, name string, hobbies array<string>")
    assert rows(wh.explode_list(person, "hobbies", "hobby")) == [
        (1, "zs", "coding"), (1, "zs", "reading"), (2, "ls", "coding"), (2, "ls", "running"), (3, "ww", "sleeping")]


def test_latest_and_final(spark, rows):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, None), ("a", 2, "y"), (None, 1, "n")], "k string, v int, w string")
    newest = wh.latest_per_key(df, ["k"], ["v"])
    assert rows(newest) == rows(df.where("v = 3 or k is null"))
    assert "Window" not in newest._jdf.queryExecution().executedPlan().toString()
    dup = df.unionByName(df)
    assert wh.read_final(dup, ["k"], ["v"], F.col("k") == "a").count() == 1
