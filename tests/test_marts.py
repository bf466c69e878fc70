import pytest
from pyspark.sql import functions as F

from tidemark.functions.periods import recent_days, unpivot_periods
from tidemark.operators import marts, summaries
from tidemark.sources.tables import overwrite_partitions, publish, read_current, read_days

DAY = "2020-06-14"


def test_recent_days(spark, rows):
    df = spark.createDataFrame([(DAY,), ("2020-06-08",), ("2020-06-07",), ("2020-05-16",), ("2020-05-15",),
                                ("2020-06-15",)], "dt string")
    assert rows(recent_days(df, DAY)) == sorted(
        [(DAY, n) for n in (1, 7, 30)] + [("2020-06-08", 7), ("2020-06-08", 30), ("2020-06-07", 30),
                                          ("2020-05-16", 30)], key=repr)


def test_channel_traffic(spark, rows):
    sessions = spark.createDataFrame([
        ("m1", "c", "s1", 12000, 3, DAY), ("m2", "c", "s2", 21000, 1, DAY), ("m2", "c", "s3", 30000, 2, DAY)],
        "mid_id string, channel string, session_id string, during_time_1d long, page_count_1d long, dt string")
    got = rows(marts.channel_traffic(sessions, DAY))
    assert got == [(DAY, n, "c", 2, 21.0, 2.0, 3, pytest.approx(1 / 3)) for n in (1, 30, 7)]


@pytest.mark.parametrize("limit", [1, 10**6])
def test_page_path(spark, rows, limit):
    views = spark.createDataFrame([
        ("s", "home", 1, DAY), ("s", "list", 2, DAY), ("s", "home", 3, DAY), ("t", "home", 9, "2020-06-10")],
        "session_id string, page_id string, view_time long, dt string")
    got = [r[1:] for r in rows(marts.page_path(views, DAY, rows_per_slice=limit)) if r[1] in (1, 7)]
    assert sorted(got, key=repr) == sorted([
        (1, "step-1:home", "step-2:list", 1), (1, "step-2:list", "step-3:home", 1), (1, "step-3:home", "null", 1),
        (7, "step-1:home", "step-2:list", 1), (7, "step-2:list", "step-3:home", 1), (7, "step-3:home", "null", 1),
        (7, "step-1:home", "null", 1)], key=repr)


TD = "user_id int, login_date_last string, login_count_td long, dt string"


def test_user_change(spark, rows):
    td = spark.createDataFrame([
        (1, "2020-06-07", 1, DAY), (1, "2020-06-07", 1, "2020-06-13"),      # lost today
        (2, DAY, 2, DAY), (2, "2020-06-06", 1, "2020-06-13"),               # back after 7 idle days
        (3, DAY, 2, DAY), (3, "2020-06-07", 1, "2020-06-13"),               # 6 idle days only
        (4, DAY, 1, DAY), (5, "2020-06-06", 1, DAY), (5, "2020-06-06", 1, "2020-06-13")], TD)
    assert rows(marts.user_change(td, DAY)) == [(DAY, 1, 1)]


def test_retention_80_percent(spark, rows):
    register = spark.createDataFrame([(u, "2020-06-13", "2020-06-13") for u in range(100)] + [(500, DAY, DAY)],
                                     "user_id int, date_id string, dt string")
    td = spark.createDataFrame([(u, DAY if u < 80 else "2020-06-13", 1, DAY) for u in range(100)], TD)
    assert rows(marts.retention(register, td, DAY)) == [(DAY, "2020-06-13", 1, 80, 100, 80.0)]


def test_user_stats(spark, rows):
    register = spark.createDataFrame([(1, DAY, DAY), (2, "2020-06-10", "2020-06-10")],
                                     "user_id int, date_id string, dt string")
    td = spark.createDataFrame([(1, DAY, 1, DAY), (2, "2020-06-12", 1, DAY), (3, "2020-05-20", 1, DAY),
                                (4, "2020-01-01", 1, DAY), (9, DAY, 1, "2020-06-13")], TD)
    assert rows(marts.user_stats(register, td, DAY)) == [(DAY, 1, 1, 1), (DAY, 30, 2, 3), (DAY, 7, 2, 2)]


def test_funnel_keeps_empty_periods(spark, rows):
    page_1d = spark.createDataFrame([("m", "home", DAY)], "mid string, page_id string, dt string")
    page_nd = spark.createDataFrame([("m", "home", 1, 2, DAY), ("k", "home", 0, 1, DAY), ("m", "good_detail", 0, 3, DAY),
                                     ("m", "other", 5, 5, DAY)],
                                    "mid string, page_id string, view_count_7d long, view_count_30d long, dt string")

    def stage(measure, data):
        one = spark.createDataFrame([(u, DAY) for u in data[0]], "user_id int, dt string")
        nd = spark.createDataFrame([(*r, DAY) for r in data[1]],
                                   f"user_id int, {measure}_7d long, {measure}_30d long, dt string")
        return one, nd

    got = rows(marts.funnel(page_1d, page_nd, *stage("cart_add_count", ([1], [(1, 1, 1), (2, 0, 4)])),
                            *stage("order_count", ([], [(2, 0, 1)])), *stage("payment_count", ([], [])), DAY))
    assert got == [(DAY, 1, 1, 0, 1, 0, 0), (DAY, 30, 2, 1, 2, 1, 0), (DAY, 7, 1, 0, 1, 0, 0)]


def test_repurchase_without_buyers(spark, rows):
    nd = spark.createDataFrame([(1, "s1", "t", "T", 1, 1, DAY), (1, "s2", "t", "T", 1, 1, DAY), (2, "s1", "t", "T", 1, 3, DAY),
                                (3, "s9", "v", "V", 0, 1, DAY)],
                               "user_id int, sku string, tm_id string, tm_name string, order_count_7d long,"
                               " order_count_30d long, dt string")
    assert rows(marts.repurchase(nd, DAY)) == sorted([
        (DAY, 7, "t", "T", 0.5), (DAY, 30, "t", "T", 1.0), (DAY, 7, "v", "V", None), (DAY, 30, "v", "V", 0.0)], key=repr)


def test_cart_top_k(spark):
    cart = spark.createDataFrame([("A", 10, DAY), ("A", 12, DAY), ("B", 22, DAY), ("C", 5, DAY), ("D", 4, DAY), ("E", 3, DAY),
                                  ("X", 1, DAY), ("A", 99, "2020-06-13")], "sku_id string, sku_num long, dt string")
    sku = spark.createDataFrame([(s, s.lower(), 1, 2, 3, DAY) for s in "ABCDE"],
                                "id string, sku_name string, category1_id int, category2_id int, category3_id int, dt string")
    got = marts.cart_top_k(cart, sku, DAY)
    assert sorted((r.sku_id, r.cart_num, r.rk) for r in got.collect()) == [
        ("A", 22, 1), ("B", 22, 1), ("C", 5, 3), ("X", 1, 1)]
    assert "WindowGroupLimit" in got._jdf.queryExecution().optimizedPlan().toString()


def test_province_orders(spark, rows):
    p = "province_id int, province_name string, area_code string, iso_code string, iso_3166_2 string, "
    one = spark.createDataFrame([(1, "p", "a", "i", "j", 2, 5.0, DAY)],
                                p + "order_count_1d long, order_total_amount_1d double, dt string")
    nd = spark.createDataFrame([(1, "p", "a", "i", "j", 3, 9, 6.0, 8.0, DAY)],
                               p + "order_count_7d long, order_count_30d long, order_total_amount_7d double,"
                               " order_total_amount_30d double, dt string")
    got = [(r.recent_days, r.order_count, r.order_total_amount) for r in marts.province_orders(one, nd, DAY).collect()]
    assert sorted(got) == [(1, 2, 5.0), (7, 3, 6.0), (30, 9, 8.0)]


def test_advance_td_equals_rebuild(spark, rows):
    logins = spark.createDataFrame([(1, "2020-06-01"), (1, "2020-06-14"), (2, "2020-06-13"), (3, "2020-06-14"), (4, "2020-06-20")],
                                   "user_id int, dt string")
    before = summaries.build_td(logins, "2020-06-13")
    assert rows(summaries.advance_td(before, logins, DAY)) == rows(summaries.build_td(logins, DAY)) == [
        (1, DAY, 2, DAY), (2, "2020-06-13", 1, DAY), (3, DAY, 1, DAY)]


def test_unpivot(spark, rows):
    df = spark.createDataFrame([("a", 1, 2)], "k string, x_7d int, x_30d int")
    assert rows(unpivot_periods(df, ["k"], {"x": {7: "x_7d", 30: "x_30d"}})) == [("a", 30, 2), ("a", 7, 1)]


def test_publish_is_idempotent(spark, tmp_path, rows):
    path = str(tmp_path / "mart")
    for day, n in (("2020-06-13", 1), (DAY, 2), (DAY, 2), (DAY, 3)):
        publish(spark.createDataFrame([(n,)], "n int"), path, day)
    assert rows(read_current(spark, path).select("n", "dt")) == [(1, "2020-06-13"), (3, DAY)]
    one = read_days(spark, path, DAY, DAY)
    assert rows(one) == [(3, DAY)]
    assert len(one.inputFiles()) == 1 and f"dt={DAY}/" in one.inputFiles()[0]  # other days are not even listed


def test_read_days_of_a_plain_table(spark, tmp_path, rows):
    path = str(tmp_path / "plain")
    for day, n in (("2020-06-13", 1), (DAY, 2), (DAY, 3)):
        overwrite_partitions(spark.createDataFrame([(n, day)], "n int, dt string"), path, "dt")
    one = read_days(spark, path, DAY, DAY)
    assert rows(one) == [(3, DAY)]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "2020-06-14" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]


def test_period_filter_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "views")
    for day in (DAY, "2020-01-01"):
        overwrite_partitions(spark.createDataFrame([(1, day)], "n int, dt string"), path, "dt")
    df = recent_days(spark.read.parquet(path), DAY)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "2020-05-16" in plan.split("PartitionFilters")[1].split("PushedFilters")[0] or "18398" in plan


def test_visitor_days_equal_distinct_counts(spark, rows):
    """Bitmaps of days give the distinct visitors of any period, also for null, negative and far numbers."""
    import random
    rnd = random.Random(5)
    data = [(rnd.choice([None, -5, 10**12, rnd.randint(0, 70_000), 7]), rnd.choice("ab"), rnd.choice([None, rnd.randint(0, 9000)]),
             rnd.randint(1, 3), f"2020-06-{rnd.randint(1, 14):02d}") for _ in range(600)]
    df = spark.createDataFrame(data, "mid_id long, channel string, during_time_1d long, page_count_1d long, dt string")
    periods = (1, 3, 7, 12)
    want = marts.channel_traffic(df, DAY, periods)
    got = marts.channel_traffic_of_days(marts.channel_days(df), DAY, periods)
    names = want.columns
    rounded = lambda d: rows(d.select(*names).withColumns({c: F.round(c, 9) for c in ("avg_duration_sec", "avg_page_count", "bounce_rate")}))
    assert rounded(got) == rounded(want)
