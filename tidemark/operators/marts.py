"""Daily report marts. ``day`` is the statistics date; every result carries it as ``dt``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.dates import Day, iso
from tidemark.functions.periods import PERIODS, count_in_periods, recent_days, unpivot_periods
from tidemark.functions.timeline import ROWS_PER_SLICE, Timeline, following, row_number
from tidemark.operators.summaries import visitor_days, visitors_in_periods


def _on(day: Day, dt: str = "dt") -> Column:
    return F.col(dt) == F.lit(iso(day))


def _stamped(df: DataFrame, day: Day) -> DataFrame:
    return df.select(F.lit(iso(day)).alias("dt"), *[c for c in df.columns if c != "dt"])


def channel_traffic(sessions: DataFrame, day: Day, periods: Sequence[int] = PERIODS) -> DataFrame:
    """Visitors, visit length, pages, sessions and bounce rate per period and channel.

    ``sessions``: mid_id, channel, during_time_1d (ms), page_count_1d, dt; one row per session.
    The distinct count runs as a partial aggregate on (period, channel, visitor), so a channel
    holding most of the traffic is spread over its visitors.
    """
    one_page = F.sum(F.when(F.col("page_count_1d") == 1, 1).otherwise(0))
    result = (
        recent_days(sessions, day, periods)
        .groupBy("recent_days", "channel")
        .agg(
            F.countDistinct("mid_id").alias("uv_count"),
            (F.avg("during_time_1d") / 1000).alias("avg_duration_sec"),
            F.avg("page_count_1d").alias("avg_page_count"),
            F.count(F.lit(1)).alias("sv_count"),
            (one_page / F.count(F.lit(1))).alias("bounce_rate"),
        )
    )
    return _stamped(result, day)


def channel_days(sessions: DataFrame) -> DataFrame:
    """What ``channel_traffic_of_days`` needs of each day, to be published by ``dt``. ``sessions`` as for
    ``channel_traffic``, with numbers for mid_id."""
    return visitor_days(sessions, ["channel"], "mid_id", {
        "sv_count": F.count(F.lit(1)), "one_page": F.count_if(F.col("page_count_1d") == 1),
        "pages": F.sum("page_count_1d"), "paged": F.count("page_count_1d"),
        "time": F.sum("during_time_1d"), "timed": F.count("during_time_1d")})


def channel_traffic_of_days(days: DataFrame, day: Day, periods: Sequence[int] = PERIODS) -> DataFrame:
    """``channel_traffic`` from the published ``channel_days``: a day is added by reading that day's sessions, and the
    report reads the bitmaps and sums of its longest period."""
    sums = ["sv_count", "one_page", "pages", "paged", "time", "timed"]
    n = visitors_in_periods(days, ["channel"], sums, day, periods)
    return _stamped(n.select(
        "recent_days", "channel", "uv_count", (F.try_divide("time", "timed") / 1000).alias("avg_duration_sec"),
        F.try_divide("pages", "paged").alias("avg_page_count"), "sv_count", (F.col("one_page") / F.col("sv_count")).alias("bounce_rate")), day)


def page_path(views: DataFrame, day: Day, periods: Sequence[int] = PERIODS,
              rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Page-to-page steps per period, counted. ``views``: session_id, page_id, view_time, dt.

    Step numbers keep the graph free of cycles; the last page of a session leads to ``null``
    written as text.
    """
    longest = views.where(F.col("dt").between(F.lit(iso(day, 1 - max(periods))), F.lit(iso(day))))
    steps = (  # a session has no more rows in any period than in the longest, where they are counted without copies
        Timeline(recent_days(views, day, periods), ["session_id", "recent_days"], ["view_time"],
                 rows_per_slice, counted=longest.select("session_id"))
        .running(_step=row_number(), _next=following(F.struct("page_id")))
        .rows
    )
    source = F.concat(F.lit("step-"), F.col("_step"), F.lit(":"), F.col("page_id"))
    target = F.concat(F.lit("step-"), F.col("_step") + 1, F.lit(":"), F.col("_next.page_id"))
    result = (
        steps.groupBy("recent_days", source.alias("source"),
                      F.coalesce(target, F.lit("null")).alias("target"))
        .agg(F.count(F.lit(1)).alias("path_count"))
    )
    return _stamped(result, day)


def user_change(login_td: DataFrame, day: Day) -> DataFrame:
    """Users lost today (last login exactly seven days ago) and users back today after at least
    seven idle days. ``login_td``: user_id, login_date_last, dt; one row per user and day."""
    today = login_td.where(_on(day)).select("user_id", "login_date_last")
    before = login_td.where(_on(iso(day, -1))).select(
        "user_id", F.col("login_date_last").alias("login_date_previous"))
    churned = today.where(_on(iso(day, -7), "login_date_last"))
    # a returning user logged in today, so only those rows need the join
    away = F.datediff(F.col("login_date_last"), F.col("login_date_previous")) >= 8
    back = today.where(_on(day, "login_date_last")).join(before, "user_id").where(away)

    def counted(users: DataFrame, churn: int) -> DataFrame:
        one = F.count(F.lit(1))
        return users.agg((one * churn).alias("user_churn_count"),
                         (one * (1 - churn)).alias("user_back_count"))

    both = counted(churned, 1).unionByName(counted(back, 0))
    return _stamped(both.agg(*[F.sum(c).alias(c) for c in both.columns]), day)


def retention(register: DataFrame, login_td: DataFrame, day: Day, days: int = 7) -> DataFrame:
    """Per registration day in the ``days`` before ``day``: how many of the new users were
    active on ``day``. ``register``: user_id, date_id, dt."""
    new = register.where(
        F.col("dt").between(F.lit(iso(day, -days)), F.lit(iso(day, -1)))
    ).select("user_id", F.col("date_id").alias("create_date"))
    last = login_td.where(_on(day)).select("user_id", "login_date_last")
    kept = F.sum(F.when(_on(day, "login_date_last"), 1).otherwise(0))
    result = (
        new.join(last, "user_id")
        .groupBy("create_date")
        .agg(kept.alias("retention_count"), F.count(F.lit(1)).alias("new_user_count"))
        .select(
            "create_date",
            F.datediff(F.lit(iso(day)), F.col("create_date")).alias("retention_day"),
            "retention_count", "new_user_count",
            (F.col("retention_count") / F.col("new_user_count") * 100).alias("retention_rate"),
        )
    )
    return _stamped(result, day)


def user_stats(register: DataFrame, login_td: DataFrame, day: Day,
               periods: Sequence[int] = PERIODS) -> DataFrame:
    """New users (registered in the period) and active users (last login in the period)."""
    span = F.col("dt").between(F.lit(iso(day, 1 - max(periods))), F.lit(iso(day)))
    new = count_in_periods(register.where(span), "date_id", day, "new_user_count", periods)
    active = count_in_periods(login_td.where(_on(day)), "login_date_last", day,
                              "active_user_count", periods)
    return _stamped(new.join(active, "recent_days"), day)


def funnel(page_1d: DataFrame, page_nd: DataFrame, cart_1d: DataFrame, cart_nd: DataFrame,
           order_1d: DataFrame, order_nd: DataFrame, payment_1d: DataFrame,
           payment_nd: DataFrame, day: Day, home: str = "home",
           detail: str = "good_detail") -> DataFrame:
    """Users per period at home page, detail page, cart, order and payment.

    Page tables: one row per visitor and page (view_count_7d, view_count_30d in the n-day one);
    the others one row per user (cart_add_count_*, order_count_*, payment_count_*). A period
    without rows shows zeros. Each stage is a tiny aggregate; they meet in one union instead of
    a chain of joins.
    """
    pages = F.col("page_id").isin(home, detail)
    page_stage = F.when(F.col("page_id") == home, F.lit("home_count")).otherwise(
        F.lit("good_detail_count"))
    stages = [
        _stage(page_1d.where(pages), page_nd.where(pages), "view_count", page_stage, day),
        _stage(cart_1d, cart_nd, "cart_add_count", F.lit("cart_count"), day),
        _stage(order_1d, order_nd, "order_count", F.lit("order_count"), day),
        _stage(payment_1d, payment_nd, "payment_count", F.lit("payment_count"), day),
    ]
    reached = stages[0]
    for stage in stages[1:]:
        reached = reached.unionByName(stage)
    names = ["home_count", "good_detail_count", "cart_count", "order_count", "payment_count"]
    counts = reached.groupBy("recent_days").agg(*[
        F.sum(F.when(F.col("stage") == n, F.col("users")).otherwise(0)).alias(n) for n in names])
    spark = page_1d.sparkSession
    periods = spark.range(1).select(F.explode(F.array(*map(F.lit, PERIODS))).alias("recent_days"))
    return _stamped(periods.join(counts, "recent_days", "left").na.fill(0, names), day)


def _stage(one_day: DataFrame, n_day: DataFrame, measure: str, stage: Column,
           day: Day) -> DataFrame:
    stage = stage.alias("stage")
    long = unpivot_periods(n_day.where(_on(day)), [stage],
                           {"n": {7: f"{measure}_7d", 30: f"{measure}_30d"}})
    users = F.count(F.lit(1)).alias("users")
    return (
        one_day.where(_on(day)).groupBy(stage).agg(users)
        .select(F.lit(1).alias("recent_days"), "stage", "users")
        .unionByName(long.where(F.col("n") > 0).groupBy("recent_days", "stage").agg(users))
    )


def repurchase(user_sku_nd: DataFrame, day: Day) -> DataFrame:
    """Share of a brand's buyers who ordered it at least twice, per period.

    ``user_sku_nd``: user_id, tm_id, tm_name, order_count_7d, order_count_30d, dt. Both periods
    are summed per (user, brand) in one shuffle and unpivoted after it.
    """
    per_user = (
        user_sku_nd.where(_on(day))
        .groupBy("user_id", "tm_id", "tm_name")
        .agg(F.sum("order_count_7d").alias("n7"), F.sum("order_count_30d").alias("n30"))
    )
    long = unpivot_periods(per_user, ["tm_id", "tm_name"], {"n": {7: "n7", 30: "n30"}})
    result = long.groupBy("recent_days", "tm_id", "tm_name").agg(
        F.try_divide(F.count(F.when(F.col("n") >= 2, 1)), F.count(F.when(F.col("n") >= 1, 1)))
        .alias("order_repeat_rate"))
    return _stamped(result, day)


CATEGORIES = ("category1_id", "category2_id", "category3_id")


def cart_top_k(cart: DataFrame, sku: DataFrame, day: Day, k: int = 3,
               categories: Sequence[str] = CATEGORIES) -> DataFrame:
    """The ``k`` SKUs with most items in carts per category; ties share a rank.

    ``cart``: sku_id, sku_num, dt; ``sku``: id, names and categories, dt. Carts are summed
    before the join, and the rank filter is applied map-side, so a category holding most SKUs
    sends only its best ones. The SKU table may be large and is not forced to broadcast.
    """
    in_carts = cart.where(_on(day)).groupBy("sku_id").agg(F.sum("sku_num").alias("cart_num"))
    described = sku.where(_on(day)).drop("dt")
    ranked = Window.partitionBy(*categories).orderBy(F.desc("cart_num"))
    result = (
        in_carts.join(described, F.col("sku_id") == F.col("id"), "left").drop("id")
        .withColumn("rk", F.rank().over(ranked))
        .where(F.col("rk") <= k)
    )
    return _stamped(result, day)


PROVINCE = ("province_id", "province_name", "area_code", "iso_code", "iso_3166_2")


def province_orders(p1d: DataFrame, pnd: DataFrame, day: Day,
                    province: Sequence[str] = PROVINCE) -> DataFrame:
    """Orders and amount per period and province."""
    one = p1d.where(_on(day)).select(
        *province, F.lit(1).alias("recent_days"),
        F.col("order_count_1d").alias("order_count"),
        F.col("order_total_amount_1d").alias("order_total_amount"))
    more = unpivot_periods(pnd.where(_on(day)), province, {
        "order_count": {7: "order_count_7d", 30: "order_count_30d"},
        "order_total_amount": {7: "order_total_amount_7d", 30: "order_total_amount_30d"}})
    return _stamped(one.unionByName(more), day)
