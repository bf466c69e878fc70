"""The daily marts over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import iso
from tidemark.functions.periods import recent_days as copy_per_period
from tidemark.functions.periods import unpivot_periods as to_long
from tidemark.operators import marts, summaries
from tidemark.plans import inputs
from tidemark.plans.inputs import EARLY_DAY, EVENTS_DAY, LAST_DAY, MIDDLE_DAY, table
from tidemark.plans.registry import query
from tidemark.session import scratch_path, written
from tidemark.sources.tables import publish as publish_mart
from tidemark.sources.tables import read_days, swap_table

PERIOD_ROWS = "(SELECT unnest([1, 7, 30]) AS recent_days)"


def _from(day: str, n: str = "recent_days") -> str:
    """First day of the period of ``n`` days, as SQL text."""
    return f"strftime(DATE '{day}' - CAST({n} - 1 AS INTEGER), '%Y-%m-%d')"


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


@query(f"""
SELECT recent_days, event_type, count(*) AS n, min(strftime(ts, '%Y-%m-%d')) AS first_day
FROM events CROSS JOIN {PERIOD_ROWS}
WHERE strftime(ts, '%Y-%m-%d') BETWEEN {_from(EVENTS_DAY)} AND '{EVENTS_DAY}'
GROUP BY recent_days, event_type""")
def recent_days(spark: SparkSession, folder: str) -> DataFrame:
    dated = inputs.events(spark, folder).withColumn("dt", inputs.day_of("ts"))
    return copy_per_period(dated, EVENTS_DAY).groupBy("recent_days", "event_type").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.to_date("dt")).cast("string").alias("first_day"))


_TRAFFIC = f"""
WITH {inputs.SESSIONS}
SELECT '{EVENTS_DAY}' AS dt, recent_days, channel, count(DISTINCT mid_id) AS uv_count,
       round(avg(during_time_1d) / 1000, 6) AS avg_duration_sec, round(avg(page_count_1d), 6) AS avg_page_count,
       count(*) AS sv_count,
       round(sum(CASE WHEN page_count_1d = 1 THEN 1.0::DOUBLE ELSE 0 END) / count(*), 6) AS bounce_rate
FROM sessions CROSS JOIN {PERIOD_ROWS}
WHERE dt BETWEEN {_from(EVENTS_DAY)} AND '{EVENTS_DAY}'
GROUP BY recent_days, channel"""


@query(_TRAFFIC)
def channel_traffic(spark: SparkSession, folder: str) -> DataFrame:
    result = marts.channel_traffic(inputs.sessions(spark, folder), EVENTS_DAY)
    return _rounded(result, "avg_duration_sec", "avg_page_count", "bounce_rate")


@query(_TRAFFIC)
def channel_traffic_of_days(spark: SparkSession, folder: str) -> DataFrame:
    """The same from a published summary: the days before are loaded at once, the last one from its own sessions."""
    path = scratch_path(spark, "channel_days")
    seen = written(inputs.sessions(spark, folder), "sessions")
    before, last = F.col("dt") < EVENTS_DAY, F.col("dt") == EVENTS_DAY
    swap_table(marts.channel_days(seen.where(before)), path, "dt")
    publish_mart(marts.channel_days(seen.where(last)).drop("dt"), path, EVENTS_DAY)
    result = marts.channel_traffic_of_days(read_days(spark, path, iso(EVENTS_DAY, -29), EVENTS_DAY), EVENTS_DAY)
    return _rounded(result, "avg_duration_sec", "avg_page_count", "bounce_rate")


@query(f"""
WITH {inputs.VIEWS},
steps AS (SELECT recent_days, page_id,
                 lead(page_id) OVER (PARTITION BY session_id, recent_days ORDER BY view_time) AS next_page,
                 row_number() OVER (PARTITION BY session_id, recent_days ORDER BY view_time) AS rn
          FROM views CROSS JOIN {PERIOD_ROWS}
          WHERE dt BETWEEN {_from(EVENTS_DAY)} AND '{EVENTS_DAY}')
SELECT '{EVENTS_DAY}' AS dt, recent_days, 'step-' || rn || ':' || page_id AS source,
       coalesce('step-' || (rn + 1) || ':' || next_page, 'null') AS target, count(*) AS path_count
FROM steps GROUP BY ALL""")
def page_path(spark: SparkSession, folder: str) -> DataFrame:
    # stands for a stored table: written once, not derived again for each pass over it
    return marts.page_path(written(inputs.views(spark, folder), "views"), EVENTS_DAY)


def _td(day: str) -> str:
    return f"""(SELECT user_id, max(dt) AS login_date_last, count(*) AS login_count_td
                FROM logins WHERE dt <= '{day}' GROUP BY user_id)"""


@query(f"""
WITH {inputs.LOGINS}
SELECT '{MIDDLE_DAY}' AS dt,
       (SELECT count(*) FROM {_td(MIDDLE_DAY)} WHERE login_date_last = '{iso(MIDDLE_DAY, -7)}') AS user_churn_count,
       (SELECT count(*) FROM {_td(MIDDLE_DAY)} t JOIN {_td(iso(MIDDLE_DAY, -1))} p USING (user_id)
        WHERE date_diff('day', CAST(p.login_date_last AS DATE), CAST(t.login_date_last AS DATE)) >= 8
       ) AS user_back_count""")
def user_change(spark: SparkSession, folder: str) -> DataFrame:
    logins = inputs.logins(spark, folder)
    # yesterday's partition is a stored table: the history is read once
    before = written(summaries.build_td(logins, iso(MIDDLE_DAY, -1)), "login_td")
    today = summaries.advance_td(before, logins, MIDDLE_DAY)
    return marts.user_change(before.unionByName(today), MIDDLE_DAY)


@query(f"""
WITH {inputs.REGISTER}
SELECT '{EARLY_DAY}' AS dt, date_id AS create_date,
       date_diff('day', CAST(date_id AS DATE), DATE '{EARLY_DAY}') AS retention_day,
       CAST(sum(CASE WHEN login_date_last = '{EARLY_DAY}' THEN 1 ELSE 0 END) AS BIGINT) AS retention_count,
       count(*) AS new_user_count,
       round(sum(CASE WHEN login_date_last = '{EARLY_DAY}' THEN 1.0::DOUBLE ELSE 0 END) / count(*) * 100, 6)
         AS retention_rate
FROM register JOIN {_td(EARLY_DAY)} USING (user_id)
WHERE date_id >= '{iso(EARLY_DAY, -7)}' AND date_id < '{EARLY_DAY}'
GROUP BY date_id""")
def retention(spark: SparkSession, folder: str) -> DataFrame:
    td = summaries.build_td(inputs.logins(spark, folder), EARLY_DAY)
    return _rounded(marts.retention(inputs.register(spark, folder), td, EARLY_DAY),
                    "retention_rate")


@query(f"""
WITH {inputs.REGISTER}
SELECT '{EARLY_DAY}' AS dt, recent_days,
       (SELECT count(*) FROM register WHERE date_id BETWEEN {_from(EARLY_DAY)} AND '{EARLY_DAY}') AS new_user_count,
       (SELECT count(*) FROM {_td(EARLY_DAY)} WHERE login_date_last >= {_from(EARLY_DAY)}) AS active_user_count
FROM {PERIOD_ROWS}""")
def user_stats(spark: SparkSession, folder: str) -> DataFrame:
    td = summaries.build_td(inputs.logins(spark, folder), EARLY_DAY)
    return marts.user_stats(inputs.register(spark, folder), td, EARLY_DAY)


def _published_day(day: str) -> str:
    return f"""SELECT {{n}} AS run, '{day}' AS dt, recent_days,
       (SELECT count(*) FROM register WHERE date_id BETWEEN {_from(day)} AND '{day}') AS new_user_count,
       (SELECT count(*) FROM {_td(day)} WHERE login_date_last >= {_from(day)}) AS active_user_count
FROM {PERIOD_ROWS}"""


@query(f"""WITH {inputs.REGISTER}
{_published_day(iso(EARLY_DAY, -1)).format(n=1)} UNION ALL {_published_day(EARLY_DAY).format(n=3)}""")
def publish(spark: SparkSession, folder: str) -> DataFrame:
    """Two days of a mart loaded, the second one twice; the rerun replaces only its own day."""
    path = scratch_path(spark, "user_stats")
    register = inputs.register(spark, folder)
    for run, day in enumerate((iso(EARLY_DAY, -1), EARLY_DAY, EARLY_DAY), 1):
        td = summaries.build_td(inputs.logins(spark, folder), day)
        mart = marts.user_stats(register, td, day).withColumn("run", F.lit(run))
        publish_mart(mart, path, day)
    return read_days(spark, path, iso(EARLY_DAY, -1), EARLY_DAY)


@query(f"""WITH {inputs.REGISTER}
{_published_day(iso(EARLY_DAY, -1)).format(n=1)}""")
def publish_empty_day(spark: SparkSession, folder: str) -> DataFrame:
    """Two days of a mart loaded, and the second run again with no rows: it is empty afterwards, the first is not."""
    path = scratch_path(spark, "user_stats")
    register = inputs.register(spark, folder)
    for run, day in enumerate((iso(EARLY_DAY, -1), EARLY_DAY, EARLY_DAY), 1):
        td = summaries.build_td(inputs.logins(spark, folder), day)
        mart = marts.user_stats(register, td, day).withColumn("run", F.lit(run))
        publish_mart(mart.where("run < 3"), path, day)
    return read_days(spark, path, iso(EARLY_DAY, -1), EARLY_DAY)


def _reached(page: str) -> str:
    return f"""(SELECT count(DISTINCT user_id) FROM events WHERE event_type = '{page}'
                AND strftime(ts, '%Y-%m-%d') BETWEEN {_from(EVENTS_DAY)} AND '{EVENTS_DAY}')"""


@query(f"""
SELECT '{EVENTS_DAY}' AS dt, recent_days, {_reached('view')} AS home_count,
       {_reached('click')} AS good_detail_count, {_reached('signup')} AS cart_count,
       {_reached('error')} AS order_count, {_reached('purchase')} AS payment_count
FROM {PERIOD_ROWS}""")
def funnel(spark: SparkSession, folder: str) -> DataFrame:
    # the eight summary tables come from one pass over the events
    days = written(inputs.page_days(spark, folder), "page_days")

    def stage(page: str, measure: str) -> tuple[DataFrame, DataFrame]:
        one = days.where(F.col("page_id") == page).withColumnRenamed("view_count_1d", f"{measure}_1d")
        return one, summaries.build_nd(one, ["user_id"], [f"{measure}_1d"], EVENTS_DAY)

    return marts.funnel(
        days, summaries.build_nd(days, ["user_id", "page_id"], ["view_count_1d"], EVENTS_DAY),
        *stage("signup", "cart_add_count"), *stage("error", "order_count"),
        *stage("purchase", "payment_count"), EVENTS_DAY, home="view", detail="click")


@query(f"""
WITH bought AS (SELECT recent_days, o_custkey, p_brand, count(*) AS n
                FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
                CROSS JOIN (SELECT unnest([7, 30]) AS recent_days)
                WHERE strftime(o_orderdate, '%Y-%m-%d') BETWEEN {_from(LAST_DAY)} AND '{LAST_DAY}'
                GROUP BY ALL),
brands AS (SELECT DISTINCT p_brand FROM bought)
SELECT '{LAST_DAY}' AS dt, p.recent_days, b.p_brand AS tm_id, 'brand ' || b.p_brand AS tm_name,
       round(count(CASE WHEN n >= 2 THEN 1 END)::DOUBLE / nullif(count(CASE WHEN n >= 1 THEN 1 END), 0), 6)
         AS order_repeat_rate
FROM brands b CROSS JOIN (SELECT unnest([7, 30]) AS recent_days) p
LEFT JOIN bought x ON x.p_brand = b.p_brand AND x.recent_days = p.recent_days
GROUP BY p.recent_days, b.p_brand""")
def repurchase(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part")
    recent = inputs.recent_orders(spark, folder, LAST_DAY)
    daily = (
        table(spark, folder, "lineitem")
        .join(recent, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy(F.col("o_custkey").alias("user_id"), "l_partkey", F.col("p_brand").alias("tm_id"),
                 F.concat(F.lit("brand "), F.col("p_brand")).alias("tm_name"),
                 inputs.day_of("o_orderdate").alias("dt"))
        .agg(F.count(F.lit(1)).alias("order_count_1d"))
    )
    nd = summaries.build_nd(daily, ["user_id", "l_partkey", "tm_id", "tm_name"],
                            ["order_count_1d"], LAST_DAY)
    return _rounded(marts.repurchase(nd, LAST_DAY), "order_repeat_rate")


@query(f"""
WITH cart AS (SELECT l_partkey AS sku_id, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS cart_num
              FROM lineitem GROUP BY l_partkey)
SELECT '{LAST_DAY}' AS dt, p_brand AS category1_id, p_type AS category2_id, p_size AS category3_id, sku_id,
       p_name AS sku_name, cart_num, rk
FROM (SELECT *, rank() OVER (PARTITION BY p_brand, p_type, p_size ORDER BY cart_num DESC) AS rk
      FROM cart LEFT JOIN part ON sku_id = p_partkey)
WHERE rk <= 3""")
def cart_top_k(spark: SparkSession, folder: str) -> DataFrame:
    cart = table(spark, folder, "lineitem").select(
        F.col("l_partkey").alias("sku_id"), F.col("l_quantity").cast("long").alias("sku_num"),
        F.lit(LAST_DAY).alias("dt"))
    sku = table(spark, folder, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("sku_name"),
        F.col("p_brand").alias("category1_id"), F.col("p_type").alias("category2_id"),
        F.col("p_size").alias("category3_id"), F.lit(LAST_DAY).alias("dt"))
    return marts.cart_top_k(cart, sku, LAST_DAY)


def _province_days(spark: SparkSession, folder: str) -> DataFrame:
    orders = inputs.recent_orders(spark, folder, LAST_DAY)
    customer = table(spark, folder, "customer")
    nation = table(spark, folder, "nation")
    return (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey", inputs.day_of("o_orderdate").alias("dt"))
        .agg(F.count(F.lit(1)).alias("order_count_1d"),
             F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("order_total_amount_1d"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(F.col("n_nationkey").alias("province_id"), F.col("n_name").alias("province_name"),
                F.col("n_regionkey").alias("area_code"), "dt", "order_count_1d",
                "order_total_amount_1d")
    )


@query(f"""
WITH sold AS (SELECT n_nationkey AS province_id, n_name AS province_name, n_regionkey AS area_code,
                     strftime(o_orderdate, '%Y-%m-%d') AS dt, CAST(o_totalprice AS DECIMAL(18, 2)) AS price
              FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
              WHERE o_orderdate BETWEEN DATE '{LAST_DAY}' - 29 AND DATE '{LAST_DAY}')
SELECT '{LAST_DAY}' AS dt, recent_days, province_id, province_name, area_code,
       count(CASE WHEN dt >= {_from(LAST_DAY)} THEN 1 END) AS order_count,
       CAST(sum(CASE WHEN dt >= {_from(LAST_DAY)} THEN price ELSE 0 END) AS DOUBLE) AS order_total_amount
FROM sold CROSS JOIN {PERIOD_ROWS}
GROUP BY recent_days, province_id, province_name, area_code
HAVING recent_days > 1 OR count(CASE WHEN dt >= {_from(LAST_DAY)} THEN 1 END) > 0""")
def province_orders(spark: SparkSession, folder: str) -> DataFrame:
    days = _province_days(spark, folder)
    keys = ["province_id", "province_name", "area_code"]
    nd = summaries.build_nd(days, keys, ["order_count_1d", "order_total_amount_1d"], LAST_DAY)
    result = marts.province_orders(days, nd, LAST_DAY, keys)
    return result.withColumn("order_total_amount", F.col("order_total_amount").cast("double"))


@query(f"""
SELECT n.recent_days, user_id, event_type,
       CAST(sum(CASE WHEN strftime(ts, '%Y-%m-%d') >= {_from(EVENTS_DAY, 'n.recent_days')}
                     THEN 1 ELSE 0 END) AS BIGINT) AS event_count
FROM events CROSS JOIN (SELECT unnest([7, 30]) AS recent_days) n
WHERE strftime(ts, '%Y-%m-%d') BETWEEN '{iso(EVENTS_DAY, -29)}' AND '{EVENTS_DAY}'
GROUP BY n.recent_days, user_id, event_type""")
def unpivot_periods(spark: SparkSession, folder: str) -> DataFrame:
    days = inputs.page_days(spark, folder)
    nd = summaries.build_nd(days, ["user_id", "page_id"], ["view_count_1d"], EVENTS_DAY)
    return to_long(nd, ["user_id", F.col("page_id").alias("event_type")],
                   {"event_count": {7: "view_count_7d", 30: "view_count_30d"}})


@query(f"""
SELECT o_custkey AS user_id, '{LAST_DAY}' AS dt,
       count(CASE WHEN o_orderdate >= DATE '{LAST_DAY}' - 6 THEN 1 END) AS order_count_7d,
       count(*) AS order_count_30d,
       CAST(sum(CASE WHEN o_orderdate >= DATE '{LAST_DAY}' - 6 THEN CAST(o_totalprice AS DECIMAL(18, 2)) ELSE 0 END)
            AS DOUBLE) AS order_amount_7d,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS order_amount_30d
FROM orders WHERE o_orderdate BETWEEN DATE '{LAST_DAY}' - 29 AND DATE '{LAST_DAY}'
GROUP BY o_custkey""")
def build_nd(spark: SparkSession, folder: str) -> DataFrame:
    daily = (
        inputs.recent_orders(spark, folder, LAST_DAY)
        .groupBy(F.col("o_custkey").alias("user_id"), inputs.day_of("o_orderdate").alias("dt"))
        .agg(F.count(F.lit(1)).alias("order_count_1d"),
             F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("order_amount_1d"))
    )
    nd = summaries.build_nd(daily, ["user_id"], ["order_count_1d", "order_amount_1d"], LAST_DAY)
    return nd.withColumns({c: F.col(c).cast("double") for c in ("order_amount_7d", "order_amount_30d")})


@query(f"""
WITH {inputs.LOGINS}
SELECT user_id, max(dt) AS login_date_last, count(*) AS login_count_td, '{MIDDLE_DAY}' AS dt
FROM logins WHERE dt <= '{MIDDLE_DAY}' GROUP BY user_id""")
def build_td(spark: SparkSession, folder: str) -> DataFrame:
    return summaries.build_td(inputs.logins(spark, folder), MIDDLE_DAY)
