"""Joins over the test tables. Left rows are views, right rows purchases, unless named."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import joins, windows
from tidemark.operators.warehouse import latest_per_key
from tidemark.plans import inputs
from tidemark.plans.inputs import kind, sql_text, table, text
from tidemark.plans.registry import query
from tidemark.plans.warehouse import customer_zip

FAR_DAY = "2100-01-01"

_L = "l AS (SELECT event_id, user_id, ts, value FROM events WHERE event_type = 'view')"
_R = "r AS (SELECT event_id, user_id, ts, value FROM events WHERE event_type = 'purchase')"


def _sides(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    rows = inputs.events(spark, folder)
    columns = ["event_id", "user_id", "ts", "value"]
    return kind(rows, "view").select(columns), kind(rows, "purchase").select(columns)


def _pairs(df: DataFrame) -> DataFrame:
    return df.select("user_id", "event_id", "right_event_id")


@query("""
SELECT o_orderkey, o_custkey, l_partkey, l_linenumber, l_quantity
FROM orders JOIN lineitem ON o_orderkey = l_orderkey""")
def inner_join(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_partkey", "l_linenumber", "l_quantity")
    return joins.regular_join(orders, lines, ["o_orderkey"])


def _user_days(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    rows = inputs.events(spark, folder)

    def days(event_type: str, name: str) -> DataFrame:
        return kind(rows, event_type).groupBy("user_id", inputs.day_of("ts").alias("dt")).agg(
            F.count(F.lit(1)).alias(name))

    return days("view", "views"), days("purchase", "purchases")


_OUTER = """
WITH v AS (SELECT user_id, strftime(ts, '%Y-%m-%d') AS dt, count(*) AS views FROM events
           WHERE event_type = 'view' GROUP BY ALL),
p AS (SELECT user_id, strftime(ts, '%Y-%m-%d') AS dt, count(*) AS purchases FROM events
      WHERE event_type = 'purchase' GROUP BY ALL)
SELECT user_id, dt, views, purchases FROM v {how} JOIN p USING (user_id, dt)"""


@query(_OUTER.format(how="LEFT"))
def left_join(spark: SparkSession, folder: str) -> DataFrame:
    return joins.regular_join(*_user_days(spark, folder), ["user_id", "dt"], "left")


@query(_OUTER.format(how="RIGHT"))
def right_join(spark: SparkSession, folder: str) -> DataFrame:
    return joins.regular_join(*_user_days(spark, folder), ["user_id", "dt"], "right")


@query(_OUTER.format(how="FULL"))
def full_join(spark: SparkSession, folder: str) -> DataFrame:
    return joins.regular_join(*_user_days(spark, folder), ["user_id", "dt"], "full")


@query(f"""
WITH {_L}, {_R}
SELECT l.user_id, l.event_id, r.event_id AS right_event_id
FROM l JOIN r ON l.user_id = r.user_id AND date_trunc('hour', l.ts) = date_trunc('hour', r.ts)""")
def window_join(spark: SparkSession, folder: str) -> DataFrame:
    return _pairs(joins.window_join(*_sides(spark, folder), "user_id", "ts", "1 hour"))


@query(f"""
WITH {_L}, {_R},
lw AS (SELECT l.*, time_bucket(INTERVAL 30 MINUTE, ts) - INTERVAL 30 MINUTE * k AS w FROM l, (SELECT unnest([0, 1]) AS k)),
rw AS (SELECT r.*, time_bucket(INTERVAL 30 MINUTE, ts) - INTERVAL 30 MINUTE * k AS w FROM r, (SELECT unnest([0, 1]) AS k))
SELECT lw.user_id, lw.event_id, rw.event_id AS right_event_id, {sql_text('lw.w')} AS window_start
FROM lw JOIN rw ON lw.user_id = rw.user_id AND lw.w = rw.w""")
def sliding_window_join(spark: SparkSession, folder: str) -> DataFrame:
    found = joins.window_join(*_sides(spark, folder), "user_id", "ts", "1 hour", "30 minutes")
    return found.select("user_id", "event_id", "right_event_id",
                        text("window.start").alias("window_start"))


@query(f"""
WITH {_L}, {_R},
both_sides AS (SELECT 'l' AS side, * FROM l UNION ALL SELECT 'r', * FROM r),
lagged AS (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS prev FROM both_sides),
numbered AS (SELECT *, sum(CASE WHEN ts - prev > INTERVAL 30 MINUTE THEN 1 ELSE 0 END)
                       OVER (PARTITION BY user_id ORDER BY ts) AS session FROM lagged)
SELECT a.user_id, a.event_id, b.event_id AS right_event_id
FROM numbered a JOIN numbered b ON a.user_id = b.user_id AND a.session = b.session AND a.side = 'l' AND b.side = 'r'""")
def session_window_join(spark: SparkSession, folder: str) -> DataFrame:
    return _pairs(joins.session_window_join(*_sides(spark, folder), "user_id", "ts", 1800))


@query(f"""
WITH {_L}, {_R}
SELECT l.user_id, l.event_id, r.event_id AS right_event_id
FROM l JOIN r ON l.user_id = r.user_id
 AND r.ts BETWEEN l.ts - INTERVAL 20 MINUTE AND l.ts + INTERVAL 10 MINUTE""")
def interval_join(spark: SparkSession, folder: str) -> DataFrame:
    return _pairs(joins.interval_join(*_sides(spark, folder), "user_id", "ts", -1200, 600))


@query(f"""
WITH arrived AS (SELECT *, ts + to_seconds(CAST(round(value * 60) AS BIGINT)) AS arrival FROM events
                 WHERE event_type IN ('view', 'purchase')),
clocked AS (SELECT *,
  max(CASE WHEN event_type = 'view' THEN ts END) OVER before AS l_clock,
  max(CASE WHEN event_type = 'purchase' THEN ts END) OVER before AS r_clock
  FROM arrived WINDOW before AS (ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
tagged AS (SELECT *, coalesce(CASE WHEN l_clock IS NULL OR r_clock IS NULL THEN NULL ELSE
                              ts < least(l_clock, r_clock) - INTERVAL 600 SECOND END, FALSE) AS late FROM clocked)
SELECT 'match' AS kind, l.event_id, r.event_id AS right_event_id
FROM tagged l JOIN tagged r ON l.user_id = r.user_id AND NOT l.late AND NOT r.late
 AND l.event_type = 'view' AND r.event_type = 'purchase'
 AND r.ts BETWEEN l.ts - INTERVAL 20 MINUTE AND l.ts + INTERVAL 20 MINUTE
UNION ALL SELECT 'left_late', event_id, NULL FROM tagged WHERE late AND event_type = 'view'
UNION ALL SELECT 'right_late', NULL, event_id FROM tagged WHERE late AND event_type = 'purchase'""")
def interval_join_late(spark: SparkSession, folder: str) -> DataFrame:
    """Rows arrive ``value`` minutes after their event time."""
    arrival = F.col("ts") + F.make_dt_interval(secs=F.round(F.col("value") * 60))
    left, right = (df.withColumn("arrival", arrival) for df in _sides(spark, folder))
    out = windows.interval_join_late(left, right, "user_id", "ts", "arrival", -1200, 1200, 600)
    none = F.lit(None).cast("long")
    return (
        out["matches"].select(F.lit("match").alias("kind"), "event_id", "right_event_id")
        .unionByName(out["left_late"].select(
            F.lit("left_late").alias("kind"), "event_id", none.alias("right_event_id")))
        .unionByName(out["right_late"].select(
            F.lit("right_late").alias("kind"), none.alias("event_id"),
            F.col("event_id").alias("right_event_id")))
    )


_ARRIVALS = """
WITH l AS (SELECT o_orderkey AS order_id, o_orderstatus AS status,
                  date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) * 10 AS seq FROM orders),
r AS (SELECT l_orderkey AS order_id, l_linenumber AS line, l_partkey AS part,
             date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) * 10 + l_linenumber AS seq FROM lineitem),
lf AS (SELECT order_id, min(seq) AS first FROM l GROUP BY order_id),
rf AS (SELECT order_id, min(seq) AS first FROM r GROUP BY order_id),
lp AS (SELECT l.*, first FROM l LEFT JOIN rf USING (order_id) WHERE first IS NULL OR first > seq),
rp AS (SELECT r.*, first FROM r LEFT JOIN lf USING (order_id) WHERE first IS NULL OR first > seq)
SELECT '+I' AS op, greatest(l.seq, r.seq) AS at, order_id, status, line, part FROM l JOIN r USING (order_id)"""
_LEFT_LOG = """
UNION ALL SELECT '+I', seq, order_id, status, NULL, NULL FROM lp
UNION ALL SELECT '-D', first, order_id, status, NULL, NULL FROM lp WHERE first IS NOT NULL"""
_RIGHT_LOG = """
UNION ALL SELECT '+I', seq, order_id, NULL, line, part FROM rp
UNION ALL SELECT '-D', first, order_id, NULL, line, part FROM rp WHERE first IS NOT NULL"""


def _changelog(spark: SparkSession, folder: str, how: str) -> DataFrame:
    """Orders and their shipped lines arriving by date."""
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderstatus").alias("status"),
        (F.unix_date(F.to_date("o_orderdate")).cast("long") * 10).alias("seq"))
    lines = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("part"),
        (F.unix_date(F.to_date("l_shipdate")).cast("long") * 10 + F.col("l_linenumber")).alias("seq"))
    log = joins.outer_join_changelog(orders, lines, "order_id", "seq", how)
    return log.select("op", "at", "order_id", "status", F.col("right_line").alias("line"),
                      F.col("right_part").alias("part"))


for _how, _more in (("inner", ""), ("left", _LEFT_LOG), ("right", _RIGHT_LOG),
                    ("full", _LEFT_LOG + _RIGHT_LOG)):
    query(_ARRIVALS + _more, name=f"{_how}_join_changelog")(
        lambda spark, folder, how=_how: _changelog(spark, folder, how))


_AS_OF = f"""
WITH {_L}, {_R}
SELECT r.event_id, r.user_id, l.event_id AS view_id
FROM r ASOF LEFT JOIN l ON r.user_id = l.user_id AND r.ts >= l.ts"""


@query(_AS_OF)
def as_of_join(spark: SparkSession, folder: str) -> DataFrame:
    """Each purchase with the user's last view before it."""
    seen, bought = _sides(spark, folder)
    return joins.as_of_join(bought, seen, "user_id", "ts", "ts").select(
        "event_id", "user_id", F.col("right_event_id").alias("view_id"))


@query(_AS_OF)
def as_of_join_hot_users(spark: SparkSession, folder: str) -> DataFrame:
    """As ``as_of_join``, with every user cut into slices."""
    seen, bought = _sides(spark, folder)
    return joins.as_of_join(bought, seen, "user_id", "ts", "ts", rows_per_slice=10).select(
        "event_id", "user_id", F.col("right_event_id").alias("view_id"))


@query(f"""
WITH {inputs.VERSIONS.format(before=FAR_DAY)}
SELECT o_orderkey, o_custkey AS id, create_time, start_date
FROM orders JOIN zip ON o_custkey = id AND strftime(o_orderdate, '%Y-%m-%d') BETWEEN start_date AND end_date""")
def history_join(spark: SparkSession, folder: str) -> DataFrame:
    """Each order with the version of its customer valid that day."""
    orders = table(spark, folder, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("id"), "o_orderdate")
    found = joins.history_join(orders, customer_zip(spark, folder, FAR_DAY), "id", "o_orderdate")
    return found.select("o_orderkey", "id", F.col("right_create_time").alias("create_time"),
                        F.col("right_start_date").alias("start_date"))


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, p_brand, p_retailprice
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey""")
def lookup_join(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    part = table(spark, folder, "part").select(
        F.col("p_partkey").alias("l_partkey"), "p_brand", "p_retailprice")
    return joins.lookup_join(lines, part, ["l_partkey"])


@query("""
SELECT c_custkey, n_name, c_acctbal FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def broadcast_join(spark: SparkSession, folder: str) -> DataFrame:
    nation = joins.small_side(table(spark, folder, "nation"))
    customer = table(spark, folder, "customer")
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", "n_name", "c_acctbal")


@query("SELECT p_partkey, word FROM part, LATERAL (SELECT unnest(string_split(p_name, ' ')) AS word)")
def table_function_join(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part").select("p_partkey", "p_name")
    words = spark.tvf.explode(F.split(F.col("p_name").outer(), " "))
    return joins.table_function_join(part, words).select("p_partkey", F.col("col").alias("word"))


@query("""
SELECT c_custkey, c_name, n_name, o_orderkey FROM customer
LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
             ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1) ON c_custkey = o_custkey
JOIN nation ON c_nationkey = n_nationkey""")
def equi_joins(spark: SparkSession, folder: str) -> DataFrame:
    newest = latest_per_key(
        table(spark, folder, "orders").select("o_custkey", "o_orderkey", "o_orderdate"),
        ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return (
        table(spark, folder, "customer")
        .join(newest, F.col("c_custkey") == F.col("o_custkey"), "left")
        .join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", "c_name", "n_name", "o_orderkey")
    )
