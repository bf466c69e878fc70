"""Event-time windows and patterns over the finished events table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.aggregates import Aggregate
from tidemark.functions.aggregates import user_aggregate as aggregate
from tidemark.operators import patterns, windows
from tidemark.plans import inputs
from tidemark.plans.inputs import kind, sql_text, text
from tidemark.plans.registry import query
from tidemark.streaming.streams import connect_map as connect
from tidemark.streaming.streams import union_streams as union_all
from tidemark.streaming.windows import bitmaps_of, missed
from tidemark.streaming.windows import window_uv_filter as window_filter


def _bounds(df: DataFrame) -> DataFrame:
    return df.withColumns({c: text(c) for c in ("window_start", "window_end")})


_LATE = f"""
WITH arrived AS (SELECT *, ts + to_seconds(CAST(round(value * 60) AS BIGINT)) AS arrival,
                        date_trunc('hour', ts) AS ws, date_trunc('hour', ts) + INTERVAL 1 HOUR AS we FROM events),
clocked AS (SELECT *, max(ts) OVER (ORDER BY arrival, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                      - INTERVAL 60 SECOND AS wm FROM arrived),
tagged AS (SELECT *, CASE WHEN wm >= we + INTERVAL 600 SECOND THEN 'late' WHEN wm >= we THEN 'again'
                          ELSE 'main' END AS kind FROM clocked),
main AS (SELECT event_type, ws, we, count(*) AS n FROM tagged WHERE kind = 'main' GROUP BY ALL)
SELECT event_type, {sql_text('ws')} AS window_start, {sql_text('we')} AS window_end, 'main' AS kind,
       NULL AS at, n FROM main
UNION ALL
SELECT t.event_type, {sql_text('t.ws')}, {sql_text('t.we')}, 'again', {sql_text('ts')},
       coalesce(n, 0) + row_number() OVER (PARTITION BY t.event_type, t.ws ORDER BY arrival, event_id)
FROM tagged t LEFT JOIN main m ON t.event_type = m.event_type AND t.ws = m.ws WHERE kind = 'again'
UNION ALL
SELECT event_type, {sql_text('ws')}, {sql_text('we')}, 'late', {sql_text('ts')}, NULL FROM tagged WHERE kind = 'late'"""


def _late(spark: SparkSession, folder: str, **options: int) -> DataFrame:
    arrival = F.col("ts") + F.make_dt_interval(secs=F.round(F.col("value") * 60))
    events = inputs.events(spark, folder).withColumn("arrival", arrival)
    found = windows.tumbling_count_late(events, "event_type", "ts", ["arrival", "event_id"],
                                        "1 hour", delay=60, lateness=600, **options)
    return _bounds(found).withColumn("at", text("at"))


@query(_LATE)
def tumbling_count_late(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly counts of rows arriving ``value`` minutes after their event time."""
    return _late(spark, folder)


@query(_LATE)
def tumbling_count_late_sliced(spark: SparkSession, folder: str) -> DataFrame:
    """As ``tumbling_count_late``, with the arrival order cut into many slices."""
    return _late(spark, folder, rows_per_slice=500)


@query(f"""
WITH shown AS (SELECT user_id, time_bucket(INTERVAL 5 MINUTE, ts) - INTERVAL 5 MINUTE * k AS ws
               FROM events, (SELECT unnest(range(0, 12)) AS k) WHERE event_type = 'view'),
counted AS (SELECT ws, user_id, count(*) AS view_count FROM shown GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY ws ORDER BY view_count DESC, user_id) AS rank FROM counted)
SELECT {sql_text('ws')} AS window_start, {sql_text('ws + INTERVAL 1 HOUR')} AS window_end, user_id, view_count, rank
FROM ranked WHERE rank <= 3""")
def hot_items(spark: SparkSession, folder: str) -> DataFrame:
    return _bounds(windows.hot_items(kind(inputs.events(spark, folder), "view"), "user_id", "ts"))


@query(f"""
WITH counted AS (SELECT event_type, date_trunc('hour', ts) AS ws,
                        row_number() OVER (PARTITION BY event_type, date_trunc('hour', ts) ORDER BY ts) AS n FROM events)
SELECT event_type, {sql_text('ws')} AS window_start, {sql_text('ws + INTERVAL 1 HOUR')} AS window_end,
       'running' AS kind, n FROM counted
UNION ALL
SELECT event_type, {sql_text('ws')}, {sql_text('ws + INTERVAL 1 HOUR')}, 'final', max(n) FROM counted GROUP BY event_type, ws""")
def eager_window(spark: SparkSession, folder: str) -> DataFrame:
    return _bounds(windows.eager_window(inputs.events(spark, folder), "event_type", "ts", "1 hour"))


_UV = f"""
SELECT {sql_text("date_trunc('hour', ts)")} AS window_start,
       {sql_text("date_trunc('hour', ts) + INTERVAL 1 HOUR")} AS window_end, count(DISTINCT user_id) AS uv
FROM events WHERE event_type = 'view' GROUP BY date_trunc('hour', ts)"""


@query(_UV)
def window_uv_exact(spark: SparkSession, folder: str) -> DataFrame:
    return _bounds(windows.window_uv_exact(kind(inputs.events(spark, folder), "view"), "user_id", "ts"))


@query(f"""
SELECT {sql_text("date_trunc('day', ts)")} AS window_start, {sql_text("date_trunc('day', ts) + INTERVAL 1 DAY")} AS window_end,
       count(DISTINCT user_id) AS exact, TRUE AS within_error FROM events WHERE event_type = 'view' GROUP BY ALL""")
def window_uv_approx(spark: SparkSession, folder: str) -> DataFrame:
    """Sketched visitors of a day; a sketch has no exact SQL twin, so each day is compared with its exact
    count and the oracle checks that and the error bound, three standard errors."""
    seen = kind(inputs.events(spark, folder), "view")
    rsd = 0.01
    exact = windows.window_uv_exact(seen, "user_id", "ts", "1 day").withColumnRenamed("uv", "exact")
    both = windows.window_uv_approx(seen, "user_id", "ts", "1 day", rsd).join(exact, ["window_start", "window_end"])
    near = F.abs(F.col("uv") - F.col("exact")) <= F.ceil(F.col("exact") * 3 * rsd)
    return _bounds(both.select("window_start", "window_end", "exact", near.alias("within_error")))


@query(f"""
SELECT {sql_text("date_trunc('day', ts)")} AS window_start, {sql_text("date_trunc('day', ts) + INTERVAL 1 DAY")} AS window_end,
       count(DISTINCT user_id) AS exact, TRUE AS never_above, TRUE AS within_bound
FROM events WHERE event_type = 'view' GROUP BY ALL""")
def window_uv_filter(spark: SparkSession, folder: str) -> DataFrame:
    """A filter of 20,000 visitors and an error of 0.001 for each day, compared with its exact count."""
    seen = kind(inputs.events(spark, folder), "view")
    exact = windows.window_uv_exact(seen, "user_id", "ts", "1 day").withColumnRenamed("uv", "exact")
    both = window_filter(seen, "user_id", "ts", "1 day").join(exact, ["window_start", "window_end"])
    short = missed(F.col("exact"), bitmaps_of(20_000, 0.001))
    return _bounds(both.select(
        "window_start", "window_end", "exact", (F.col("uv") <= F.col("exact")).alias("never_above"),
        (F.col("exact") - F.col("uv") <= short + 5 * F.sqrt(short) + 1).alias("within_bound")))


_THREE = f"""
WITH seq AS (SELECT user_id, ts, event_type = 'error' AS hit, lag(ts, 1) OVER w AS t1, lag(ts, 2) OVER w AS t0,
                    lag(event_type = 'error', 1) OVER w AS h1, lag(event_type = 'error', 2) OVER w AS h0
             FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts))
SELECT user_id, {sql_text('t0')} AS first_ts, {sql_text('t1')} AS second_ts, {sql_text('ts')} AS third_ts
FROM seq WHERE hit AND h1 AND h0"""


def _three_errors(spark: SparkSession, folder: str, **options: int) -> DataFrame:
    found = patterns.consecutive_match(
        inputs.events(spark, folder), "user_id", "ts", F.col("event_type") == "error", 3, **options)
    names = ["first_ts", "second_ts", "third_ts"]
    return found.select("user_id", *[text(F.col("match_times")[i]).alias(n) for i, n in enumerate(names)])


@query(_THREE)
def consecutive_match(spark: SparkSession, folder: str) -> DataFrame:
    return _three_errors(spark, folder)


@query(_THREE)
def consecutive_match_hot_users(spark: SparkSession, folder: str) -> DataFrame:
    """As ``consecutive_match``, with every user cut into slices."""
    return _three_errors(spark, folder, rows_per_slice=15)


@query(f"""
WITH seq AS (SELECT user_id, event_type, ts, lead(ts) OVER w AS nts, lead(event_type) OVER w AS nkind
             FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts))
SELECT user_id, CASE WHEN nts < ts + INTERVAL 1 HOUR THEN 'match' ELSE 'timeout' END AS kind,
       {sql_text('ts')} AS first_ts, CASE WHEN nts < ts + INTERVAL 1 HOUR THEN {sql_text('nts')} END AS second_ts
FROM seq WHERE event_type = 'view' AND (nts IS NULL OR nts >= ts + INTERVAL 1 HOUR OR nkind = 'purchase')""")
def sequence_within(spark: SparkSession, folder: str) -> DataFrame:
    """Views immediately followed by a purchase within an hour."""
    found = patterns.sequence_within(
        inputs.events(spark, folder), "user_id", "ts", F.col("event_type") == "view",
        F.col("event_type") == "purchase", 3600)
    return found.withColumns({c: text(c) for c in ("first_ts", "second_ts")})


@query(f"""
WITH seq AS (SELECT user_id, event_type, ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS nts
             FROM events WHERE event_type IN ('signup', 'purchase'))
SELECT user_id, 'paid' AS kind, {sql_text('ts')} AS at FROM seq WHERE event_type = 'purchase'
UNION ALL
SELECT user_id, 'timeout', {sql_text('ts + INTERVAL 6 HOUR')} FROM seq
WHERE event_type = 'signup' AND (nts IS NULL OR nts > ts + INTERVAL 6 HOUR)""")
def order_timeout(spark: SparkSession, folder: str) -> DataFrame:
    """Sign-ups not followed by a purchase within six hours."""
    found = patterns.order_timeout(
        inputs.events(spark, folder), "user_id", "ts", F.col("event_type") == "signup",
        F.col("event_type") == "purchase", 6 * 3600)
    return found.withColumn("at", text("at"))


@query("""
SELECT CAST(quantity AS BIGINT) AS quantity, count(*) AS n FROM (
  SELECT l_quantity AS quantity FROM lineitem UNION ALL SELECT p_size FROM part UNION ALL
  SELECT c_nationkey FROM customer) GROUP BY ALL""")
def union_streams(spark: SparkSession, folder: str) -> DataFrame:
    """Three inputs of one meaning, the last typed as text."""
    numbers = [
        inputs.table(spark, folder, "lineitem").select(F.col("l_quantity").alias("quantity")),
        inputs.table(spark, folder, "part").select(F.col("p_size").alias("quantity")),
        inputs.table(spark, folder, "customer").select(F.col("c_nationkey").cast("string").alias("quantity")),
    ]
    return union_all(*numbers, schema="quantity long").groupBy("quantity").agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT 'customer ' || c_custkey AS line FROM customer UNION ALL SELECT 'part ' || p_name FROM part""")
def connect_map(spark: SparkSession, folder: str) -> DataFrame:
    """Two differently typed inputs mapped to one output type."""
    return connect(
        inputs.table(spark, folder, "customer"), inputs.table(spark, folder, "part"),
        [F.concat(F.lit("customer "), F.col("c_custkey").cast("string")).alias("line")],
        [F.concat(F.lit("part "), F.col("p_name")).alias("line")])


class Spread(Aggregate):
    """Count, smallest and largest value."""

    def create(self):
        return (0, float("inf"), float("-inf"))

    def add(self, acc, rows):
        return (acc[0] + len(rows), min(acc[1], rows["value"].min()), max(acc[2], rows["value"].max()))

    def merge(self, a, b):
        return (a[0] + b[0], min(a[1], b[1]), max(a[2], b[2]))

    def result(self, acc):
        return acc


@query("SELECT event_type, count(*) AS n, min(value) AS low, max(value) AS high FROM events GROUP BY event_type")
def user_aggregate(spark: SparkSession, folder: str) -> DataFrame:
    """A user-written aggregate with create, add, merge and result."""
    return aggregate(inputs.events(spark, folder), ["event_type"], ["value"], Spread(),
                     "n long, low double, high double")
