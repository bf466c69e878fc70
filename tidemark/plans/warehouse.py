"""The warehouse patterns over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import warehouse
from tidemark.plans import inputs
from tidemark.plans.inputs import EARLY_DAY, MIDDLE_DAY, table
from tidemark.plans.registry import query
from tidemark.session import scratch_path
from tidemark.sources.tables import read_current, swap_table

EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


def customer_zip(spark: SparkSession, folder: str, before: str) -> DataFrame:
    """History of each customer up to the day before ``before``, one row per change day."""
    changes = inputs.customer_versions(spark, folder).where(F.col("dt") < before)
    newest = warehouse.latest_per_key(changes, ["id", "dt"], ["ts"])
    by_day = warehouse.Window.partitionBy("id").orderBy("dt")
    end = F.date_format(F.date_sub(F.lead("dt").over(by_day), 1), "yyyy-MM-dd")
    return newest.select(
        "id", "create_time", "operate_time", F.col("dt").alias("start_date"),
        F.coalesce(end, F.lit(warehouse.OPEN_END)).alias("end_date"),
    ).withColumn("dt", F.col("end_date"))


def _changed(day: str) -> str:
    """The history before ``day`` and what its changes open and close, as SQL."""
    return f"""WITH {inputs.VERSIONS.format(before=day)},
changed AS (SELECT id, create_time, operate_time FROM newest WHERE dt = '{day}'),
opened AS (SELECT id, create_time, operate_time, '{day}' AS start_date, '9999-12-31' AS end_date FROM changed),
closed AS (SELECT id, z.create_time, z.operate_time, start_date,
                  CASE WHEN end_date = '9999-12-31' AND id IN (SELECT id FROM changed)
                       THEN strftime(DATE '{day}' - 1, '%Y-%m-%d') ELSE end_date END AS end_date,
                  end_date AS old_end
           FROM zip z)"""


def _rebuilt(day: str) -> str:
    return f"""{_changed(day)}
SELECT *, end_date AS dt FROM opened
UNION ALL SELECT id, create_time, operate_time, start_date, end_date, end_date AS dt FROM closed"""


@query(f"""{_changed(MIDDLE_DAY)}
SELECT *, end_date AS dt FROM opened
UNION ALL SELECT id, create_time, operate_time, start_date, end_date, end_date AS dt FROM closed
WHERE old_end = '9999-12-31'""")
def scd2_apply(spark: SparkSession, folder: str) -> DataFrame:
    history = customer_zip(spark, folder, MIDDLE_DAY)
    return warehouse.scd2_apply(history, inputs.customer_versions(spark, folder), MIDDLE_DAY)


@query(_rebuilt(EARLY_DAY))
def scd2_publish(spark: SparkSession, folder: str) -> DataFrame:
    """The history as a stored table, one day of changes applied to it in place, twice."""
    path = scratch_path(spark, "customer_zip")
    warehouse.scd2_publish(customer_zip(spark, folder, EARLY_DAY), path)
    changes = inputs.customer_versions(spark, folder)
    for _ in range(2):
        stored = read_current(spark, path)
        warehouse.scd2_publish(warehouse.scd2_apply(stored, changes, EARLY_DAY), path, EARLY_DAY)
    return read_current(spark, path)


@query(_rebuilt(EARLY_DAY))
def scd2_publish_corrected(spark: SparkSession, folder: str) -> DataFrame:
    """A day first applied with half of its changes, some of them wrong, then run again with the right ones."""
    path = scratch_path(spark, "customer_zip")
    warehouse.scd2_publish(customer_zip(spark, folder, EARLY_DAY), path)
    changes = inputs.customer_versions(spark, folder)
    wrong = F.when(F.col("id") % 3 == 0, "wrong").otherwise(F.col("create_time"))
    first = changes.where("id % 2 = 0").withColumn("create_time", wrong)
    extra = changes.where(F.col("dt") < EARLY_DAY).where("id % 7 = 1").withColumn("dt", F.lit(EARLY_DAY))
    for run in (first.unionByName(extra), changes):
        stored = read_current(spark, path)
        warehouse.scd2_publish(warehouse.scd2_apply(stored, run, EARLY_DAY), path, EARLY_DAY)
    return read_current(spark, path)


@query(_rebuilt(EARLY_DAY))
def scd2_rebuild_swapped(spark: SparkSession, folder: str) -> DataFrame:
    """The whole history rebuilt from itself and swapped in, twice: first with half of the changes, then with all."""
    path = scratch_path(spark, "customer_zip")
    swap_table(customer_zip(spark, folder, EARLY_DAY), path, "dt")
    changes = inputs.customer_versions(spark, folder)
    for run in (changes.where("id % 2 = 0"), changes):
        stored = read_current(spark, path)
        swap_table(warehouse.scd2_rebuild(stored, run, EARLY_DAY), path, "dt")
    return read_current(spark, path)


@query(_rebuilt(MIDDLE_DAY))
def scd2_rebuild(spark: SparkSession, folder: str) -> DataFrame:
    history = customer_zip(spark, folder, MIDDLE_DAY)
    return warehouse.scd2_rebuild(history, inputs.customer_versions(spark, folder), MIDDLE_DAY)


@query("""
WITH changes AS (
  SELECT event_type, ts AS instant, 1 AS change FROM events
  UNION ALL
  SELECT event_type, ts + to_seconds(CAST(round(value * 60) AS BIGINT)), -1 FROM events),
levels AS (SELECT event_type, sum(change) OVER (PARTITION BY event_type ORDER BY instant) AS level FROM changes)
SELECT event_type, CAST(max(level) AS BIGINT) AS max_user_count FROM levels GROUP BY event_type""")
def max_concurrency(spark: SparkSession, folder: str) -> DataFrame:
    stays = inputs.events(spark, folder).select(
        "event_type", "ts",
        (F.col("ts") + F.make_dt_interval(secs=F.round(F.col("value") * 60))).alias("until"))
    return warehouse.max_concurrency(stays, "event_type", "ts", "until")


_SESSIONS = """
WITH lagged AS (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS prev FROM events),
marked AS (SELECT *, CASE WHEN prev IS NULL OR ts - prev >= INTERVAL 60 SECOND THEN 1 ELSE 0 END AS starts FROM lagged)
SELECT event_id, user_id, event_type,
       user_id || '-' || sum(starts) OVER (PARTITION BY user_id ORDER BY ts) AS session_id
FROM marked"""


@query(_SESSIONS)
def sessionize(spark: SparkSession, folder: str) -> DataFrame:
    found = warehouse.sessionize(inputs.events(spark, folder), "user_id", "ts", 60)
    return found.select("event_id", "user_id", "event_type", "session_id")


@query(_SESSIONS)
def sessionize_hot_users(spark: SparkSession, folder: str) -> DataFrame:
    """As ``sessionize``, with a limit so low that every user counts as a hot key."""
    found = warehouse.sessionize(inputs.events(spark, folder), "user_id", "ts", 60,
                                 rows_per_slice=20)
    return found.select("event_id", "user_id", "event_type", "session_id")


@query("""
WITH days AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events),
gaps AS (SELECT *, lag(day) OVER (PARTITION BY user_id ORDER BY day) AS prev FROM days),
runs AS (SELECT *, sum(CASE WHEN prev IS NULL OR date_diff('day', prev, day) > 2 THEN 1 ELSE 0 END)
                   OVER (PARTITION BY user_id ORDER BY day) AS run FROM gaps),
lengths AS (SELECT user_id, run, date_diff('day', min(day), max(day)) + 1 AS length FROM runs GROUP BY user_id, run)
SELECT user_id, max(length) AS max_recent_days FROM lengths GROUP BY user_id""")
def longest_streak(spark: SparkSession, folder: str) -> DataFrame:
    return warehouse.longest_streak(inputs.events(spark, folder), "user_id", "ts")


@query("""
WITH days AS (SELECT DISTINCT p_brand, CAST(l_shipdate AS DATE) + CAST(n AS INTEGER) AS day
              FROM lineitem JOIN part ON l_partkey = p_partkey, LATERAL (SELECT unnest(range(0, l_linenumber + 1)) AS n))
SELECT p_brand, count(*) AS promotion_day_count FROM days GROUP BY p_brand""")
def covered_days(spark: SparkSession, folder: str) -> DataFrame:
    ranges = (
        table(spark, folder, "lineitem")
        .join(table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .select("p_brand", F.to_date("l_shipdate").alias("start_date"),
                F.date_add("l_shipdate", F.col("l_linenumber")).alias("end_date"))
    )
    return warehouse.covered_days(ranges, "p_brand", "start_date", "end_date")


_CELLS = ", ".join(
    f"CAST(sum(CASE WHEN event_type = '{t}' THEN CAST(value AS DECIMAL(18, 2)) ELSE 0 END) AS DOUBLE) AS \"{t}\""
    for t in EVENT_TYPES)


@query(f"SELECT user_id, {_CELLS} FROM events GROUP BY user_id ORDER BY user_id")
def pivot_scores(spark: SparkSession, folder: str) -> DataFrame:
    scores = inputs.events(spark, folder).withColumn("value", F.col("value").cast("decimal(18,2)"))
    wide = warehouse.pivot_scores(scores, "user_id", "event_type", "value", EVENT_TYPES)
    return wide.withColumns({t: F.col(t).cast("double") for t in EVENT_TYPES})


@query("SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part")
def explode_list(spark: SparkSession, folder: str) -> DataFrame:
    words = table(spark, folder, "part").select("p_partkey", F.split("p_name", " ").alias("words"))
    return warehouse.explode_list(words, "words", "word")


@query("""
SELECT o_custkey, o_orderkey, o_orderstatus FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
WHERE rn = 1""")
def latest_per_key(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select(
        "o_custkey", "o_orderkey", "o_orderstatus", "o_orderdate")
    return warehouse.latest_per_key(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query("SELECT event_id, user_id, event_type, CAST(1 AS INTEGER) AS delivery FROM events")
def read_final(spark: SparkSession, folder: str) -> DataFrame:
    """Every event delivered twice; the later delivery wins."""
    events = inputs.events(spark, folder).select("event_id", "user_id", "event_type")
    twice = events.withColumn("delivery", F.explode(F.array(F.lit(0), F.lit(1))))
    return warehouse.read_final(twice, ["event_id"], ["delivery"])
