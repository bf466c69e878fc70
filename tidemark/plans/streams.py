"""The streaming operators run over the events table, read as a stream of files.

The stateful ones get it in four parts, one per micro-batch and in the order of events, so that state,
timers and watermarks are carried between batches. Each query runs until the files present are consumed and returns what it wrote. A window or
timeout the last watermark has not passed is not part of the result, which is what the
``closed`` conditions of the oracle SQL say.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import joins as batch_joins
from tidemark.operators import windows as batch_windows
from tidemark.operators.warehouse import read_final
from tidemark.plans import inputs
from tidemark.plans.inputs import kind, sql_text, text
from tidemark.plans.registry import query
from tidemark.session import scratch_path, written
from tidemark.streaming import joins, patterns, streams, windows
from tidemark.streaming.sinks import batched_sink, drain

SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double"


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return streams.table_stream(spark, folder, "events", SCHEMA).withColumn(
        "ts", F.col("ts").cast("timestamp"))


def _in_files(spark: SparkSession, rows: DataFrame, cuts: list[Column]) -> DataFrame:
    """``rows`` as a stream of one part per micro-batch: the i-th has the rows of the i-th condition that holds first."""
    path = scratch_path(spark, "feed")
    part = F.lit(len(cuts))
    for i, cut in reversed(list(enumerate(cuts))):
        part = F.when(cut, i).otherwise(part)
    numbered = written(rows.withColumn("_part", part), "feed-rows")
    # every part in as many files as a micro-batch takes; no task writes more than its share of a part
    sizes = numbered.groupBy("_part").agg(F.count(F.lit(1))).collect()
    files = min([spark.sparkContext.defaultParallelism, *(n // 100 + 1 for _, n in sizes)])
    for i in range(len(cuts) + 1):  # written one after the other: a file source takes the oldest first
        numbered.where(F.col("_part") == i).drop("_part").repartition(files).write.mode("append").parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(path)


def _ordered(spark: SparkSession, folder: str) -> DataFrame:
    """Events in four parts by time."""
    rows = inputs.events(spark, folder).select("event_id", "ts", "user_id", "event_type", "value")
    days = [F.col("ts") < F.lit(d).cast("timestamp_ntz") for d in ("2024-01-08", "2024-01-16", "2024-01-23")]
    return _in_files(spark, rows, days).withColumn("ts", F.col("ts").cast("timestamp"))


def _with_late(spark: SparkSession, folder: str) -> DataFrame:
    """As ``_ordered``, but each 50th event of the first week comes with the third part, two weeks late."""
    rows = inputs.events(spark, folder).select("event_id", "ts", "user_id", "event_type", "value")
    held = (F.col("event_id") % 50 == 0) & (F.col("ts") < F.lit("2024-01-08").cast("timestamp_ntz"))
    days = [(F.col("ts") < F.lit(d).cast("timestamp_ntz")) & ~held for d in ("2024-01-08", "2024-01-16")]
    third = held | (F.col("ts") < F.lit("2024-01-23").cast("timestamp_ntz"))
    return _in_files(spark, rows, [*days, third]).withColumn("ts", F.col("ts").cast("timestamp"))


#: The late rows of ``_with_late`` in SQL.
_LATE = "(event_id % 50 = 0 AND ts < TIMESTAMP '2024-01-08')"


def _late_sides(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return tuple(kind(_with_late(spark, folder).select("event_id", "user_id", "event_type", "ts"), name).drop("event_type")
                 for name in ("view", "purchase"))


def _ordered_sides(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    rows = _ordered(spark, folder).select("event_id", "user_id", "event_type", "ts")
    return tuple(kind(rows, name).drop("event_type") for name in ("view", "purchase"))


def _sides(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    rows = _events(spark, folder).select("event_id", "user_id", "event_type", "ts")
    return tuple(kind(rows, name).drop("event_type") for name in ("view", "purchase"))


def _text(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: text(c) for c in columns})


def _pairs(df: DataFrame) -> DataFrame:
    return df.select("user_id", "event_id", "right_event_id")


_HOURS = f"""{sql_text("date_trunc('hour', ts)")} AS window_start,
       {sql_text("date_trunc('hour', ts) + INTERVAL 1 HOUR")} AS window_end"""
_CLOSED = "date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM {source})"
_VIEWS = "(SELECT * FROM events WHERE event_type = 'view')"
_L = "l AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'view')"
_R = "r AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase')"


@query("SELECT user_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS happened FROM events")
def stream_event_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Events written as text lines and read back as a typed stream."""
    path = scratch_path(spark, "lines")
    rows = inputs.events(spark, folder)
    rows.select("user_id", "event_type", F.unix_seconds(F.col("ts").cast("timestamp"))).write.csv(path)
    lines = streams.event_stream(spark, path, "user_id long, event_type string, at long", "at")
    return drain(lines).select("user_id", "event_type",
                               F.date_format("et", "yyyy-MM-dd HH:mm:ss").alias("happened"))


@query("SELECT event_id, user_id FROM events WHERE event_type IN ('view', 'purchase')")
def stream_union(spark: SparkSession, folder: str) -> DataFrame:
    return drain(streams.union_streams(*_sides(spark, folder), schema="event_id long, user_id long"))


@query("""
SELECT 'seen by ' || user_id AS line FROM events WHERE event_type = 'view'
UNION ALL SELECT 'bought in event ' || event_id FROM events WHERE event_type = 'purchase'""")
def stream_connect_map(spark: SparkSession, folder: str) -> DataFrame:
    seen, bought = _sides(spark, folder)
    return drain(streams.connect_map(
        seen, bought, [F.concat(F.lit("seen by "), F.col("user_id").cast("string")).alias("line")],
        [F.concat(F.lit("bought in event "), F.col("event_id").cast("string")).alias("line")]))


@query(f"""
SELECT event_type, {_HOURS}, count(*) AS n FROM events WHERE {_CLOSED.format(source='events')} GROUP BY ALL""")
def stream_tumbling_count(spark: SparkSession, folder: str) -> DataFrame:
    found = drain(windows.tumbling_count(_ordered(spark, folder), "event_type", "ts", "1 hour", "0 seconds"))
    return _text(found, "window_start", "window_end")


@query(f"""
SELECT event_type, {_HOURS}, 'main' AS kind, count(*) AS n, NULL AS at FROM events
WHERE {_CLOSED.format(source='events')} AND NOT {_LATE} GROUP BY ALL
UNION ALL
SELECT event_type, {_HOURS}, 'late', NULL, {sql_text('ts')} FROM events WHERE {_LATE}""")
def stream_tumbling_count_late(spark: SparkSession, folder: str) -> DataFrame:
    """Every row is counted or comes out as late, also those two weeks behind."""
    found = drain(windows.tumbling_count_late(
        _with_late(spark, folder), "event_type", "ts", "1 hour", delay=0, lateness=600))
    return _text(found, "window_start", "window_end", "at")


@query(f"""
WITH shown AS (SELECT user_id, time_bucket(INTERVAL 5 MINUTE, ts) - INTERVAL 5 MINUTE * k AS ws
               FROM events, (SELECT unnest(range(0, 12)) AS k) WHERE event_type = 'view'),
counted AS (SELECT ws, user_id, count(*) AS view_count FROM shown
            WHERE ws + INTERVAL 1 HOUR <= (SELECT max(ts) FROM {_VIEWS}) GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY ws ORDER BY view_count DESC, user_id) AS rank FROM counted)
SELECT {sql_text('ws')} AS window_start, {sql_text('ws + INTERVAL 1 HOUR')} AS window_end, user_id, view_count, rank
FROM ranked WHERE rank <= 3""")
def stream_hot_items(spark: SparkSession, folder: str) -> DataFrame:
    found = drain(windows.hot_items(kind(_ordered(spark, folder), "view"), "user_id", "ts"))
    return _text(found, "window_start", "window_end")


@query(f"""
WITH counted AS (SELECT date_trunc('hour', ts) AS ws, event_type, count(*) AS score FROM events
                 WHERE {_CLOSED.format(source='events')} GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY ws ORDER BY score DESC, event_type) AS rank FROM counted)
SELECT {sql_text('ws + INTERVAL 1 HOUR')} AS window_end, event_type, score, rank FROM ranked
WHERE rank <= 2 AND ws + INTERVAL 1 HOUR < (SELECT max(ts) FROM events)""")
def stream_top_n_keyed(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly counts, then the two largest of each hour kept in list state until its timer."""
    marked = streams.watermark(_ordered(spark, folder), "ts")
    counts = marked.groupBy(F.window("ts", "1 hour"), "event_type").agg(F.count(F.lit(1)).alias("score"))
    timed = counts.select(F.window_time("window").alias("at"), F.col("window.end").alias("window_end"),
                          "event_type", "score")
    found = drain(windows.top_n_keyed(timed, "window_end", "at", "event_type", "score", 2, shards=1))
    return _text(found, "window_end")


_UV = f"""
SELECT {_HOURS}, count(DISTINCT user_id) AS uv FROM events
WHERE event_type = 'view' AND {_CLOSED.format(source=_VIEWS)} GROUP BY ALL"""


@query(_UV)
def stream_window_uv_exact(spark: SparkSession, folder: str) -> DataFrame:
    found = drain(windows.window_uv_exact(kind(_ordered(spark, folder), "view"), "user_id", "ts"))
    return _text(found, "window_start", "window_end")


@query(f"""
SELECT {sql_text("date_trunc('day', ts)")} AS window_start, {sql_text("date_trunc('day', ts) + INTERVAL 1 DAY")} AS window_end,
       count(DISTINCT user_id) AS exact, TRUE AS within_error FROM events
WHERE event_type = 'view' AND date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) FROM {_VIEWS}) GROUP BY ALL""")
def stream_window_uv_approx(spark: SparkSession, folder: str) -> DataFrame:
    """The sketch of each closed day against its exact count: at most three standard errors off."""
    rsd = 0.01
    found = _text(drain(windows.window_uv_approx(
        kind(_ordered(spark, folder), "view"), "user_id", "ts", "1 day", rsd=rsd)), "window_start", "window_end")
    exact = batch_windows.window_uv_exact(kind(inputs.events(spark, folder), "view"), "user_id", "ts", "1 day")
    both = found.join(_text(exact.withColumnRenamed("uv", "exact"), "window_start", "window_end"),
                      ["window_start", "window_end"])
    near = F.abs(F.col("uv") - F.col("exact")) <= F.ceil(F.col("exact") * 3 * rsd)
    return both.select("window_start", "window_end", "exact", near.alias("within_error"))


@query(f"""
SELECT {sql_text("date_trunc('day', ts)")} AS window_start, {sql_text("date_trunc('day', ts) + INTERVAL 1 DAY")} AS window_end,
       count(DISTINCT user_id) AS exact, TRUE AS never_above, TRUE AS within_bound FROM events
WHERE event_type = 'view' AND date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) FROM {_VIEWS}) GROUP BY ALL""")
def stream_window_uv_filter(spark: SparkSession, folder: str) -> DataFrame:
    """The filter of each closed day against its exact count: never above, and short by little more than pairs that share a bit."""
    found = _text(drain(windows.window_uv_filter(
        kind(_ordered(spark, folder), "view"), "user_id", "ts", "1 day")), "window_start", "window_end")
    exact = batch_windows.window_uv_exact(kind(inputs.events(spark, folder), "view"), "user_id", "ts", "1 day")
    both = found.join(_text(exact.withColumnRenamed("uv", "exact"), "window_start", "window_end"),
                      ["window_start", "window_end"])
    missed = windows.missed(F.col("exact"), windows.bitmaps_of(20_000, 0.001))
    return both.select("window_start", "window_end", "exact", (F.col("uv") <= F.col("exact")).alias("never_above"),
                       (F.col("exact") - F.col("uv") <= missed + 5 * F.sqrt(missed) + 1).alias("within_bound"))


@query(f"""
WITH counted AS (SELECT event_type, ts, row_number() OVER (PARTITION BY event_type, date_trunc('hour', ts)
                                                           ORDER BY ts) AS n FROM events)
SELECT event_type, {_HOURS}, 'running' AS kind, n FROM counted
UNION ALL
SELECT event_type, {_HOURS}, 'final', count(*) FROM events WHERE {_CLOSED.format(source='events')} GROUP BY ALL""")
def stream_eager_window(spark: SparkSession, folder: str) -> DataFrame:
    found = drain(windows.eager_window(_ordered(spark, folder), "event_type", "ts", "1 hour"))
    return _text(found, "window_start", "window_end")


@query(f"""
WITH lagged AS (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS prev FROM events),
numbered AS (SELECT *, sum(CASE WHEN ts - prev >= INTERVAL 30 MINUTE THEN 1 ELSE 0 END)
                       OVER (PARTITION BY user_id ORDER BY ts) AS session FROM lagged)
SELECT user_id, {sql_text('min(ts)')} AS window_start, {sql_text('max(ts) + INTERVAL 30 MINUTE')} AS window_end,
       count(*) AS n
FROM numbered GROUP BY user_id, session
HAVING max(ts) + INTERVAL 30 MINUTE <= (SELECT max(ts) FROM events)""")
def stream_session_counts(spark: SparkSession, folder: str) -> DataFrame:
    found = drain(windows.session_counts(_ordered(spark, folder), "user_id", "ts", "30 minutes"))
    return _text(found, "window_start", "window_end")


@query(f"""
WITH {_L}, {_R}
SELECT l.user_id, l.event_id, r.event_id AS right_event_id
FROM l JOIN r ON l.user_id = r.user_id AND date_trunc('hour', l.ts) = date_trunc('hour', r.ts)""")
def stream_window_join(spark: SparkSession, folder: str) -> DataFrame:
    return _pairs(drain(joins.window_join(*_ordered_sides(spark, folder), "user_id", "ts", "1 hour")))


@query(f"""
WITH {_L}, {_R},
both_sides AS (SELECT 'l' AS side, * FROM l UNION ALL SELECT 'r', * FROM r),
lagged AS (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS prev FROM both_sides),
numbered AS (SELECT *, sum(CASE WHEN ts - prev > INTERVAL 30 MINUTE THEN 1 ELSE 0 END)
                       OVER (PARTITION BY user_id ORDER BY ts) AS session FROM lagged),
closed AS (SELECT user_id, session FROM numbered GROUP BY user_id, session
           HAVING epoch_ms(max(ts)) + 1800000 <= least((SELECT epoch_ms(max(ts)) FROM l), (SELECT epoch_ms(max(ts)) FROM r)) - 16 * 86400000)
SELECT a.user_id, a.event_id, b.event_id AS right_event_id
FROM numbered a JOIN numbered b ON a.user_id = b.user_id AND a.session = b.session AND a.side = 'l' AND b.side = 'r'
JOIN closed c ON c.user_id = a.user_id AND c.session = a.session""")
def stream_session_window_join(spark: SparkSession, folder: str) -> DataFrame:
    """Views and purchases of one session, some of the first week's coming with the third part."""
    return _pairs(drain(joins.session_window_join(
        *_late_sides(spark, folder), "user_id", "ts", "30 minutes", delay="16 days")))


@query(f"""
WITH {_L}, {_R}
SELECT l.user_id, l.event_id, r.event_id AS right_event_id FROM l ASOF LEFT JOIN r ON l.user_id = r.user_id AND l.ts >= r.ts
WHERE (epoch_us(l.ts) + 999) // 1000 + 1
  <= least((SELECT epoch_ms(max(ts)) FROM l), (SELECT epoch_ms(max(ts)) FROM r)) - 16 * 86400000""")
def stream_as_of_join(spark: SparkSession, folder: str) -> DataFrame:
    """Views with the last purchase of the user before them, some purchases and views coming two weeks late."""
    return _pairs(drain(joins.as_of_join(
        *_late_sides(spark, folder), "user_id", "ts", "ts", delay=16 * 86400, shards=2)))


_NEAR = f"""
WITH {_L}, {_R},
pairs AS (SELECT l.user_id, l.event_id, r.event_id AS right_event_id
          FROM l JOIN r ON l.user_id = r.user_id
           AND r.ts BETWEEN l.ts - INTERVAL 20 MINUTE AND l.ts + INTERVAL 10 MINUTE)"""


@query(f"{_NEAR} SELECT * FROM pairs")
def stream_interval_join(spark: SparkSession, folder: str) -> DataFrame:
    return _pairs(drain(joins.interval_join(*_ordered_sides(spark, folder), "user_id", "ts", -1200, 600)))


@query(f"""{_NEAR}
SELECT 'match' AS kind, pairs.* FROM pairs JOIN l ON l.event_id = pairs.event_id JOIN r ON r.event_id = right_event_id
WHERE NOT {_LATE.replace('event_id', 'l.event_id').replace('ts', 'l.ts')}
  AND NOT {_LATE.replace('event_id', 'r.event_id').replace('ts', 'r.ts')}
UNION ALL SELECT 'left_late', user_id, event_id, NULL FROM l WHERE {_LATE}
UNION ALL SELECT 'right_late', user_id, NULL, event_id FROM r WHERE {_LATE}""")
def stream_interval_join_late(spark: SparkSession, folder: str) -> DataFrame:
    """Matches, and every row two weeks behind as late."""
    found = drain(joins.interval_join_late(*_late_sides(spark, folder), "user_id", "ts", -1200, 600, 600))
    return found.select("kind", F.coalesce("left.user_id", "right.user_id").alias("user_id"),
                        F.col("left.event_id").alias("event_id"),
                        F.col("right.event_id").alias("right_event_id"))


@query(f"""{_NEAR}
SELECT * FROM pairs
UNION ALL
SELECT user_id, event_id, NULL FROM l
WHERE event_id NOT IN (SELECT event_id FROM pairs)
  AND epoch_ms(ts) + 600000 < (SELECT least((SELECT epoch_ms(max(ts)) FROM l), (SELECT epoch_ms(max(ts)) FROM r)))""")
def stream_left_join(spark: SparkSession, folder: str) -> DataFrame:
    """Views with no purchase near them are padded once none can arrive any more."""
    return _pairs(drain(joins.outer_join(*_ordered_sides(spark, folder), "user_id", "ts", -1200, 600, "left")))


@query(f"""{_NEAR}
SELECT * FROM pairs
UNION ALL
SELECT user_id, event_id, NULL FROM l
WHERE event_id NOT IN (SELECT event_id FROM pairs)
  AND epoch_ms(ts) + 600000 < (SELECT least((SELECT epoch_ms(max(ts)) FROM l), (SELECT epoch_ms(max(ts)) FROM r)))
UNION ALL
SELECT user_id, NULL, event_id FROM r
WHERE event_id NOT IN (SELECT right_event_id FROM pairs)
  AND epoch_ms(ts) + 1200000 < (SELECT least((SELECT epoch_ms(max(ts)) FROM l), (SELECT epoch_ms(max(ts)) FROM r)))""")
def stream_full_join(spark: SparkSession, folder: str) -> DataFrame:
    return _pairs(drain(joins.outer_join(*_ordered_sides(spark, folder), "user_id", "ts", -1200, 600, "full")))


@query("""
WITH l AS (SELECT *, user_id || ' ' || strftime(ts, '%Y-%m-%d') AS visit FROM events WHERE event_type = 'signup'),
r AS (SELECT *, user_id || ' ' || strftime(ts, '%Y-%m-%d') AS visit FROM events WHERE event_type = 'purchase'),
lf AS (SELECT visit, min(event_id) AS first FROM l GROUP BY visit),
rf AS (SELECT visit, min(event_id) AS first FROM r GROUP BY visit),
lp AS (SELECT l.*, first FROM l LEFT JOIN rf USING (visit) WHERE first IS NULL OR first > event_id),
rp AS (SELECT r.*, first FROM r LEFT JOIN lf USING (visit) WHERE first IS NULL OR first > event_id)
SELECT '+I' AS op, greatest(l.event_id, r.event_id) AS at, visit, l.event_id, r.event_id AS right_event_id
FROM l JOIN r USING (visit)
UNION ALL SELECT '+I', event_id, visit, event_id, NULL FROM lp
UNION ALL SELECT '-D', first, visit, event_id, NULL FROM lp WHERE first IS NOT NULL
UNION ALL SELECT '+I', event_id, visit, NULL, event_id FROM rp
UNION ALL SELECT '-D', first, visit, NULL, event_id FROM rp WHERE first IS NOT NULL""")
def stream_changelog_join(spark: SparkSession, folder: str) -> DataFrame:
    """Sign-ups and purchases of a user and day, full join with withdrawals."""
    day = F.date_format("ts", "yyyy-MM-dd")
    rows = _ordered(spark, folder).withColumn("visit", F.concat(
        F.col("user_id").cast("string"), F.lit(" "), day))
    left, right = (kind(rows, name).select("visit", "event_id") for name in ("signup", "purchase"))
    log = drain(joins.changelog_join(left, right, "visit", "event_id", "full", shards=2))
    return log.select("op", "at", "visit", F.col("left.event_id").alias("event_id"),
                      F.col("right.event_id").alias("right_event_id"))


@query("""
SELECT event_id, user_id, c_mktsegment FROM events LEFT JOIN customer ON user_id = c_custkey""")
def stream_lookup_join(spark: SparkSession, folder: str) -> DataFrame:
    customer = inputs.table(spark, folder, "customer").select(
        F.col("c_custkey").alias("user_id"), "c_mktsegment")
    rows = _events(spark, folder).select("event_id", "user_id")
    return drain(batch_joins.lookup_join(rows, customer, ["user_id"]))


@query(f"""
WITH seq AS (SELECT user_id, ts, event_type = 'error' AS hit, lag(ts, 1) OVER w AS t1, lag(ts, 2) OVER w AS t0,
                    lag(event_type = 'error', 1) OVER w AS h1, lag(event_type = 'error', 2) OVER w AS h0
             FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts))
SELECT user_id, {sql_text('t0')} AS first_ts, {sql_text('t1')} AS second_ts, {sql_text('ts')} AS third_ts
FROM seq WHERE hit AND h1 AND h0""")
def stream_consecutive_match(spark: SparkSession, folder: str) -> DataFrame:
    found = drain(patterns.consecutive_match(
        _ordered(spark, folder), "user_id", "ts", F.col("event_type") == "error"))
    names = ["first_ts", "second_ts", "third_ts"]
    return found.select("user_id", *[text(F.col("match_times")[i]).alias(n) for i, n in enumerate(names)])


_END_MS = "(SELECT epoch_ms(max(ts)) FROM {source})"


@query(f"""
WITH seq AS (SELECT user_id, event_type, ts, lead(ts) OVER w AS nts, lead(event_type) OVER w AS nkind
             FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts))
SELECT user_id, CASE WHEN nts < ts + INTERVAL 1 HOUR THEN 'match' ELSE 'timeout' END AS kind,
       {sql_text('ts')} AS first_ts, CASE WHEN nts < ts + INTERVAL 1 HOUR THEN {sql_text('nts')} END AS second_ts
FROM seq WHERE event_type = 'view' AND (nts IS NULL OR nts >= ts + INTERVAL 1 HOUR OR nkind = 'purchase')
 AND (nts IS NOT NULL OR epoch_ms(ts) + 3600000 <= {_END_MS.format(source='events')})""")
def stream_sequence_within(spark: SparkSession, folder: str) -> DataFrame:
    found = drain(patterns.sequence_within(
        _ordered(spark, folder), "user_id", "ts", F.col("event_type") == "view",
        F.col("event_type") == "purchase", 3600))
    return _text(found, "first_ts", "second_ts")


@query(f"""
WITH rows_used AS (SELECT * FROM events WHERE event_type IN ('signup', 'purchase')),
seq AS (SELECT user_id, event_type, ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS nts FROM rows_used)
SELECT user_id, 'paid' AS kind, {sql_text('ts')} AS at FROM seq WHERE event_type = 'purchase'
UNION ALL
SELECT user_id, 'timeout', {sql_text('ts + INTERVAL 6 HOUR')} FROM seq
WHERE event_type = 'signup' AND (nts > ts + INTERVAL 6 HOUR
  OR (nts IS NULL AND epoch_ms(ts) + 6 * 3600000 < {_END_MS.format(source='rows_used')}))""")
def stream_order_timeout(spark: SparkSession, folder: str) -> DataFrame:
    found = drain(patterns.order_timeout(
        _ordered(spark, folder), "user_id", "ts", F.col("event_type") == "signup",
        F.col("event_type") == "purchase", 6 * 3600))
    return _text(found, "at")


@query("SELECT event_id, user_id, event_type FROM events")
def stream_batched_sink(spark: SparkSession, folder: str) -> DataFrame:
    """Written twice to one place, as after a lost checkpoint, and merged on read."""
    rows = _events(spark, folder).select("event_id", "user_id", "event_type")
    path = scratch_path(spark, "sink")
    for _ in range(2):
        batched_sink(rows, path, scratch_path(spark, "state"), available_now=True).awaitTermination()
    schema = rows.schema.add("query", "string").add("batch_id", "long")
    return read_final(spark.read.schema(schema).parquet(path), ["event_id"], ["batch_id", "query"]).drop(
        "batch_id", "query")
