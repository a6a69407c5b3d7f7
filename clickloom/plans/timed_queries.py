"""Streams with timers, corrected results and state from batch (2.7), run to their end over the event table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.late import classify_late, main_stream
from ..operators.ordered import DAY_MS, HOUR_MS
from ..operators.profiles import merged_profiles, window_profiles
from ..session import prepare_streaming, shared_folder, stored
from ..sources.files import stream_events
from ..sources.ranges import stream_lines
from ..sources.tables import behaviour
from ..streaming.processors import PROFILE_OUTPUT
from ..streaming.runners import start_table
from ..streaming.timed import CLOSED_OUTPUT, ResumedProfiles, SilentSessions, corrected_windows, each_once, resumed, timed
from .aggregate_queries import PROFILES_SQL
from .inputs import ARRIVALS_SQL, arrivals
from .registry import query
from .stream_queries import ONE_FILE, _finished, _in_files

# The arrivals are up to 40 minutes behind the newest event of any shard.
LATE_MS = 2_400_000
STATE_PARTITIONS = 12  # at most, where a micro-batch is 10 s of work for them
# For state that sends nothing by itself: no micro-batch without rows, no look at the old value of an entry just to count entries.
STATE_CONF = {
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


@query("u1_stream_corrected_windows", f"""
WITH {ARRIVALS_SQL},
main AS (SELECT * FROM classified WHERE late_class IN ('on_time', 'moderate')),
cut AS (SELECT user_id, ts_ms - ts_ms % 600000 AS window_start_ms, count(*) AS events,
               count(DISTINCT CASE WHEN event_type = 'view' THEN product_id END) AS viewed,
               count(DISTINCT CASE WHEN event_type = 'purchase' THEN product_id END) AS purchased,
               min(ts_ms) AS first_activity_ms, max(ts_ms) AS last_activity_ms FROM main GROUP BY 1, 2)
SELECT * FROM cut WHERE window_start_ms + 600000 <= (SELECT max(ts_ms) FROM main) - 5000
""")
def u1_stream_corrected_windows(spark, folder):
    """The last revision of every window that is complete, from a stream in the order of arrival."""
    prepare_streaming(spark)
    classified = classify_late(arrivals(spark, folder))
    main = main_stream(classified, F.col("arrival_ms")).select(
        "event_id", "user_id", "event_type", "product_id", "ts_ms", "arrival_ms",
        F.timestamp_millis("ts_ms").alias("event_time"))
    main = stored(main, "classified")  # it is sized, sampled and written, and would be classified for each
    path = _in_files(spark, main, "arrival_ms", "main-stream")
    arrived = stream_events(spark, path, main.schema, ONE_FILE).drop("event_id", "arrival_ms")
    windows = corrected_windows(arrived, allowed_ms=LATE_MS)
    newest = _finished(spark, windows, "corrected").groupBy("user_id", "window_start_ms").agg(
        F.max_by(F.struct("events", "viewed_products", "purchased_products", "first_activity_ms", "last_activity_ms"), "revision")
        .alias("w"))
    return newest.select(
        "user_id", "window_start_ms", "w.events", F.size("w.viewed_products").cast("long").alias("viewed"),
        F.size("w.purchased_products").cast("long").alias("purchased"), "w.first_activity_ms", "w.last_activity_ms")


@query("x7_stream_silent_sessions", """
WITH RECURSIVE ordered AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts_ms, event_id) AS n FROM ev
),
walk AS (
  SELECT user_id, n, event_id, ts_ms, ts_ms AS start_time, false AS capped FROM ordered WHERE n = 1
  UNION ALL
  SELECT o.user_id, o.n, o.event_id, o.ts_ms,
         CASE WHEN w.capped OR o.ts_ms - w.ts_ms > 21600000 THEN o.ts_ms ELSE w.start_time END,
         NOT w.capped AND o.ts_ms - w.ts_ms <= 21600000 AND o.ts_ms - w.start_time > 28800000
  FROM walk w JOIN ordered o ON o.user_id = w.user_id AND o.n = w.n + 1
),
sessions AS (
  SELECT w.user_id, w.start_time, max(w.ts_ms) AS last_update, max(w.ts_ms) - w.start_time AS duration_ms,
         least(count(*), 100) AS event_count, count(DISTINCT product_id) AS unique_products,
         count(DISTINCT category_code) AS unique_categories, CASE WHEN bool_or(capped) THEN 'cap' ELSE 'silent' END AS reason
  FROM walk w JOIN ev USING (event_id) GROUP BY w.user_id, w.start_time
)
SELECT * FROM sessions WHERE reason = 'cap' OR last_update + 21600000 + 1 <= (SELECT max(ts_ms) FROM ev) - 5000
""")
def x7_stream_silent_sessions(spark, folder):
    """Closed by an event beyond the cap, or by a timer after six hours without one; the given users come a few times a day."""
    prepare_streaming(spark)
    rows = behaviour(spark, folder).select(
        "event_id", "user_id", "ts_ms", "product_id", F.col("category_code").alias("category_id"), "event_time")
    rows = stored(rows, "categorised")  # every micro-batch would read and join the whole catalog
    path = _in_files(spark, rows, "ts_ms", "categorised-files")
    events = stream_events(spark, path, rows.schema, ONE_FILE)
    closed = timed(events, "user_id", SilentSessions(8 * HOUR_MS, 6 * HOUR_MS), CLOSED_OUTPUT, 5000)
    return _finished(spark, closed, "silent-sessions", partitions=STATE_PARTITIONS)


@query("x6_stream_from_batch", f"""
WITH {PROFILES_SQL}
SELECT user_id, len(list_distinct(flatten(list(viewed)))) AS viewed, len(list_distinct(flatten(list(bought)))) AS purchased,
       len(list_distinct(flatten(list(liked)))) AS categories, max(last_activity_ms) AS last_activity_ms,
       count(*) AS session_count, round(avg(duration), 4) AS avg_session_duration
FROM profiles GROUP BY user_id
""")
def x6_stream_from_batch(spark, folder):
    """The windows of all but the last twelve days are merged in batch; a stream goes on from there with the others."""
    prepare_streaming(spark)
    windows = stored(window_profiles(behaviour(spark, folder)), "profile-windows")
    cut = windows.agg(F.max("window_start_ms") - 12 * DAY_MS).scalar()
    merged = stored(merged_profiles(windows.where(F.col("window_start_ms") < cut)), "merged-profiles")
    later = windows.where(F.col("window_start_ms") >= cut).withColumn("event_id", F.xxhash64("user_id", "window_start_ms"))
    path = _in_files(spark, later, "window_start_ms", "later-windows")
    stream = resumed(stream_events(spark, path, later.schema, ONE_FILE), merged, ResumedProfiles(0), PROFILE_OUTPUT)
    kept = F.struct(
        "viewed_products", "purchased_products", "categories_preferred", "session_count", "avg_session_duration").alias("p")
    newest = _finished(spark, stream, "resumed").groupBy("user_id").agg(F.max_by(kept, "window_start_ms").alias("p"))
    untouched = merged.join(newest, "user_id", "left_anti").select("user_id", kept)
    last = windows.groupBy("user_id").agg(F.max("last_activity_ms").alias("last_activity_ms"))
    return newest.unionByName(untouched).join(last, "user_id").select(
        "user_id", F.size("p.viewed_products").cast("long").alias("viewed"),
        F.size("p.purchased_products").cast("long").alias("purchased"),
        F.size("p.categories_preferred").cast("long").alias("categories"), "last_activity_ms", "p.session_count",
        F.round("p.avg_session_duration", 4).alias("avg_session_duration"))


@query("s8_repeated_deliveries", "SELECT event_id, user_id, event_type, ts_ms FROM ev")
def s8_repeated_deliveries(spark, folder):
    """Two of three events are delivered again up to twenty minutes later, one of three a third time; each comes out once."""
    prepare_streaming(spark)
    events = behaviour(spark, folder, with_catalog=False).select("event_id", "user_id", "event_type", "ts_ms")
    copies = events.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.pmod("event_id", F.lit(3)).cast("int"))))
    delivered = copies.withColumn("arrival_ms", F.col("ts_ms") + F.col("_copy") * 600_000).drop("_copy").withColumn(
        "event_time", F.timestamp_millis("ts_ms"))
    path = _in_files(spark, delivered, "arrival_ms", "deliveries")
    once = each_once(stream_events(spark, path, delivered.schema, ONE_FILE), ["event_id"], "1 hour")
    kept = _finished(spark, once, "each-once", partitions=STATE_PARTITIONS, conf=STATE_CONF)
    return kept.select("event_id", "user_id", "event_type", "ts_ms")


@query("s8_resumed_inside_files", """
SELECT event_id, user_id, event_type, ts_ms, true AS once FROM ev
""")
def s8_resumed_inside_files(spark, folder):
    """Lines of a few large files: the first run stops inside each of them, the second goes on from that position."""
    prepare_streaming(spark)
    base = shared_folder(spark, "byte-positions")
    rows = behaviour(spark, folder, with_catalog=False).select("event_id", "user_id", "event_type", "ts_ms")
    lines = rows.select(F.to_json(F.struct("*")).alias("value"), "event_id").repartitionByRange(3, "event_id")
    lines.select("value").write.text(f"{base}/lines")
    middle = rows.count() * 80 // 6  # bytes in about half of a file
    for until in (middle, None):
        stream = stream_lines(spark, f"{base}/lines", suffix=".txt", range_bytes=max(100_000, middle // 8), until=until)
        start_table(stream, f"{base}/rows", f"{base}/checkpoint").awaitTermination()
    read = spark.read.schema("file string, position long, line string").parquet(f"{base}/rows")
    event = F.from_json("line", "event_id long, user_id string, event_type string, ts_ms long").alias("e")
    counted = read.groupBy("file", "position", "line").agg(F.count("*").alias("_n"))
    return counted.select(event, (F.col("_n") == 1).alias("once")).select("e.*", "once")
