"""Queries on profiles, batch figures, windows, top-k, sessions and late data (2.4, 2.6, 2.7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.activity import (
    counts_by, last_seen, price_stats, product_scores, top_by_count, top_products, trailing_activity,
)
from ..operators.anchored import with_segment
from ..operators.drift import categorical_baseline, numeric_baseline
from ..operators.features import latest_transactions, transactions_of
from ..operators.late import classify_late, main_stream
from ..operators.ordered import HOUR_MS
from ..operators.profiles import merged_profiles, route, running_profiles, window_profiles
from ..operators.recommend import TRENDING_MS
from ..operators.sessions import kept_events, session_history, session_snapshot, session_summary, sessionize
from ..sources.tables import behaviour, catalog
from .inputs import ARRIVALS_SQL, arrivals, latest_ms, numbered_batches
from .registry import query

TYPES = ("click", "error", "purchase", "signup", "view")

PROFILES_SQL = """
profiles AS (
  SELECT user_id, ts_ms - ts_ms % 600000 AS window_start_ms,
         coalesce(list_sort(list_distinct(list(product_id) FILTER (event_type = 'view'))), []) AS viewed,
         coalesce(list_sort(list_distinct(list(product_id) FILTER (event_type = 'purchase'))), []) AS bought,
         coalesce(list_sort(list_distinct(list(category_code) FILTER (event_type IN ('view', 'purchase')
                                                                      AND category_code <> ''))), []) AS liked,
         max(ts_ms) AS last_activity_ms, CAST(max(ts_ms) - min(ts_ms) AS DOUBLE) AS duration
  FROM ev GROUP BY 1, 2
)
"""


def _joined(df, *columns):
    return df.select(*[F.array_join(c, ",").alias(c) if c in columns else F.col(c) for c in df.columns])


SETS = ("viewed_products", "purchased_products", "categories_preferred")


@query("a1_window_profiles", f"""
WITH {PROFILES_SQL}
SELECT user_id, window_start_ms, array_to_string(viewed, ',') AS viewed_products,
       array_to_string(bought, ',') AS purchased_products, array_to_string(liked, ',') AS categories_preferred,
       last_activity_ms, CAST(1 AS BIGINT) AS session_count, duration AS avg_session_duration
FROM profiles
""")
def a1_window_profiles(spark, folder):
    return _joined(window_profiles(behaviour(spark, folder)), *SETS)


@query("a1_daily_profiles", """
SELECT user_id, ts_ms - ts_ms % 86400000 AS window_start_ms,
       count(DISTINCT product_id) FILTER (event_type = 'view') AS viewed,
       count(DISTINCT product_id) FILTER (event_type = 'purchase') AS purchased,
       count(DISTINCT category_code) FILTER (event_type IN ('view', 'purchase')) AS categories,
       CAST(max(ts_ms) - min(ts_ms) AS DOUBLE) AS avg_session_duration
FROM ev GROUP BY 1, 2
""")
def a1_daily_profiles(spark, folder):
    return window_profiles(behaviour(spark, folder), minutes=1440).select(
        "user_id", "window_start_ms", F.size("viewed_products").cast("long").alias("viewed"),
        F.size("purchased_products").cast("long").alias("purchased"),
        F.size("categories_preferred").cast("long").alias("categories"), "avg_session_duration",
    )


@query("a2_merged_profiles", f"""
WITH {PROFILES_SQL}
SELECT user_id, array_to_string(list_sort(list_distinct(flatten(list(viewed)))), ',') AS viewed_products,
       array_to_string(list_sort(list_distinct(flatten(list(bought)))), ',') AS purchased_products,
       array_to_string(list_sort(list_distinct(flatten(list(liked)))), ',') AS categories_preferred,
       max(last_activity_ms) AS last_activity_ms, count(*) AS session_count,
       round(avg(duration), 4) AS avg_session_duration
FROM profiles GROUP BY user_id
""")
def a2_merged_profiles(spark, folder):
    merged = merged_profiles(window_profiles(behaviour(spark, folder)))
    return _joined(merged, *SETS).withColumn("avg_session_duration", F.round("avg_session_duration", 4))


@query("a2_running_profiles", f"""
WITH {PROFILES_SQL},
items AS (
  SELECT user_id, window_start_ms, 'viewed' AS kind, unnest(viewed) AS item FROM profiles
  UNION ALL SELECT user_id, window_start_ms, 'purchased', unnest(bought) FROM profiles
  UNION ALL SELECT user_id, window_start_ms, 'category', unnest(liked) FROM profiles
)
SELECT p.user_id, p.window_start_ms,
       count(DISTINCT i.item) FILTER (i.kind = 'viewed') AS viewed_items,
       count(DISTINCT i.item) FILTER (i.kind = 'purchased') AS purchased_items,
       count(DISTINCT i.item) FILTER (i.kind = 'category') AS category_items,
       any_value(p.so_far) AS session_count, any_value(p.latest) AS last_activity_ms,
       round(any_value(p.mean), 4) AS avg_session_duration
FROM (SELECT user_id, window_start_ms, count(*) OVER w AS so_far, max(last_activity_ms) OVER w AS latest,
             avg(duration) OVER w AS mean
      FROM profiles WINDOW w AS (PARTITION BY user_id ORDER BY window_start_ms)) p
LEFT JOIN items i ON i.user_id = p.user_id AND i.window_start_ms <= p.window_start_ms
GROUP BY p.user_id, p.window_start_ms
""")
def a2_running_profiles(spark, folder):
    running = running_profiles(window_profiles(behaviour(spark, folder)))
    return running.drop("viewed_in_window").withColumn(
        "avg_session_duration", F.round("avg_session_duration", 4)
    )


@query("a3_type_counts", "SELECT event_id // 1000 AS batch_id, event_type, count(*) AS events FROM ev GROUP BY 1, 2")
def a3_type_counts(spark, folder):
    return counts_by(numbered_batches(behaviour(spark, folder, with_catalog=False)), ["batch_id"], "event_type")


@query("a3_top_categories", """
SELECT coalesce(category_code, 'unknown') AS category_code, count(*) AS events
FROM ev GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20
""")
def a3_top_categories(spark, folder):
    return top_by_count(behaviour(spark, folder), "category_code", 20)


@query("a4_price_stats", """
SELECT event_id // 1000 AS batch_id, round(avg(price), 6) AS mean, round(stddev_samp(price), 6) AS std,
       min(price) AS min, max(price) AS max, count(price) AS count
FROM ev GROUP BY 1
""")
def a4_price_stats(spark, folder):
    stats = price_stats(numbered_batches(behaviour(spark, folder, with_catalog=False)), ["batch_id"])
    return stats.withColumn("mean", F.round("mean", 6)).withColumn("std", F.round("std", 6))


@query("a7_numeric_baseline", """
SELECT 'price' AS "column", round(avg(price), 6) AS mean, round(stddev_samp(price), 6) AS std, min(price) AS min,
       max(price) AS max, round(quantile_cont(price, 0.05), 6) AS p5, round(quantile_cont(price, 0.25), 6) AS p25,
       round(quantile_cont(price, 0.5), 6) AS p50, round(quantile_cont(price, 0.75), 6) AS p75,
       round(quantile_cont(price, 0.95), 6) AS p95
FROM ev
""")
def a7_numeric_baseline(spark, folder):
    figures = numeric_baseline(behaviour(spark, folder, with_catalog=False))
    return figures.select("column", *[F.round(c, 6).alias(c) for c in figures.columns if c != "column"])


@query("a7_categorical_baseline", """
SELECT 'event_type' AS "column", event_type AS value, round(count(*) / sum(count(*)) OVER (), 9) AS share
FROM ev GROUP BY 2
UNION ALL
(SELECT 'category_code', coalesce(category_code, 'unknown'), round(count(*) / sum(count(*)) OVER (), 9)
 FROM ev GROUP BY 2 ORDER BY count(*) DESC, 2 LIMIT 20)
UNION ALL
(SELECT 'brand', coalesce(brand, 'unknown'), round(count(*) / sum(count(*)) OVER (), 9)
 FROM ev GROUP BY 2 ORDER BY count(*) DESC, 2 LIMIT 20)
""")
def a7_categorical_baseline(spark, folder):
    return categorical_baseline(behaviour(spark, folder)).withColumn("share", F.round("share", 9))


ACTIVITY_SQL = """
SELECT event_id, user_id, ts_ms, count(*) OVER w AS total_events,
       count(*) FILTER (event_type = 'view') OVER w AS views,
       count(*) FILTER (event_type = 'purchase') OVER w AS purchases,
       round(count(*) OVER w / {seconds}, 9) AS events_per_second
FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY ts_ms RANGE BETWEEN {width} PRECEDING AND CURRENT ROW)
"""


def _activity(df):
    count = lambda name: F.coalesce(F.try_element_at("event_type_counts", F.lit(name)), F.lit(0)).cast("long")
    return df.select(
        "event_id", "user_id", "ts_ms", "total_events", count("view").alias("views"),
        count("purchase").alias("purchases"), F.round("events_per_second", 9).alias("events_per_second"),
    )


@query("w1_trailing_minute", ACTIVITY_SQL.format(width=60_000, seconds="60.0"))
def w1_trailing_minute(spark, folder):
    return _activity(trailing_activity(behaviour(spark, folder, with_catalog=False), TYPES))


@query("w1_trailing_half_hour", ACTIVITY_SQL.format(width=1_800_000, seconds="1800.0"))
def w1_trailing_half_hour(spark, folder):
    return _activity(trailing_activity(behaviour(spark, folder, with_catalog=False), TYPES, 1_800_000))


SESSION_SQL = """
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts_ms, event_id) AS n FROM ev
),
walk AS (
  SELECT user_id, n, event_id, ts_ms, ts_ms AS start_time, false AS closes FROM ordered WHERE n = 1
  UNION ALL
  SELECT o.user_id, o.n, o.event_id, o.ts_ms, CASE WHEN w.closes THEN o.ts_ms ELSE w.start_time END,
         NOT w.closes AND o.ts_ms - w.start_time > 1800000
  FROM walk w JOIN ordered o ON o.user_id = w.user_id AND o.n = w.n + 1
),
sessions AS (
  SELECT w.user_id, w.start_time, max(w.ts_ms) AS last_update, max(w.ts_ms) - w.start_time AS duration_ms,
         count(*) AS events_seen, least(count(*), 100) AS event_count,
         count(DISTINCT product_id) AS unique_products, count(DISTINCT category_code) AS unique_categories,
         bool_or(w.closes) AS closed
  FROM walk w JOIN ev USING (event_id) GROUP BY w.user_id, w.start_time
)
"""


def _sessionized(spark, folder):
    """Sessions are cut on the bare events; the category is looked up afterwards."""
    products = catalog(spark, folder).select("product_id", F.col("category_code").alias("category_id"))
    return sessionize(behaviour(spark, folder, with_catalog=False)).join(products, "product_id", "left")


@query("x4_capped_sessions", f"""
WITH RECURSIVE {SESSION_SQL}
SELECT user_id, start_time, last_update, events_seen, unique_products, unique_categories, duration_ms, event_count,
       closed FROM sessions
""")
def x4_capped_sessions(spark, folder):
    return session_summary(_sessionized(spark, folder))


@query("x4_session_of_event", f"WITH RECURSIVE {SESSION_SQL} SELECT event_id, user_id, start_time FROM walk")
def x4_session_of_event(spark, folder):
    events = behaviour(spark, folder, with_catalog=False).select("event_id", "user_id", "ts_ms")
    return sessionize(events).select("event_id", "user_id", "start_time")


@query("t4_session_history", f"""
WITH RECURSIVE {SESSION_SQL}
SELECT user_id, start_time, duration_ms, event_count, CAST(recency AS INTEGER) AS recency FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY start_time DESC) AS recency FROM sessions WHERE closed)
WHERE recency <= 10
""")
def t4_session_history(spark, folder):
    return session_history(session_summary(_sessionized(spark, folder))).select(
        "user_id", "start_time", "duration_ms", "event_count", "recency"
    )


@query("t4_last_session_events", f"""
WITH RECURSIVE {SESSION_SQL}
SELECT event_id, user_id, start_time FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, start_time ORDER BY ts_ms DESC, event_id DESC) AS r FROM walk)
WHERE r <= 100
""")
def t4_last_session_events(spark, folder):
    events = behaviour(spark, folder, with_catalog=False).select("event_id", "user_id", "ts_ms")
    return kept_events(sessionize(events)).select("event_id", "user_id", "start_time")


@query("t4_latest_transactions", """
SELECT user_id, event_id, amount, CAST(recency AS INTEGER) AS recency FROM (
  SELECT user_id, event_id, price AS amount,
         row_number() OVER (PARTITION BY user_id ORDER BY ts_ms DESC, event_id DESC) AS recency
  FROM ev WHERE event_type = 'purchase') WHERE recency <= 100
""")
def t4_latest_transactions(spark, folder):
    return latest_transactions(transactions_of(behaviour(spark, folder))).select(
        "user_id", "event_id", "amount", "recency"
    )


@query("w2_session_snapshot", f"""
WITH RECURSIVE {SESSION_SQL},
recent AS (
  SELECT user_id, start_time, count(*) AS n FROM walk
  WHERE (SELECT max(ts_ms) FROM ev) - ts_ms < 300000 GROUP BY 1, 2
)
SELECT s.user_id, s.start_time, duration_ms AS session_duration_ms, event_count AS total_events,
       coalesce(r.n, 0) AS recent_events, unique_products, unique_categories,
       round(event_count / greatest(duration_ms / 1000.0, 1.0), 9) AS event_frequency
FROM sessions s LEFT JOIN recent r USING (user_id, start_time) WHERE NOT closed
""")
def w2_session_snapshot(spark, folder):
    sessionized = _sessionized(spark, folder)
    snapshot = session_snapshot(
        sessionized, session_summary(sessionized), latest_ms(behaviour(spark, folder, with_catalog=False))
    )
    return snapshot.withColumn("event_frequency", F.round("event_frequency", 9))


@query("t2_popular_products", """
SELECT product_id, count(*) AS score FROM ev WHERE event_type IN ('view', 'purchase')
GROUP BY 1 ORDER BY 2 DESC, 1 DESC LIMIT 20
""")
def t2_popular_products(spark, folder):
    return top_products(product_scores(behaviour(spark, folder, with_catalog=False)), 20)


@query("t2_trending_products", """
SELECT product_id, count(*) AS score FROM ev
WHERE event_type IN ('view', 'purchase') AND ts_ms >= (SELECT max(ts_ms) FROM ev) - 86400000
GROUP BY 1 ORDER BY 2 DESC, 1 DESC LIMIT 20
""")
def t2_trending_products(spark, folder):
    events = behaviour(spark, folder, with_catalog=False)
    return top_products(product_scores(events, latest_ms(events) - TRENDING_MS), 20)


@query("t3_top_brands", """
SELECT coalesce(brand, 'unknown') AS brand, count(*) AS events FROM ev GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10
""")
def t3_top_brands(spark, folder):
    return top_by_count(behaviour(spark, folder), "brand", 10)


@query("x2_closed_windows", f"""
WITH {PROFILES_SQL}
SELECT user_id, window_start_ms, len(viewed) AS viewed, len(bought) AS purchased, last_activity_ms
FROM profiles WHERE window_start_ms + 600000 <= (SELECT max(ts_ms) FROM ev) - 5000
""")
def x2_closed_windows(spark, folder):
    events = behaviour(spark, folder, with_catalog=False)
    watermark = latest_ms(events) - 5000
    return window_profiles(events).where(F.col("window_start_ms") + 600_000 <= watermark).select(
        "user_id", "window_start_ms", F.size("viewed_products").cast("long").alias("viewed"),
        F.size("purchased_products").cast("long").alias("purchased"), "last_activity_ms",
    )


@query("x3_late_classes", f"""
WITH {ARRIVALS_SQL}
SELECT event_id, shard, watermark_ms, delay_seconds, late_class,
       CASE WHEN late_class IN ('moderate', 'very_late') THEN ts_ms - ts_ms % 60000 END AS window_start_ms,
       CASE WHEN late_class IN ('moderate', 'very_late') THEN ts_ms - ts_ms % 60000 + 60000 END AS window_end_ms
FROM classified
""")
def x3_late_classes(spark, folder):
    return classify_late(arrivals(spark, folder)).select(
        "event_id", "shard", "watermark_ms", "delay_seconds", "late_class", "window_start_ms", "window_end_ms"
    )


@query("u1_main_stream", f"""
WITH {ARRIVALS_SQL}
SELECT event_id, late_class, CASE WHEN late_class = 'moderate' THEN 'true' END AS late_processed
FROM classified WHERE late_class IN ('on_time', 'moderate')
""")
def u1_main_stream(spark, folder):
    return main_stream(classify_late(arrivals(spark, folder)), F.col("arrival_ms")).select(
        "event_id", "late_class", F.try_element_at("metadata", F.lit("late_processed")).alias("late_processed")
    )


@query("x5_last_seen", "SELECT user_id, max(ts_ms) AS last_timestamp_ms FROM ev GROUP BY 1")
def x5_last_seen(spark, folder):
    return last_seen(behaviour(spark, folder, with_catalog=False))


@query("x6_list_reuse", f"""
WITH RECURSIVE {PROFILES_SQL},
ordered AS (SELECT user_id, window_start_ms, row_number() OVER (PARTITION BY user_id ORDER BY window_start_ms) AS n
            FROM profiles),
walk AS (
  SELECT user_id, n, window_start_ms, window_start_ms AS generated_at_ms FROM ordered WHERE n = 1
  UNION ALL
  SELECT o.user_id, o.n, o.window_start_ms,
         CASE WHEN o.window_start_ms - w.generated_at_ms < 6 * 3600000 THEN w.generated_at_ms
              ELSE o.window_start_ms END
  FROM walk w JOIN ordered o ON o.user_id = w.user_id AND o.n = w.n + 1
)
SELECT user_id, window_start_ms, generated_at_ms, generated_at_ms <> window_start_ms AS reused FROM walk
""")
def x6_list_reuse(spark, folder):
    # Six hours instead of five minutes: profiles of a user are at least ten minutes apart.
    emitted = window_profiles(behaviour(spark, folder, with_catalog=False)).select("user_id", "window_start_ms", F.col("window_start_ms").alias("_order"))
    kept = with_segment(emitted, ["user_id"], "window_start_ms", "_order", 6 * HOUR_MS, closes=False,
                        start="generated_at_ms")
    return kept.select("user_id", "window_start_ms", "generated_at_ms", (~F.col("opens")).alias("reused"))


@query("r1_profile_routes", f"""
WITH {PROFILES_SQL}
SELECT user_id, window_start_ms,
       CASE WHEN row_number() OVER (PARTITION BY user_id ORDER BY window_start_ms) > 1 OR len(viewed) >= 3
            THEN 'personalized' ELSE 'cold_start' END AS route
FROM profiles
""")
def r1_profile_routes(spark, folder):
    running = running_profiles(window_profiles(behaviour(spark, folder, with_catalog=False)))
    return running.select(
        "user_id", "window_start_ms", route(F.col("session_count"), F.col("viewed_in_window")).alias("route")
    )
