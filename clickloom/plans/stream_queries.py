"""Queries that run a stream over the event table to its end and return what the sink holds (2.7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.keys import pair_score
from ..operators.activity import last_seen
from ..operators.late import DISCARDED, MODERATE, ON_TIME, VERY_LATE
from ..operators.ordered import DAY_MS, HOUR_MS
from ..operators.scoring import PAIR
from ..session import prepare_streaming, shared_folder
from ..sources.files import age_in_order, stream_events
from ..sources.tables import EVENT_COLUMNS, SCHEMAS, as_behaviour, catalog, table, with_products
from ..streaming.processors import (
    ACTIVITY_OUTPUT, LATE_OUTPUT, PROFILE_OUTPUT, SCORE_OUTPUT, SESSION_OUTPUT, CachedScores, CappedSessions,
    LateClasses, MergedProfiles, TrailingActivity, keyed,
)
from ..streaming.runners import profile_stream, run_restarting, start_clean_csv, start_split, start_table
from .aggregate_queries import ACTIVITY_SQL, PROFILES_SQL, SESSION_SQL, _activity
from .inputs import ARRIVALS_SQL, FAULTY_SQL, arrivals, faulty_rows
from .recommend_queries import CACHE_WALK_SQL, ENTRY_WALK_SQL, PAIR_SCORE_SQL
from .registry import query


FILES = 4  # at least
# Of values in a file, which bounds what a micro-batch and so a hot key brings to one task. Every micro-batch visits the state of the
# users who come in it, so small ones cost more than the rows do.
FILE_BYTES = 256 * 1024 * 1024
SPLIT_BYTES = 4 * 1024 * 1024  # of a row group, so that many tasks read a file
PARTITIONS = 24  # of a micro-batch, at most: each starts Python and commits its state, which is a second for about 10 MB of rows
ONE_FILE = {"maxFilesPerTrigger": "1"}


def _value_bytes(rows):
    def size(name, kind):
        known = F.octet_length(name) if kind in ("string", "binary") else F.size(name) * 16 if kind.startswith("array") else F.lit(8)
        return F.coalesce(known, F.lit(0))

    sizes = [size(c, kind) for c, kind in rows.dtypes]
    return rows.agg(F.sum(sum(sizes, F.lit(0).cast("long")))).first()[0] or 0


def _in_files(spark, rows, order, purpose):
    """Rows as a folder of files by ``order``, each shuffled inside; a stream takes one per micro-batch.

    The number of files follows from the bytes of the rows. One job writes a file for each range of about one size; equal times
    are cut by their id, so no time can fill a file; rows without a time come first.
    """
    files = max(FILES, -(-_value_bytes(rows) // FILE_BYTES))
    path = shared_folder(spark, purpose)
    ranges = rows.repartitionByRange(files, order, "event_id").sortWithinPartitions(F.xxhash64("event_id"))
    ranges.write.option("parquet.block.size", str(SPLIT_BYTES)).parquet(path)
    age_in_order(spark, path)
    return path


def _stream(spark, folder, with_catalog=False):
    """The event table in several files as a stream of behaviour events, with catalog columns if asked for."""
    prepare_streaming(spark)
    rows = table(spark, folder, "events").withColumn("_ms", F.unix_millis(F.col("ts").cast("timestamp")))
    path = _in_files(spark, rows, "_ms", "event-files")
    events = as_behaviour(stream_events(spark, path, SCHEMAS["events"], ONE_FILE))
    return with_products(events, catalog(spark, folder)) if with_catalog else events


def _finished(spark, stream, name, start=start_table, **options):
    base = shared_folder(spark, name)
    start(stream, f"{base}/rows", f"{base}/checkpoint", **{"partitions": PARTITIONS, **options}).awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/rows").select(*stream.columns)


@query("x2_stream_windows", f"""
WITH {PROFILES_SQL}
SELECT user_id, window_start_ms, len(viewed) AS viewed, len(bought) AS purchased, array_to_string(liked, ',') AS categories,
       last_activity_ms
FROM profiles WHERE window_start_ms + 600000 <= (SELECT max(ts_ms) FROM ev) - 5000
""")
def x2_stream_windows(spark, folder):
    return _finished(spark, profile_stream(_stream(spark, folder, with_catalog=True)), "windows").select(
        "user_id", "window_start_ms", F.size("viewed_products").cast("long").alias("viewed"),
        F.size("purchased_products").cast("long").alias("purchased"),
        F.array_join(F.array_sort("categories_preferred"), ",").alias("categories"), "last_activity_ms",
    )


@query("x3_stream_late_classes", f"""
WITH {ARRIVALS_SQL}
SELECT event_id, shard, watermark_ms, delay_seconds, late_class FROM classified
""")
def x3_stream_late_classes(spark, folder):
    prepare_streaming(spark)
    rows = arrivals(spark, folder).select("event_id", "ts_ms", "arrival_ms", "shard")
    path = _in_files(spark, rows, "arrival_ms", "arrivals")
    arrived = stream_events(spark, path, rows.schema, ONE_FILE)
    classified = keyed(arrived, "shard", LateClasses(), LATE_OUTPUT)
    base = shared_folder(spark, "late")
    classes = (ON_TIME, MODERATE, VERY_LATE, DISCARDED)
    start_split(classified, f"{base}/rows", f"{base}/checkpoint", classes, partitions=PARTITIONS).awaitTermination()
    parts = [spark.read.schema(classified.schema).parquet(f"{base}/rows/{name}") for name in classes]
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    return merged.select("event_id", "shard", "watermark_ms", "delay_seconds", "late_class")


@query("x4_stream_sessions", f"""
WITH RECURSIVE {SESSION_SQL}
SELECT user_id, start_time, last_update, duration_ms, event_count, unique_products, unique_categories
FROM sessions WHERE closed
""")
def x4_stream_sessions(spark, folder):
    events = _stream(spark, folder, with_catalog=True).select(
        "event_id", "user_id", "ts_ms", "product_id", F.col("category_code").alias("category_id")
    )
    closed = keyed(events, "user_id", CappedSessions(), SESSION_OUTPUT)
    return _finished(spark, closed, "sessions").select(
        "user_id", "start_time", "last_update", "duration_ms", "event_count", "unique_products", "unique_categories"
    )


@query("w1_stream_activity", ACTIVITY_SQL.format(width=60_000, seconds="60.0"))
def w1_stream_activity(spark, folder):
    events = _stream(spark, folder).select("event_id", "user_id", "ts_ms", "event_type")
    return _activity(_finished(spark, keyed(events, "user_id", TrailingActivity(), ACTIVITY_OUTPUT), "activity"))


@query("x6_stream_profiles", f"""
WITH RECURSIVE {PROFILES_SQL},
complete AS (SELECT * FROM profiles WHERE window_start_ms + 600000 <= (SELECT max(ts_ms) FROM ev) - 5000),
ordered AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY window_start_ms) AS n FROM complete),
walk AS (
  SELECT user_id, n, window_start_ms, window_start_ms AS generated_at_ms, CAST(1 AS BIGINT) AS session_count
  FROM ordered WHERE n = 1
  UNION ALL
  SELECT o.user_id, o.n, o.window_start_ms,
         CASE WHEN o.window_start_ms - w.generated_at_ms < 6 * 3600000 THEN w.generated_at_ms
              ELSE o.window_start_ms END,
         w.session_count + CASE WHEN o.window_start_ms - w.generated_at_ms < 6 * 3600000 THEN 0 ELSE 1 END
  FROM walk w JOIN ordered o ON o.user_id = w.user_id AND o.n = w.n + 1
)
SELECT user_id, window_start_ms, generated_at_ms, generated_at_ms <> window_start_ms AS reused, session_count FROM walk
""")
def x6_stream_profiles(spark, folder):
    # Two queries in a row: closed windows first, then the keyed profiles over that table. A micro-batch of the first one writes the
    # windows of a user in several files in no order, so they are put in the order of time before the second one takes them.
    windows = _finished(spark, profile_stream(_stream(spark, folder, with_catalog=True)), "profile-windows")
    rows = windows.withColumn("event_id", F.xxhash64("user_id", "window_start_ms"))
    path = _in_files(spark, rows, "window_start_ms", "ordered-windows")
    merged = keyed(stream_events(spark, path, rows.schema, ONE_FILE), "user_id", MergedProfiles(6 * HOUR_MS), PROFILE_OUTPUT)
    return _finished(spark, merged.select("user_id", "window_start_ms", "generated_at_ms", "reused", "session_count"), "profiles")


@query("r5_stream_scores", f"""
WITH RECURSIVE {CACHE_WALK_SQL}
SELECT event_id, user_id, product_id, cached_at_ms, NOT opens AS cached, {PAIR_SCORE_SQL} AS score FROM walk
""")
def r5_stream_scores(spark, folder):
    requests = _stream(spark, folder).select(
        "event_id", "user_id", "product_id", "ts_ms",
        pair_score(F.col("user_id"), F.col("product_id")).alias("score"),
    )
    return _finished(spark, keyed(requests, PAIR, CachedScores(7 * DAY_MS), SCORE_OUTPUT), "scores")


@query("r5_stream_stored_scores", f"""
WITH RECURSIVE asked AS (
  SELECT event_id, user_id, CASE WHEN event_id % 11 <> 0 THEN product_id END AS product_id, ts_ms, price,
         CASE WHEN event_type <> 'error' THEN price END AS own FROM ev),
answered AS (WITH RECURSIVE {ENTRY_WALK_SQL})
SELECT event_id, product_id, cached_at_ms, cached, CASE WHEN NOT failed THEN score END AS score FROM answered
""")
def r5_stream_stored_scores(spark, folder):
    requests = _stream(spark, folder).select(
        "event_id", "user_id", F.when(F.pmod("event_id", F.lit(11)) != 0, F.col("product_id")).alias("product_id"),
        "ts_ms", F.when(F.col("event_type") != "error", F.col("price")).alias("score"),
    )
    return _finished(spark, keyed(requests, PAIR, CachedScores(7 * DAY_MS), SCORE_OUTPUT), "stored-scores").select(
        "event_id", "product_id", "cached_at_ms", "cached", "score")


@query("x5_stream_last_seen", "SELECT user_id, max(ts_ms) AS last_timestamp_ms FROM ev GROUP BY 1")
def x5_stream_last_seen(spark, folder):
    # Update mode: every micro-batch writes the users it touched; the newest row of a user is the state.
    base = shared_folder(spark, "last-seen")
    start_table(
        last_seen(_stream(spark, folder)), f"{base}/rows", f"{base}/checkpoint", mode="update", partitions=PARTITIONS,
    ).awaitTermination()
    rows = spark.read.schema("user_id string, last_timestamp_ms long, batch_id long").parquet(f"{base}/rows")
    return rows.groupBy("user_id").agg(F.max_by("last_timestamp_ms", "batch_id").alias("last_timestamp_ms"))


@query("s5_clean_stream", f"""
WITH {FAULTY_SQL}
SELECT event_id AS event_number, event_type, user_id, error IS NULL AS clean, error FROM raw
""")
def s5_clean_stream(spark, folder):
    """CSV files through the runner, stopped after some files, resumed, and both sinks read back."""
    prepare_streaming(spark)
    base = shared_folder(spark, "clean-stream")
    rows = faulty_rows(spark, folder).withColumn("product_id", F.col("event_id").cast("string"))
    write = lambda part: rows.where(F.pmod("event_id", F.lit(4)) == part).select(*EVENT_COLUMNS).write.mode(
        "append").option("header", "true").option("escape", '"').csv(f"{base}/source")
    start = lambda: start_clean_csv(
        spark, f"{base}/source", f"{base}/clean", f"{base}/rejected", f"{base}/checkpoint", per_trigger=ONE_FILE)
    for parts in ((0, 1), (2, 3)):  # the second run goes on where the first one ended
        for part in parts:
            write(part)
        run_restarting(start)
    read = lambda name, extra: spark.read.schema(
        ", ".join(f"{c} string" for c in [*EVENT_COLUMNS, *extra])).option("header", "true").option("escape", '"').csv(
        f"{base}/{name}/batch_id=*")
    clean = read("clean", []).withColumn("error", F.lit(None).cast("string"))
    both = clean.unionByName(read("rejected", ["error"]))
    return both.select(
        F.col("product_id").cast("long").alias("event_number"), "event_type", F.coalesce("user_id", F.lit("")).alias("user_id"),
        F.col("error").isNull().alias("clean"), "error")
