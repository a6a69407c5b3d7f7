"""The runners from end to end: what they wrote is read back and checked."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import prepare_streaming, shared_folder
from ..sources.files import move_into, parse_json_events, stream_json_files
from ..sources.sinks import write_batch_csv
from ..sources.tables import EVENT_COLUMNS, behaviour
from ..streaming.runners import MONITORED, start_clean_csv, start_drift_monitor, start_json_files, start_table
from .inputs import FAULTY_SQL, faulty_rows
from .monitor_queries import BASE_SQL, _baseline
from .registry import query
from .stream_queries import PARTITIONS, _stream

# Everything that is new makes one micro-batch, so that it is known what a micro-batch holds.
ALL_FILES = {"maxFilesPerTrigger": str(2**31 - 1)}
WEEKS = 5


@query("d8_stream_monitor", f"""
WITH {BASE_SQL.replace("event_id // 1000 AS batch_id", "(dayofmonth(ts) - 1) // 7 AS batch_id")},
marks AS (SELECT batch_id, min(price) AS min, max(price) AS max, max(ts_ms) AS last_event,
                 round(avg(price), 6) AS mean, round(stddev_samp(price), 6) AS std,
                 count(*) FILTER (epoch_us(ts) < ((SELECT max(ts_ms) FROM ev) - 3600000) * 1000) AS late_events FROM batches GROUP BY 1),
types AS (SELECT batch_id, string_agg(event_type || ' ' || n, ',' ORDER BY event_type) AS event_types
          FROM (SELECT batch_id, event_type, count(*) AS n FROM batches GROUP BY 1, 2) GROUP BY 1)
SELECT batch_id, batch_size, round(drift_score, 8) AS drift_score,
       CASE WHEN drift_score > 0.2 THEN 'high' WHEN drift_score > 0.1 THEN 'moderate'
            WHEN drift_score IS NOT NULL THEN 'none' END AS level,
       CAST(sum(batch_size) OVER (ORDER BY batch_id) AS BIGINT) AS processed_total, late_events, mean, std, min, max, last_event,
       event_types
FROM totals JOIN marks USING (batch_id) JOIN types USING (batch_id)
""")
def d8_stream_monitor(spark, folder):
    """The monitor over the weeks of the month: each is a micro-batch of its own run, which goes on from the one before.

    One job reads and joins the events and writes the weeks, which also give the baseline of categories; they are then put before the
    stream.
    """
    prepare_streaming(spark)
    base = shared_folder(spark, "drift-monitor")
    events = behaviour(spark, folder).select(*MONITORED)
    week = F.floor((F.dayofmonth("event_time") - 1) / 7).cast("int")
    events.withColumn("week", week).where("week IS NOT NULL").write.partitionBy("week").parquet(f"{base}/weeks")
    written = spark.read.schema(events.schema).parquet(f"{base}/weeks")
    now = F.timestamp_millis(F.lit(written.select(F.max(F.unix_millis("event_time"))).first()[0]))
    numeric, categorical = _baseline(spark, folder, events=written.select(*MONITORED))
    for i in range(WEEKS):
        if not move_into(spark, f"{base}/weeks/week={i}", f"{base}/events/{i}"):
            spark.createDataFrame([], events.schema).write.parquet(f"{base}/events/{i}")  # a micro-batch without rows
        stream = spark.readStream.schema(events.schema).options(**ALL_FILES).parquet(f"{base}/events/*")
        start_drift_monitor(
            stream, numeric, categorical, f"{base}/history", f"{base}/checkpoint", now=now, partitions=PARTITIONS,
        ).awaitTermination()
    history = spark.read.option("basePath", f"{base}/history").parquet(f"{base}/history")
    types = F.transform(F.sort_array("event_types"), lambda t: F.concat_ws(" ", t["value"], t["events"].cast("string")))
    return history.select(
        F.col("batch_id").cast("long").alias("batch_id"), "batch_size", F.round("drift_score", 8).alias("drift_score"), "level",
        "processed_total", "late_events", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"), "min", "max",
        F.unix_millis("last_event").alias("last_event"), F.array_join(types, ",").alias("event_types"))


@query("s9_failing_sink", f"""
WITH {FAULTY_SQL}
SELECT event_id AS event_number, event_type, event_id % 3 AS part, [3, 5, 1][event_id % 3 + 1] AS attempts,
       error IS NULL AND event_id % 3 <> 1 AS clean, CASE WHEN error IS NULL AND event_id % 3 = 1 THEN 'sink_failure: disk full'
                                                          ELSE error END AS error
FROM raw
""")
def s9_failing_sink(spark, folder):
    """Three micro-batches of CSV rows: one is written at the third attempt, one never, one at once.

    The rows of the second one end among the dead letters, and the stream goes on with the third.
    """
    prepare_streaming(spark)
    base = shared_folder(spark, "failing-sink")
    rows = faulty_rows(spark, folder).withColumn("product_id", F.col("event_id").cast("string"))
    failures, tried = {0: 2, 1: 99, 2: 0}, {}

    def sink(df, path, batch_id):
        tried[batch_id] = tried.get(batch_id, 0) + 1
        if tried[batch_id] <= failures[batch_id]:
            raise OSError("disk full")
        write_batch_csv(df, path, batch_id)

    for part in failures:
        rows.where(F.pmod("event_id", F.lit(3)) == part).select(*EVENT_COLUMNS).write.mode("append").option(
            "header", "true").option("escape", '"').csv(f"{base}/source")
        start_clean_csv(
            spark, f"{base}/source", f"{base}/clean", f"{base}/rejected", f"{base}/checkpoint", per_trigger=ALL_FILES,
            write_clean=sink, retry={"sleep": lambda seconds: None}).awaitTermination()
    read = lambda name, extra: spark.read.schema(
        ", ".join(f"{c} string" for c in [*EVENT_COLUMNS, *extra, "batch_id"])).option("header", "true").option(
        "escape", '"').option("basePath", f"{base}/{name}").csv(f"{base}/{name}")
    both = read("clean", []).withColumn("error", F.lit(None).cast("string")).unionByName(read("rejected", ["error"]))
    attempts = F.create_map(*[F.lit(x) for pair in sorted(tried.items()) for x in pair])
    part = F.col("batch_id").cast("int")
    return both.select(
        F.col("product_id").cast("long").alias("event_number"), "event_type", part.cast("long").alias("part"),
        F.try_element_at(attempts, part).alias("attempts"), F.col("error").isNull().alias("clean"), "error")


@query("s4_json_through_streams", """
SELECT strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS event_time, event_type, product_id, price, user_id FROM ev
""")
def s4_json_through_streams(spark, folder):
    """Events as lines of JSON written by one stream (S4), read and parsed by another."""
    base = shared_folder(spark, "json-lines")
    events = _stream(spark, folder).select(
        F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("event_time"), "event_type", "product_id", "price", "user_id")
    start_json_files(events, f"{base}/lines", f"{base}/written").awaitTermination()
    parsed = parse_json_events(stream_json_files(spark, f"{base}/lines/*")).where(F.col("event").isNotNull())
    names = ["event_time", "event_type", "product_id", "price", "user_id"]
    start_table(parsed.select(*[f"event.{c}" for c in names]), f"{base}/rows", f"{base}/read").awaitTermination()
    return spark.read.parquet(f"{base}/rows").select(*names)
