"""Sessions with a start-anchored cap (X4), their snapshot (W2) and the kept tails (T4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .anchored import with_segment
from .ordered import top_rows

CAP_MS = 30 * 60 * 1000
KEPT_EVENTS = 100
KEPT_SESSIONS = 10
RECENT_MS = 5 * 60 * 1000


def sessionize(events: DataFrame, cap_ms: int = CAP_MS) -> DataFrame:
    """Add ``start_time`` to events with user_id, ts_ms and event_id.

    The event that makes a session longer than the cap is its last one; there is no gap rule.
    """
    return with_segment(events, ["user_id"], "ts_ms", "event_id", cap_ms, closes=True, start="start_time")


def session_summary(sessionized: DataFrame, cap_ms: int = CAP_MS, kept_events: int = KEPT_EVENTS) -> DataFrame:
    """One row per session. Distinct counts go through a grouping by item first, so no set is built."""
    keys = ["user_id", "start_time"]
    item = lambda kind, value: F.struct(F.lit(kind).alias("kind"), value.cast("string").alias("item"))
    items = sessionized.select(
        *keys, "ts_ms",
        F.inline(F.array(
            item("event", F.lit(None)), item("product", F.col("product_id")), item("category", F.col("category_id"))
        )),
    )
    per_item = items.groupBy(*keys, "kind", "item").agg(F.count("*").alias("n"), F.max("ts_ms").alias("last"))
    named = F.col("item").isNotNull()
    return (
        per_item.groupBy(*keys).agg(
            F.max("last").alias("last_update"),
            F.sum(F.when(F.col("kind") == "event", F.col("n"))).alias("events_seen"),
            F.count_if((F.col("kind") == "product") & named).alias("unique_products"),
            F.count_if((F.col("kind") == "category") & named).alias("unique_categories"),
        )
        .withColumn("duration_ms", F.col("last_update") - F.col("start_time"))
        .withColumn("event_count", F.least(F.col("events_seen"), F.lit(kept_events).cast("long")))
        .withColumn("closed", F.col("duration_ms") > cap_ms)
    )


def session_history(summary: DataFrame, kept: int = KEPT_SESSIONS) -> DataFrame:
    """T4: the last closed sessions per user by start."""
    return top_rows(summary.where("closed"), ["user_id"], [F.desc("start_time")], kept, "recency")


def kept_events(sessionized: DataFrame, kept: int = KEPT_EVENTS) -> DataFrame:
    """T4: the last events of every session."""
    return top_rows(
        sessionized, ["user_id", "start_time"], [F.desc("ts_ms"), F.desc("event_id")], kept, "recency"
    )


def session_snapshot(sessionized: DataFrame, summary: DataFrame, now_ms: Column) -> DataFrame:
    """Features of the session a user has open; users without one have no row."""
    opened = summary.where(~F.col("closed"))
    recent = (
        kept_events(sessionized).where(now_ms - F.col("ts_ms") < RECENT_MS)
        .groupBy("user_id", "start_time").agg(F.count("*").alias("recent_events"))
    )
    seconds = F.greatest(F.col("duration_ms") / 1000.0, F.lit(1.0))
    return opened.join(recent, ["user_id", "start_time"], "left").select(
        "user_id", "start_time",
        F.col("duration_ms").alias("session_duration_ms"),
        F.col("event_count").alias("total_events"),
        F.coalesce("recent_events", F.lit(0)).cast("long").alias("recent_events"),
        "unique_products", "unique_categories",
        (F.col("event_count") / seconds).alias("event_frequency"),
    )
