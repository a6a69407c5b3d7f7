"""Windowed user profiles and their merge over time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

VIEW, PURCHASE = "view", "purchase"
ENOUGH_VIEWED = 3
PROFILE_LIMIT = 20


def _set_of(condition: Column, column: str) -> Column:
    return F.array_sort(F.collect_set(F.when(condition, F.col(column))))


def window_profiles(events: DataFrame, minutes: int = 10) -> DataFrame:
    """A1: profile per user and tumbling window; the same call serves a stream with a watermark."""
    if "category_code" not in events.columns:
        events = events.withColumn("category_code", F.lit(None).cast("string"))
    viewed, bought = F.col("event_type") == VIEW, F.col("event_type") == PURCHASE
    has_category = F.col("category_code").isNotNull() & (F.col("category_code") != "")
    return (
        events.groupBy("user_id", F.window("event_time", f"{minutes} minutes").alias("_window"))
        .agg(
            _set_of(viewed, "product_id").alias("viewed_products"),
            _set_of(bought, "product_id").alias("purchased_products"),
            _set_of((viewed | bought) & has_category, "category_code").alias("categories_preferred"),
            F.min("ts_ms").alias("_first"),
            F.max("ts_ms").alias("last_activity_ms"),
        )
        .select(
            "user_id", F.unix_millis("_window.start").alias("window_start_ms"),
            "viewed_products", "purchased_products", "categories_preferred", "last_activity_ms",
            F.lit(1).cast("long").alias("session_count"),
            (F.col("last_activity_ms") - F.col("_first")).cast("double").alias("avg_session_duration"),
        )
    )


# Kinds of remembered items and the profile column that lists them.
ITEM_COLUMNS = {
    "viewed": "viewed_products",
    "purchased": "purchased_products",
    "category": "categories_preferred",
}


def _listed_as(kind: str):
    return lambda item: F.struct(F.lit(kind).alias("kind"), item.alias("item"))


def profile_items(profiles: DataFrame, *kept: str) -> DataFrame:
    """One row per profile, kind and item, and a row of kind "profile" where ``kept`` columns are carried along."""
    listed = [F.transform(F.col(column), _listed_as(kind)) for kind, column in ITEM_COLUMNS.items()]
    if kept:
        itself = F.struct(F.lit("profile").alias("kind"), F.lit(None).cast("string").alias("item"))
        listed.insert(0, F.array(itself))
    return profiles.select("user_id", "window_start_ms", *kept, F.inline(F.concat(*listed)))


def merged_profiles(profiles: DataFrame) -> DataFrame:
    """A2 over all windows: one profile per user, in one grouping of items and profiles."""
    items = profile_items(profiles, "last_activity_ms", "avg_session_duration")
    own = F.col("kind") == "profile"
    return items.groupBy("user_id").agg(
        *[_set_of(F.col("kind") == kind, "item").alias(column) for kind, column in ITEM_COLUMNS.items()],
        F.max("last_activity_ms").alias("last_activity_ms"),
        F.count_if(own).alias("session_count"),
        F.avg(F.when(own, F.col("avg_session_duration"))).alias("avg_session_duration"),
    )


def running_profiles(profiles: DataFrame) -> DataFrame:
    """A2 at every window: the merged figures so far, with set sizes instead of the sets.

    An item counts at the window that shows it first, so sizes are running sums and no set grows along
    the windows. A user has at most one row per window, whatever the number of events.
    """
    first_seen = profile_items(profiles).groupBy("user_id", "kind", "item").agg(
        F.min("window_start_ms").alias("window_start_ms")
    )
    added = first_seen.groupBy("user_id", "window_start_ms").agg(
        *[F.count_if(F.col("kind") == kind).alias(f"_{kind}") for kind in ITEM_COLUMNS]
    )
    so_far = (
        Window.partitionBy("user_id").orderBy("window_start_ms")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return profiles.join(added, ["user_id", "window_start_ms"], "left").select(
        "user_id", "window_start_ms",
        *[F.coalesce(F.sum(f"_{kind}").over(so_far), F.lit(0)).alias(f"{kind}_items") for kind in ITEM_COLUMNS],
        F.size("viewed_products").alias("viewed_in_window"),
        F.max("last_activity_ms").over(so_far).alias("last_activity_ms"),
        F.count("*").over(so_far).alias("session_count"),
        F.avg("avg_session_duration").over(so_far).alias("avg_session_duration"),
    )


def route(session_count: Column, viewed: Column) -> Column:
    """How a profile gets its recommendations."""
    return F.when((session_count > 1) | (viewed >= ENOUGH_VIEWED), F.lit("personalized")).otherwise(
        F.lit("cold_start")
    )
