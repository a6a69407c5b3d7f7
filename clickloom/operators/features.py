"""User and product features with lifetimes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import ratio
from .ordered import top_rows

KEPT_TRANSACTIONS = 100
RECENT_MS = 3_600_000
USER_FEATURES_MS = 5 * 60 * 1000
PRODUCT_FEATURES_MS = 60 * 60 * 1000

# Features of a product nobody knows.
PRODUCT_DEFAULTS = {
    "price": 99.99,
    "category_id": 1,
    "popularity_score": 0.85,
    "rating": 4.5,
    "click_rate": 0.12,
}

# Features of a user without transactions.
USER_DEFAULTS = {
    "avg_transaction_amount": 0.0,
    "total_transactions": 0,
    "recent_transaction_count": 0,
    "transaction_velocity": 0.0,
    "preferred_category": "unknown",
    "session_duration_avg": 0,
    "days_since_last_purchase": 999.0,
}
KNOWN_USER_SESSION_SECONDS = 300


def transactions_of(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_type") == "purchase").select(
        "user_id", "ts_ms", "event_id", F.col("price").alias("amount"), F.col("category_code").alias("category"),
        "product_id",
    )


def latest_transactions(transactions: DataFrame, kept: int = KEPT_TRANSACTIONS) -> DataFrame:
    """T4: newest first, cut per map task before the shuffle."""
    return top_rows(transactions, ["user_id"], [F.desc("ts_ms"), F.desc("event_id")], kept, "recency")


def user_features(transactions: DataFrame, now_ms: Column) -> DataFrame:
    """A5/A6 for users with transactions. All steps share one shuffle by user."""
    return features_of_latest(latest_transactions(transactions), now_ms)


def features_of_latest(latest: DataFrame, now_ms: Column) -> DataFrame:
    named = latest.withColumn("category", F.coalesce("category", F.lit("unknown")))
    per_category = named.groupBy("user_id", "category").agg(
        F.sum("amount").alias("_sum"), F.count("*").alias("_n"), F.min("recency").alias("_first"),
        F.count_if(now_ms - F.col("ts_ms") < RECENT_MS).alias("_recent"), F.max("ts_ms").alias("_last"),
    )
    # The most frequent category; among equals the one met first in the list, which is newest first.
    preferred = F.max_by("category", F.col("_n") * (KEPT_TRANSACTIONS + 1) - F.col("_first"))
    total, recent = F.sum("_n"), F.sum("_recent")
    return per_category.groupBy("user_id").agg(
        (F.sum("_sum") / total).alias("avg_transaction_amount"),
        total.alias("total_transactions"),
        recent.alias("recent_transaction_count"),
        (recent / 3600.0).alias("transaction_velocity"),
        preferred.alias("preferred_category"),
        F.lit(KNOWN_USER_SESSION_SECONDS).cast("long").alias("session_duration_avg"),
        ((F.max(now_ms) - F.max("_last")) / 86_400_000.0).alias("days_since_last_purchase"),
    )


def with_user_defaults(features: DataFrame) -> DataFrame:
    types = dict(features.dtypes)
    return features.select(*[
        F.coalesce(c, F.lit(USER_DEFAULTS[c]).cast(types[c])).alias(c) if c in USER_DEFAULTS else F.col(c)
        for c in features.columns
    ])


def lookup_user_features(
    users: DataFrame, stored: DataFrame, transactions: DataFrame, now_ms: Column, ttl_ms: int = USER_FEATURES_MS
) -> DataFrame:
    """Stored features younger than the lifetime, else fresh ones; ``hit`` tells which.

    The rows with ``hit`` false are what a caller writes back to the feature table.
    """
    usable = stored.where(F.col("computed_at_ms") > now_ms - ttl_ms)
    hits = users.join(usable, "user_id").withColumn("hit", F.lit(True))
    missing = users.join(usable, "user_id", "left_anti")
    # The cut to the latest transactions comes first, so no user brings more than those to the join.
    latest = latest_transactions(transactions).join(missing, "user_id", "left_semi")
    fresh = features_of_latest(latest, now_ms)
    misses = with_user_defaults(missing.join(fresh, "user_id", "left")).withColumn(
        "computed_at_ms", now_ms
    ).withColumn("hit", F.lit(False))
    return hits.unionByName(misses)


def upsert_features(stored: DataFrame, fresh: DataFrame, key: str = "user_id") -> DataFrame:
    """The feature table after ``fresh`` rows took the place of older ones."""
    return stored.join(fresh, key, "left_anti").unionByName(fresh.select(*stored.columns))


def lookup_product_features(
    requests: DataFrame, stored: DataFrame, now_ms: Column, ttl_ms: int = PRODUCT_FEATURES_MS
) -> DataFrame:
    """Stored product features while they live, the fixed ones otherwise."""
    usable = stored.where(F.col("computed_at_ms") > now_ms - ttl_ms).drop("computed_at_ms")
    joined = requests.join(usable.withColumn("hit", F.lit(True)), "product_id", "left")
    types = dict(joined.dtypes)
    return joined.select(
        *requests.columns,
        *[F.coalesce(c, F.lit(v).cast(types[c])).alias(c) for c, v in PRODUCT_DEFAULTS.items()],
        F.coalesce("hit", F.lit(False)).alias("hit"),
    )


def hit_ratio(lookups: DataFrame, hit: str = "hit") -> DataFrame:
    """A11"""
    return lookups.agg(
        F.count_if(F.col(hit)).alias("hits"), F.count_if(~F.col(hit)).alias("misses")
    ).withColumn("hit_ratio", ratio(F.col("hits"), F.col("hits") + F.col("misses")))
