"""Counts and price figures per batch (A3, A4), trailing activity (W1), last timestamps (X5), top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .intake import unknown_if_null
from .ordered import top_rows, trailing_sums


def trailing_activity(events: DataFrame, event_types: Sequence[str], width_ms: int = 60_000) -> DataFrame:
    """Events of the user in the trailing frame at each event, by type and per second."""
    counts = {"total_events": F.lit(1).cast("long")}
    for name in event_types:
        counts[f"_is_{name}"] = (F.col("event_type") == name).cast("long")
    summed = trailing_sums(events, ["user_id"], "ts_ms", counts, width_ms)
    entries = F.array(*[
        F.struct(F.lit(name).alias("key"), F.col(f"_is_{name}").alias("value")) for name in event_types
    ])
    return (
        summed.withColumn(
            "event_type_counts", F.map_from_entries(F.filter(entries, lambda e: e["value"] > 0))
        )
        .withColumn("events_per_second", F.col("total_events") / (width_ms / 1000.0))
        .drop(*[f"_is_{name}" for name in event_types])
    )


def last_seen(events: DataFrame) -> DataFrame:
    """The largest timestamp per user; in update mode on a stream."""
    return events.groupBy("user_id").agg(F.max("ts_ms").alias("last_timestamp_ms"))


def counts_by(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """A3: rows per value; null values are left out."""
    return df.where(F.col(column).isNotNull()).groupBy(*keys, column).agg(F.count("*").alias("events"))


def top_by_count(
    df: DataFrame, column: str, limit: int = 20, fill_unknown: bool = True, keys: Sequence[str] = (),
) -> DataFrame:
    """The most frequent values, of all rows or of every batch, the name as tie-break."""
    named = df.select(*keys, (unknown_if_null(column) if fill_unknown else F.col(column)).alias(column))
    counted = named.groupBy(*keys, column).agg(F.count("*").alias("events"))
    if keys:
        return top_rows(counted, keys, [F.desc("events"), F.asc(column)], limit).drop("rank")
    return counted.orderBy(F.desc("events"), F.asc(column)).limit(limit)


def price_stats(df: DataFrame, keys: Sequence[str] = (), price: str = "price") -> DataFrame:
    """A4 over the prices that are numbers."""
    return df.groupBy(*keys).agg(*price_figures(price))


def known_number(column: str) -> Column:
    """The number, or null where there is none: NaN counts as missing."""
    return F.when(~F.isnan(column), F.col(column))


def price_figures(price: str) -> list[Column]:
    """A4: mean, deviation, bounds and count of the known prices."""
    value = known_number(price)
    return [
        F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"), F.max(value).alias("max"), F.count(value).alias("count"),
    ]


def product_scores(events: DataFrame, since_ms: Column | None = None) -> DataFrame:
    """Views and purchases per product, all or from ``since_ms`` on."""
    counted = events.where(F.col("event_type").isin("view", "purchase") & F.col("product_id").isNotNull())
    if since_ms is not None:
        # On the timestamp itself, so that the filter reaches the scan.
        recent = F.col("event_time") >= F.timestamp_millis(since_ms) if "event_time" in events.columns else (
            F.col("ts_ms") >= since_ms)
        counted = counted.where(recent)
    return counted.groupBy("product_id").agg(F.count("*").alias("score"))


def top_products(scores: DataFrame, limit: int) -> DataFrame:
    """Products by score; equal scores by id, largest first, as a sorted set read in reverse gives them."""
    return scores.orderBy(F.desc("score"), F.desc("product_id")).limit(limit)
