"""Late data: four classes by distance to the watermark (X3), late metadata (P8), main stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.times import window_floor
from .intake import moderate_metadata, very_late_metadata
from .ordered import HOUR_MS, block_start, running

ON_TIME, MODERATE, VERY_LATE, DISCARDED = "on_time", "moderate", "very_late", "discarded"
LATE_WINDOW_MS = 60_000


def late_class(delay_ms: Column, allowed_seconds: int, max_seconds: int) -> Column:
    return (
        F.when(delay_ms.isNull() | (delay_ms < 0), F.lit(ON_TIME))
        .when(delay_ms <= allowed_seconds * 1000, F.lit(MODERATE))
        .when(delay_ms <= max_seconds * 1000, F.lit(VERY_LATE))
        .otherwise(F.lit(DISCARDED))
    )


def with_late_columns(df: DataFrame, allowed_seconds: int = 300, max_seconds: int = 1800) -> DataFrame:
    """Class, delay and window bounds from ``watermark_ms``; it is null before the first event."""
    delay = F.col("watermark_ms") - F.col("ts_ms")
    start = window_floor(F.col("ts_ms"), LATE_WINDOW_MS)
    bounded = F.col("late_class").isin(MODERATE, VERY_LATE)
    return (
        df.withColumn("delay_seconds", delay / 1000.0)
        .withColumn("late_class", late_class(delay, allowed_seconds, max_seconds))
        .withColumn("window_start_ms", F.when(bounded, start))
        .withColumn("window_end_ms", F.when(bounded, start + LATE_WINDOW_MS))
    )


def classify_late(
    events: DataFrame, shard: Sequence[str] = ("shard",), order: Sequence[str] = ("arrival_ms", "event_id"),
    *, out_of_orderness_seconds: int = 5, allowed_seconds: int = 300, max_seconds: int = 1800,
    block_ms: int = HOUR_MS,
) -> DataFrame:
    """X3 in batch: the watermark is the largest timestamp of strictly earlier arrivals of the shard, less 5 s."""
    latest = running(
        events, shard, order, F.col("ts_ms"), "_latest", how="max",
        block=block_start(F.col(order[0]), block_ms), before=True,
    )
    marked = latest.withColumn("watermark_ms", F.col("_latest") - out_of_orderness_seconds * 1000).drop("_latest")
    return with_late_columns(marked, allowed_seconds, max_seconds)


def with_late_metadata(classified: DataFrame, processed_ms: Column) -> DataFrame:
    """The metadata of each class, empty for events on time and for discarded ones."""
    nothing = F.create_map().cast("map<string,string>")
    delay = F.col("delay_seconds")
    return classified.withColumn(
        "metadata",
        F.when(F.col("late_class") == MODERATE, moderate_metadata(delay, F.col("ts_ms"), processed_ms))
        .when(F.col("late_class") == VERY_LATE, very_late_metadata(delay))
        .otherwise(nothing),
    )


def main_stream(classified: DataFrame, processed_ms: Column) -> DataFrame:
    """Events on time and moderately late ones, the latter with their metadata, in one pass."""
    return with_late_metadata(classified.where(F.col("late_class").isin(ON_TIME, MODERATE)), processed_ms)


def very_late_stream(classified: DataFrame, processed_ms: Column) -> DataFrame:
    return with_late_metadata(classified.where(F.col("late_class") == VERY_LATE), processed_ms)
