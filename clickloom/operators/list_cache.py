"""Cold-start lists that change with the period and stay with a user for an hour (R2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .anchored import with_segment
from .ordered import HOUR_MS, block_start, top_rows
from .recommend import TRENDING_MS

LIST_MS = HOUR_MS


def _listed(scores: DataFrame, name: str, limit: int) -> DataFrame:
    """The products of each period's top rows, in the order of a sorted set read in reverse"""
    best = top_rows(scores.where(F.col("score") > 0), ["period_ms"], [F.desc("score"), F.desc("product_id")], limit)
    listed = F.sort_array(F.collect_list(F.struct("score", "product_id")), asc=False)
    return best.groupBy("period_ms").agg(F.transform(listed, lambda x: x["product_id"]).alias(name))


def list_versions(events: DataFrame, limit: int, period_ms: int = TRENDING_MS) -> DataFrame:
    """(period_ms, products): the list in force during each period, from the events before it.

    Products popular in all earlier periods come first, then unseen ones that trend in the period before. Events are counted
    once, by product and period; a product then has a row for every period after its first, whatever the number of its
    events. The first period has an empty list.
    """
    period = block_start(F.col("ts_ms"), period_ms).alias("period_ms")
    counted = events.where(F.col("event_type").isin("view", "purchase") & F.col("product_id").isNotNull()).groupBy(
        "product_id", period).agg(F.count("*").alias("events"))
    bounds = events.agg(F.struct(F.min(period).alias("first"), F.max(period).alias("last")).alias("b")).scalar()
    last = bounds["last"]
    after = lambda at: F.col(at) + period_ms
    trending = counted.where(after("period_ms") <= last).select(
        "product_id", after("period_ms").alias("period_ms"), F.col("events").alias("score"))
    born = counted.groupBy("product_id").agg(F.min("period_ms").alias("_born")).where(after("_born") <= last)
    filled = born.select("product_id", F.explode(F.sequence(after("_born"), last, F.lit(period_ms))).alias("period_ms"))
    upto = Window.partitionBy("product_id").orderBy("period_ms").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    popular = filled.join(trending, ["product_id", "period_ms"], "left").withColumn(
        "score", F.sum(F.coalesce("score", F.lit(0))).over(upto))
    periods = events.select(F.lit(0)).limit(1).select(
        F.explode(F.sequence(bounds["first"], last, F.lit(period_ms))).alias("period_ms"))
    none = F.array().cast("array<string>")
    both = periods.join(_listed(popular, "popular", limit), "period_ms", "left").join(
        _listed(trending, "trending", limit), "period_ms", "left")
    merged = F.array_distinct(F.concat(F.coalesce("popular", none), F.coalesce("trending", none)))
    return both.select("period_ms", F.slice(merged, 1, limit).alias("products"))


def stored_lists(requests: DataFrame, versions: DataFrame, *, list_ms: int = LIST_MS, period_ms: int = TRENDING_MS) -> DataFrame:
    """R2: a user's request gets the list made for the user less than ``list_ms`` ago, or else the one now in force.

    ``requests`` has user_id, ts_ms and event_id, which settles equal times. ``made_at_ms`` tells when the list was made and
    ``reused`` whether for an earlier request; a reuse does not prolong its time. Where a list starts depends on the one
    before, so starts come from segments, chunk by chunk of time. A null user is a user like others.
    """
    made = with_segment(requests, ["user_id"], "ts_ms", "event_id", list_ms, closes=False, start="made_at_ms")
    held = made.withColumn("reused", ~F.coalesce("opens", F.lit(False))).drop("opens").withColumn(
        "period_ms", block_start(F.col("made_at_ms"), period_ms))
    # The versions have a row per period: Spark broadcasts them while their size allows, the skew join splits hot periods beyond.
    return held.join(versions, "period_ms", "left").drop("period_ms")
