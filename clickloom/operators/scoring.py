"""Scores of user-product pairs: cache lookups, request batches, failure defaults, linear models (2.8)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .anchored import with_segment
from .ordered import COARSE_BLOCKS, DAY_MS, block_start, null_safe_left, running

CACHE_MS = 300_000
CACHED_LATENCY_MS = 0.1
REQUEST_BATCH = 32
# The answer to a request whose scoring failed.
FAILED_SCORE, FAILED_LATENCY_MS = 0.5, 3000.0
# Rows that are numbered together.
ORDER_BLOCK = 10_000

PAIR = ["user_id", "product_id"]


def request_pairs(requests: DataFrame, users: str = "user_ids", products: str = "product_ids") -> DataFrame:
    """One row per pair of a batch request; the longer list is cut to the length of the shorter one."""
    size = F.least(F.size(users), F.size(products))
    pairs = F.arrays_zip(F.slice(users, 1, size).alias("user_id"), F.slice(products, 1, size).alias("product_id"))
    rest = [c for c in requests.columns if c not in (users, products)]
    return requests.select(*rest, F.posexplode(pairs).alias("position", "_pair")).select(
        *rest, "position", "_pair.user_id", "_pair.product_id"
    )


def cached_predictions(requests: DataFrame, predictions: DataFrame, ttl_ms: int = CACHE_MS) -> DataFrame:
    """The latest earlier prediction of the pair, while younger than the lifetime.

    ``requests`` has user_id, product_id, ts_ms, event_id; ``predictions`` has user_id, product_id,
    cached_at_ms, score. One ordered pass over both sides, cut into blocks of time; no pair of rows is built.
    """
    payload = [c for c in requests.columns]
    asked = requests.withColumn("_request", F.lit(1))
    known = predictions.groupBy(*PAIR, F.col("cached_at_ms").alias("ts_ms")).agg(F.max("score").alias("_score"))
    both = asked.unionByName(known.withColumn("_request", F.lit(0)), allowMissingColumns=True)
    entry = F.when(F.col("_request") == 0, F.struct(F.col("ts_ms").alias("at"), F.col("_score").alias("score")))
    found = running(
        both, PAIR, ["ts_ms", "_request"], entry, "_cached", how="last",
        block=block_start(F.col("ts_ms"), DAY_MS),
    ).where(F.col("_request") == 1)
    usable = F.col("ts_ms") - F.col("_cached.at") < ttl_ms
    return found.select(
        *payload, F.when(usable, F.col("_cached.score")).alias("cached_score"),
        F.coalesce(usable, F.lit(False)).alias("cached"),
    )


def score_with_cache(requests: DataFrame, score: Column, latency_ms: Column, ttl_ms: int = CACHE_MS) -> DataFrame:
    """A first request scores and fills the cache, later ones get the stored score until the lifetime ends.

    A reuse does not prolong the lifetime, and a request without a score fills nothing: the next one is scored itself.
    Cached answers report a fixed latency. ``cached_at_ms`` is null where there is neither an entry nor a score. Null users
    and products are keys like others.
    """
    asked = requests.withColumn("_score", score)
    fills = F.col("_score").isNotNull()
    opened = with_segment(
        asked.where(fills).select(*PAIR, "ts_ms", "event_id"), PAIR, "ts_ms", "event_id", ttl_ms, closes=False
    ).where("opens").select(*PAIR, "ts_ms", "event_id", F.lit(True).alias("_opens"))
    marked = null_safe_left(asked, opened, [*PAIR, "ts_ms", "event_id"])
    entry = F.when(F.col("_opens"), F.struct(F.col("ts_ms").alias("at"), F.col("_score").alias("score")))
    held = running(
        marked, PAIR, ["ts_ms", "event_id"], entry, "_entry", how="last", block=block_start(F.col("ts_ms"), DAY_MS),
    )
    alive = F.coalesce(F.col("ts_ms") - F.col("_entry.at") < ttl_ms, F.lit(False))
    return (
        held.withColumn("cached", alive & F.col("_opens").isNull())
        .withColumn("cached_at_ms", F.when(alive, F.col("_entry.at")))
        .withColumn("score", F.when(alive, F.col("_entry.score")))
        .withColumn("latency_ms", F.when(F.col("cached"), F.lit(CACHED_LATENCY_MS)).otherwise(latency_ms))
        .drop("_score", "_opens", "_entry")
    )


def with_failure_default(scored: DataFrame, score: str = "score", latency: str = "latency_ms") -> DataFrame:
    """A request without a score gets the default answer, which is never cached."""
    failed = F.col(score).isNull()
    return (
        scored.withColumn("failed", failed)
        .withColumn(latency, F.when(failed, F.lit(FAILED_LATENCY_MS)).otherwise(F.col(latency)))
        .withColumn(score, F.coalesce(F.col(score), F.lit(FAILED_SCORE)))
    )


def request_batches(requests: DataFrame, order: str = "event_id", batch_size: int = REQUEST_BATCH) -> DataFrame:
    """``batch_id`` and ``batch_rows``: requests in order, in batches of one size and a short last one."""
    placed = running(
        requests, [], [order], F.lit(1).cast("long"), "_place", how="sum", block=block_start(F.col(order), ORDER_BLOCK),
        coarse=ORDER_BLOCK * COARSE_BLOCKS)
    batched = placed.withColumn("batch_id", F.floor((F.col("_place") - 1) / batch_size)).drop("_place")
    return batched.withColumn("batch_rows", F.count("*").over(Window.partitionBy("batch_id")))


def failed_batches(scored: DataFrame, score: str = "score") -> DataFrame:
    """A batch in which one prediction fails gets the default answer as a whole."""
    failed = F.max(F.col(score).isNull()).over(Window.partitionBy("batch_id"))
    return scored.withColumn("failed", failed).withColumn(
        score, F.when(F.col("failed"), F.lit(FAILED_SCORE)).otherwise(F.col(score)))


def score_with_weights(df: DataFrame, weights: DataFrame, features: str, name: str = "prediction") -> DataFrame:
    """A linear model over an array column; ``weights`` has a row (i, w) per feature, from 0.

    The weights travel as one value, whose size is the number of features. Features of another length have no prediction.
    """
    row = weights.agg(F.array_sort(F.collect_list(F.struct("i", "w"))).alias("weights")).scalar()
    products = F.zip_with(F.col(features), F.col("_weights"), lambda x, w: x.cast("double") * w["w"])
    return df.withColumn("_weights", row).withColumn(
        name, F.aggregate(products, F.lit(0.0), lambda total, x: total + x)).drop("_weights")
