"""Cold start, personalised generation, ranking and enrichment of recommendations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.times import window_floor
from .activity import product_scores, top_products
from .ordered import DAY_MS, running, top_rows
from .profiles import PROFILE_LIMIT, VIEW, route

COLD_START_SCORE = 0.7
FALLBACK_LIMIT = 10
TRENDING_MS = DAY_MS
# How long a list made for a user is sent again.
CACHE_LIST_MS = 300_000
# Copies of a category page, so that the users of one hot category meet them in as many tasks.
PAGE_COPIES = 16


def _as_list(ranked: DataFrame) -> DataFrame:
    """One row with the products of a top-k report in order."""
    listed = F.sort_array(F.collect_list(F.struct("score", "product_id")), asc=False)
    return ranked.agg(F.transform(listed, lambda x: x["product_id"]).alias("products"))


def cold_start_products(popular: DataFrame, trending: DataFrame, limit: int) -> DataFrame:
    """One row with exactly ``limit`` products, popular ones first, then unseen trending ones."""
    both = _as_list(popular).withColumn("_trending", _as_list(trending).scalar())
    return both.select(F.slice(F.array_distinct(F.concat("products", "_trending")), 1, limit).alias("products"))


def cold_start_list(events: DataFrame, now_ms: Column, limit: int) -> DataFrame:
    popular = top_products(product_scores(events), limit)
    trending = top_products(product_scores(events, now_ms - TRENDING_MS), limit)
    return cold_start_products(popular, trending, limit)


def cold_start(users: DataFrame, products: DataFrame, reason: str = "cold_start") -> DataFrame:
    """R2: the same short list for every user; it travels as one value of a scalar subquery."""
    return users.withColumn("_products", products.scalar()).select(
        "user_id", F.posexplode("_products").alias("position", "product_id"),
        F.lit(COLD_START_SCORE).alias("score"), F.lit(reason).alias("reason"),
    )


def ranked_products(scores: DataFrame, products: DataFrame) -> DataFrame:
    """Products of a category by popularity: ``rank`` from 0, ``score`` relative to the category's best."""
    scored = scores.withColumnRenamed("score", "events").join(
        products.where("category_code != ''").select("product_id", "category_code"), "product_id"
    ).withColumn("_down", -F.col("events"))
    best = scored.groupBy("category_code").agg(F.max("events").alias("_best"))
    block = F.struct("_down", F.substring("product_id", 1, 2).alias("_prefix"))
    return (
        running(scored, ["category_code"], ["_down", "product_id"], F.lit(1).cast("long"), "_upto",
                how="sum", block=block)
        .join(best, "category_code")
        .select("category_code", "product_id", (F.col("_upto") - 1).alias("rank"),
                (F.col("events") / F.col("_best")).alias("score"))
    )


def personalized(
    interests: DataFrame, bought: DataFrame, ranked: DataFrame, limit: int = PROFILE_LIMIT,
    copies: int = PAGE_COPIES,
) -> DataFrame:
    """The best products of the user's categories that the user has not bought.

    ``interests`` has a row per user_id and category_code with ``bought_count``, the products bought there;
    ``bought`` has user_id and product_id without repeats. A user who bought b products of a category finds
    ``limit`` others among its first ``limit`` + b, so the user takes that many from pages of ``limit``
    ranked products. The work grows with what users bought, never with users times products.
    """
    pages = (
        ranked.withColumn("_page", F.floor(F.col("rank") / limit).cast("long"))
        .groupBy("category_code", "_page")
        .agg(F.collect_list(F.struct("product_id", "score")).alias("_items"))
        .withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    )
    last_page = F.floor((F.col("bought_count") + limit - 1) / limit).cast("long")
    wanted = interests.select(
        "user_id", "category_code",
        F.explode(F.sequence(F.lit(0).cast("long"), last_page)).alias("_page"),
        F.pmod(F.xxhash64("user_id"), F.lit(copies)).cast("int").alias("_copy"),
    )
    candidates = wanted.join(pages, ["category_code", "_page", "_copy"]).select("user_id", F.inline("_items"))
    fresh = candidates.join(bought.select("user_id", "product_id"), ["user_id", "product_id"], "left_anti")
    best = top_rows(fresh, ["user_id"], [F.desc("score"), F.asc("product_id")], limit, "_rank")
    return best.select(
        "user_id", (F.col("_rank") - 1).alias("position"), "product_id", "score",
        F.lit("personalized").alias("reason"),
    )


def touched_products(events: DataFrame, products: DataFrame) -> DataFrame:
    """What each user viewed or bought, with its category; repeats are counted away before the catalog join."""
    touched = events.where(
        F.col("event_type").isin("view", "purchase") & F.col("product_id").isNotNull()
    ).groupBy("user_id", "product_id").agg(F.max(F.col("event_type") == "purchase").alias("bought"))
    return touched.join(products.select("product_id", "category_code"), "product_id", "left")


def interests_of(touched: DataFrame) -> DataFrame:
    """Categories a user viewed or bought from, and how many products were bought there."""
    return touched.where(F.coalesce("category_code", F.lit("")) != "").groupBy("user_id", "category_code").agg(
        F.count_if("bought").alias("bought_count")
    )


def bought_of(touched: DataFrame) -> DataFrame:
    return touched.where("bought").select("user_id", "product_id")


def filter_and_rank(
    recommendations: DataFrame, keys: Sequence[str] = ("user_id",), *, min_score: float = 0.3, max_count: int = 10
) -> DataFrame:
    """Drop low scores, keep a product's first occurrence, then the best per group; ties by source order."""
    passing = recommendations.where(F.col("score") >= min_score)
    first = top_rows(passing, [*keys, "product_id"], [F.asc("position")], 1, "_first").drop("_first")
    return top_rows(first, keys, [F.desc("score"), F.asc("position")], max_count)


def enrich(recommendations: DataFrame, products: DataFrame, generated_ms: Column) -> DataFrame:
    """Product columns for known products, nulls for unknown ones; missing price counts as 0."""
    known = products.select(
        "product_id", "product_name", F.col("category_code").alias("category"),
        F.coalesce(F.col("list_price"), F.lit(0.0)).alias("price"), F.lit("").alias("image_url"),
    )
    return recommendations.join(known, "product_id", "left").withColumn("generated_at_ms", generated_ms)


def user_routes(events: DataFrame, minutes: int = 10) -> DataFrame:
    """R1 at the end of the data, without building the profiles.

    A user with events in two windows has a previous profile; the number of viewed products only matters
    to users with a single window, so it may be counted over all of them.
    """
    seen = events.select(
        "user_id", window_floor(F.col("ts_ms"), minutes * 60_000).alias("_window"),
        F.when(F.col("event_type") == VIEW, F.col("product_id")).alias("_viewed"),
    ).groupBy("user_id", "_viewed").agg(F.min("_window").alias("_first"), F.max("_window").alias("_last"))
    several = F.max("_last") > F.min("_first")
    return seen.groupBy("user_id").agg(
        route(F.when(several, F.lit(2)).otherwise(F.lit(1)), F.count("_viewed")).alias("route")
    )


def recommend(
    events: DataFrame, products: DataFrame, now_ms: Column, *, minutes: int = 10, min_score: float = 0.3,
    max_count: int = 10,
) -> DataFrame:
    """The recommendations of every user from the profile as it stands at the end of ``events``."""
    profiles = user_routes(events, minutes)
    cold_users = profiles.where(F.col("route") == "cold_start").select("user_id")
    known_users = profiles.where(F.col("route") == "personalized").select("user_id")
    generic = cold_start(cold_users, cold_start_list(events, now_ms, PROFILE_LIMIT))
    touched = touched_products(events, products)
    personal = personalized(
        interests_of(touched).join(known_users, "user_id", "left_semi"), bought_of(touched),
        ranked_products(product_scores(events), products),
    )
    best = filter_and_rank(generic.unionByName(personal), min_score=min_score, max_count=max_count)
    return enrich(best, products, now_ms)
