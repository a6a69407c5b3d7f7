"""Item co-occurrence (R3): how many users have two items in common, similar items, and lists made from them.

The users of a pair are counted in two ways. A user with few items gives its pairs, which Spark sums before the shuffle. A user with
many would give the square of their number, so such users are counted by blocks: items are dealt to blocks of about ``BLOCK_ITEMS`` by
their hash, a user sends its items of a block once for each other block it has items in, and the task of two blocks counts all pairs
between them as a product of two user-by-item matrices. Its output is bounded by the blocks' items however many users it saw, and no
task holds more than ``SLAB_USERS`` users of one block pair.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordered import top_rows

LIGHT_ITEMS = 128  # a user with more items is counted by blocks
BLOCK_ITEMS = 512
SLAB_USERS = 2048
NEIGHBOURS = 50
# Similarities are whole numbers of this part, so their sums do not depend on any order.
SIMILARITY_STEPS = 1_000_000_000


def baskets_of(events: DataFrame) -> DataFrame:
    """(user_id, product_id, bought) without repeats: what each user viewed or bought."""
    return events.where(
        F.col("event_type").isin("view", "purchase") & F.col("product_id").isNotNull() & F.col("user_id").isNotNull()
    ).groupBy("user_id", "product_id").agg(F.max(F.col("event_type") == "purchase").alias("bought"))


def _light_pairs(baskets: DataFrame) -> DataFrame:
    listed = baskets.groupBy("user_id").agg(F.array_sort(F.collect_list("product_id")).alias("_items"))
    after = lambda x, i: F.transform(
        F.slice("_items", i + 2, F.size("_items")), lambda y: F.struct(x.alias("item_a"), y.alias("item_b")))
    pairs = listed.select(F.inline(F.flatten(F.transform("_items", after))))
    return pairs.groupBy("item_a", "item_b").agg(F.count("*").alias("users"))


def _count_blocks(rows: pa.Table) -> pa.Table:
    """Pairs of items of two blocks with their users; rows have the user, the side and the user's items there."""
    inner = rows["low"][0].as_py() == rows["high"][0].as_py()
    users = pc.dictionary_encode(rows["user_id"].combine_chunks()).indices.to_numpy()
    side = rows["side"].combine_chunks().to_numpy()
    lists = rows["items"].combine_chunks()
    owner = np.repeat(np.arange(len(users)), np.diff(np.asarray(lists.offsets)))
    coded = pc.dictionary_encode(lists.flatten())
    codes, names = coded.indices.to_numpy(), coded.dictionary

    def matrix(which: int) -> tuple[np.ndarray, np.ndarray]:
        own = side[owner] == which
        items, columns = np.unique(codes[own], return_inverse=True)
        out = np.zeros((users.max() + 1, len(items)), np.float32)
        out[users[owner[own]], columns] = 1
        return items, out

    left_items, left = matrix(0)
    right_items, right = (left_items, left) if inner else matrix(1)
    counts = (left.T @ right).astype(np.int64)
    if inner:
        counts = np.triu(counts, 1)
    i, j = np.nonzero(counts)
    a, b = names.take(pa.array(left_items[i])), names.take(pa.array(right_items[j]))
    swap = pc.greater(a, b)
    return pa.table({
        "item_a": pc.if_else(swap, b, a), "item_b": pc.if_else(swap, a, b), "users": pa.array(counts[i, j], pa.int64())})


def _heavy_pairs(baskets: DataFrame, block_items: int, slab_users: int) -> DataFrame:
    at_least_one = lambda n, size: F.greatest(F.lit(1).cast("long"), F.ceil(n / size))
    blocks = baskets.agg(at_least_one(F.count_distinct("product_id"), block_items)).scalar()
    slabs = baskets.agg(at_least_one(F.count_distinct("user_id"), slab_users)).scalar()
    held = baskets.groupBy("user_id", F.pmod(F.xxhash64("product_id"), blocks).alias("block")).agg(
        F.collect_list("product_id").alias("items"))
    own = held.groupBy("user_id").agg(F.collect_list("block").alias("_blocks"))
    # Dealt by user and block, so that the copies of one user's items are made by many tasks.
    met = held.join(own, "user_id").repartition("user_id", "block").select(
        "user_id", "block", "items", F.explode("_blocks").alias("_other"))
    sent = met.select(
        F.least("block", "_other").alias("low"), F.greatest("block", "_other").alias("high"),
        F.pmod(F.xxhash64("user_id"), slabs).alias("slab"), "user_id",
        F.when(F.col("block") <= F.col("_other"), F.lit(0)).otherwise(F.lit(1)).alias("side"), "items")
    return sent.groupBy("low", "high", "slab").applyInArrow(_count_blocks, "item_a string, item_b string, users long")


def item_pairs(
    baskets: DataFrame, *, light_items: int = LIGHT_ITEMS, block_items: int = BLOCK_ITEMS, slab_users: int = SLAB_USERS,
) -> DataFrame:
    """(item_a, item_b, users) with item_a < item_b: the users who have both, for all pairs that any user has."""
    baskets = baskets.select("user_id", "product_id")
    heavy = baskets.groupBy("user_id").agg(F.count("*").alias("_n")).where(F.col("_n") > light_items).select("user_id")
    pairs = _light_pairs(baskets.join(heavy, "user_id", "left_anti")).unionByName(
        _heavy_pairs(baskets.join(heavy, "user_id", "left_semi"), block_items, slab_users))
    return pairs.groupBy("item_a", "item_b").agg(F.sum("users").alias("users"))


def similar_items(pairs: DataFrame, baskets: DataFrame, neighbours: int = NEIGHBOURS) -> DataFrame:
    """(product_id, neighbour, similarity): the items most similar to each by the cosine of their users, from 0 to 1."""
    sizes = baskets.groupBy("product_id").agg(F.count("*").alias("_users"))
    size = lambda name: sizes.select(F.col("product_id").alias(name), F.col("_users").alias(f"_{name}"))
    weighed = pairs.join(size("item_a"), "item_a").join(size("item_b"), "item_b")
    share = F.col("users") / F.sqrt(F.col("_item_a").cast("double") * F.col("_item_b"))
    steps = F.floor(share * SIMILARITY_STEPS + 0.5).cast("long").alias("_steps")
    both = weighed.select(steps, F.inline(F.array(
        F.struct(F.col("item_a").alias("product_id"), F.col("item_b").alias("neighbour")),
        F.struct(F.col("item_b").alias("product_id"), F.col("item_a").alias("neighbour")))))
    best = top_rows(both, ["product_id"], [F.desc("_steps"), F.asc("neighbour")], neighbours, "_rank")
    return best.select("product_id", "neighbour", (F.col("_steps") / SIMILARITY_STEPS).alias("similarity"), "_steps")


def from_similar_items(baskets: DataFrame, similar: DataFrame, limit: int) -> DataFrame:
    """For each user the products most similar to what the user has, without the bought ones.

    The score is the mean over the user's products of their similarity to the candidate, from 0 to 1. Similar items come
    as one row per product, so a product that very many users have is one small row next to them.
    """
    lists = similar.groupBy("product_id").agg(F.collect_list(F.struct("neighbour", "_steps")).alias("_similar"))
    owned = baskets.groupBy("user_id").agg(F.count("*").alias("_owned"))
    offered = baskets.join(lists, "product_id").select("user_id", F.inline("_similar"))
    summed = offered.groupBy("user_id", F.col("neighbour").alias("product_id")).agg(F.sum("_steps").alias("_sum"))
    fresh = summed.join(baskets.where("bought").select("user_id", "product_id"), ["user_id", "product_id"], "left_anti")
    scored = fresh.join(owned, "user_id").select(
        "user_id", "product_id", (F.col("_sum") / F.col("_owned") / SIMILARITY_STEPS).alias("score"))
    best = top_rows(scored, ["user_id"], [F.desc("score"), F.asc("product_id")], limit, "_rank")
    return best.select(
        "user_id", (F.col("_rank") - 1).alias("position"), "product_id", "score", F.lit("cooccurrence").alias("reason"))


def cooccurring(
    events: DataFrame, limit: int = 20, *, light_items: int = LIGHT_ITEMS, neighbours: int = NEIGHBOURS,
) -> DataFrame:
    """R3 from a history of events: pairs, similar items, and a list for every user."""
    baskets = baskets_of(events)
    similar = similar_items(item_pairs(baskets, light_items=light_items), baskets, neighbours)
    return from_similar_items(baskets, similar, limit)
