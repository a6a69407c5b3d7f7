"""Profile sets as bitmap blocks (A1, A2): sets of any size that merge without a row that holds all of them.

Items get dense numbers, frequent ones first, so that most of what a user has falls into few blocks. A block is 32,768 numbers of one
set of one user: 4 KiB as a bitmap, however many items the user has. Sets are merged by ``bitmap_or_agg`` and counted by
``bitmap_count``, block by block, so a user with a third of all items is spread over as many tasks as the items have blocks.

Blocks suit few users with many items. Where most users have a handful of items, a word of 64 numbers takes their place: 8 bytes, merged
by ``bit_or`` and counted by ``bit_count``. There are at most as many words as members, so they grow with the events and no faster.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.times import window_floor
from .profiles import PURCHASE, VIEW

PART_ITEMS = 100_000  # items that one task numbers
DOMAINS = {"viewed": "product", "purchased": "product", "category": "category"}


def profile_events(events: DataFrame, minutes: int = 10) -> DataFrame:
    """(user_id, window_start_ms, kind, domain, item): what each event adds to the sets of its user's window."""
    viewed, bought = F.col("event_type") == VIEW, F.col("event_type") == PURCHASE
    named = F.coalesce("category_code", F.lit("")) != ""
    entry = lambda kind, holds, item: F.when(holds & F.col(item).isNotNull(), F.struct(
        F.lit(kind).alias("kind"), F.lit(DOMAINS[kind]).alias("domain"), F.col(item).alias("item")))
    entries = F.array_compact(F.array(
        entry("viewed", viewed, "product_id"), entry("purchased", bought, "product_id"),
        entry("category", (viewed | bought) & named, "category_code")))
    return events.select("user_id", window_floor(F.col("ts_ms"), minutes * 60_000).alias("window_start_ms"), F.inline(entries))


def item_numbers(items: DataFrame, part_items: int = PART_ITEMS) -> DataFrame:
    """(domain, item, number): numbers from 1 without gaps in each domain, by classes of falling frequency.

    Items are numbered inside parts of a frequency class, and a table with a row per part says where each part begins.
    """
    counted = items.groupBy("domain", "item").agg(F.count("*").alias("_n"))
    parts = counted.agg(F.greatest(F.lit(1).cast("long"), F.ceil(F.count("*") / part_items))).scalar()
    dealt = counted.select(
        "domain", "item", F.floor(-F.log2("_n")).cast("int").alias("_class"), F.pmod(F.xxhash64("item"), parts).alias("_part"))
    sizes = dealt.groupBy("domain", "_class", "_part").agg(F.count("*").alias("_size"))
    before = Window.partitionBy("domain").orderBy("_class", "_part").rowsBetween(Window.unboundedPreceding, -1)
    begins = sizes.select("domain", "_class", "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_begin"))
    place = F.row_number().over(Window.partitionBy("domain", "_class", "_part").orderBy("item"))
    placed = dealt.withColumn("_place", place)
    return placed.join(begins, ["domain", "_class", "_part"]).select(
        "domain", "item", (F.col("_begin") + F.col("_place")).alias("number"))


def numbered(entries: DataFrame, numbers: DataFrame) -> DataFrame:
    """Entries with ``block`` and ``position`` in it instead of the item."""
    found = entries.join(numbers, ["domain", "item"])
    return found.select(
        *[c for c in entries.columns if c not in ("domain", "item")], F.bitmap_bucket_number("number").alias("block"),
        F.bitmap_bit_position("number").alias("position"))


def blocks_of(entries: DataFrame) -> DataFrame:
    """(user_id, kind, block, bitmap) of numbered entries."""
    return entries.groupBy("user_id", "kind", "block").agg(F.bitmap_construct_agg("position").alias("bitmap"))


def merged_blocks(*blocks: DataFrame) -> DataFrame:
    """A2's union of sets: blocks of several periods as one."""
    rows = blocks[0]
    for other in blocks[1:]:
        rows = rows.unionByName(other)
    return rows.groupBy("user_id", "kind", "block").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def set_sizes(blocks: DataFrame) -> DataFrame:
    """(user_id, viewed_items, purchased_items, category_items)"""
    size = lambda kind: F.coalesce(
        F.sum(F.when(F.col("kind") == kind, F.bitmap_count("bitmap"))), F.lit(0)).alias(f"{kind}_items")
    return blocks.groupBy("user_id").agg(*[size(kind) for kind in DOMAINS])


def members(blocks: DataFrame, numbers: DataFrame) -> DataFrame:
    """(user_id, kind, item): the sets again, a row per member."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            users, kinds, block, bitmaps = batch.columns
            for i, bitmap in enumerate(bitmaps.to_pylist()):  # a block has at most 32,768 members
                bits = np.flatnonzero(np.unpackbits(np.frombuffer(bitmap, np.uint8), bitorder="little"))
                number = (block[i].as_py() - 1) * len(bitmap) * 8 + bits + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(users[i], len(bits)), pa.repeat(kinds[i], len(bits)), pa.array(number, pa.int64())],
                    names=["user_id", "kind", "number"])

    found = blocks.select("user_id", "kind", "block", "bitmap").mapInArrow(run, "user_id string, kind string, number long")
    domain = F.when(F.col("kind") == "category", "category").otherwise("product")
    return found.withColumn("domain", domain).join(numbers, ["domain", "number"]).select("user_id", "kind", "item")


def in_words(entries: DataFrame, numbers: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, kind, word, bits): the items of entries as bits of words of their numbers."""
    found = entries.join(numbers, ["domain", "item"]).select(
        *keys, "kind", F.expr("(number - 1) div 64").alias("word"),
        F.expr("shiftleft(1L, cast((number - 1) % 64 as int))").alias("bits"))
    return merged_words(found, keys)


def merged_words(words: DataFrame, keys: list[str]) -> DataFrame:
    """A2's union of sets, word by word."""
    return words.groupBy(*keys, "kind", "word").agg(F.bit_or("bits").alias("bits"))


def word_sizes(words: DataFrame) -> DataFrame:
    """(user_id, viewed_items, purchased_items, category_items)"""
    size = lambda kind: F.coalesce(
        F.sum(F.when(F.col("kind") == kind, F.bit_count("bits"))), F.lit(0)).alias(f"{kind}_items")
    return words.groupBy("user_id").agg(*[size(kind) for kind in DOMAINS])


def word_members(words: DataFrame, numbers: DataFrame) -> DataFrame:
    """(user_id, kind, item): the sets again, a row per member."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            users, kinds, word, bits = batch.columns
            every = np.unpackbits(bits.to_numpy().astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            row, bit = np.nonzero(every)
            yield pa.RecordBatch.from_arrays(
                [users.take(pa.array(row)), kinds.take(pa.array(row)), pa.array(word.to_numpy()[row] * 64 + bit + 1, pa.int64())],
                names=["user_id", "kind", "number"])

    found = words.select("user_id", "kind", "word", "bits").mapInArrow(run, "user_id string, kind string, number long")
    domain = F.when(F.col("kind") == "category", "category").otherwise("product")
    return found.withColumn("domain", domain).join(numbers, ["domain", "number"]).select("user_id", "kind", "item")


def window_words(events: DataFrame, numbers: DataFrame, minutes: int = 10) -> DataFrame:
    """A1 with numbered items: a row for each window itself, and one for each (kind, word) with the bits that it shows."""
    keys = ["user_id", "window_start_ms"]
    words = in_words(profile_events(events, minutes), numbers, keys)
    figures = events.groupBy("user_id", window_floor(F.col("ts_ms"), minutes * 60_000).alias("window_start_ms")).agg(
        F.max("ts_ms").alias("last_activity_ms"), (F.max("ts_ms") - F.min("ts_ms")).cast("double").alias("avg_session_duration"))
    itself = figures.withColumns({"kind": F.lit("profile"), "word": F.lit(0).cast("long"), "bits": F.lit(0).cast("long")})
    return itself.unionByName(words, allowMissingColumns=True)
