"""Conflict-constrained best-fit packing of documents into bins of equal capacity.

A document longer than a bin is cut: its full pieces are bins of their own, its rest is packed like a short document.
Items are taken from large to small. Open bins are kept in the order of their residual room; a bin carries a bitmap of
its sources and one of its duplicate clusters. The search starts at the smallest residual that is large enough and goes
on to its successors until it finds a bin whose bitmaps are free of the item's source and cluster: the tightest compatible
bin. If there is none, a bin is opened.

Items are dealt by a hash of their id to shards of about ``shard_items`` that are packed independently, so a source that has a
third of all documents is spread over all of them; only sizes and keys are shuffled, never texts.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import blocks, find_words, lowered, mix

CAPACITY = 2048
SHARD_ITEMS = 4096
SLAB = 4096  # copies of a row that one task numbers


def measured(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(doc_id, source, n_words, cluster): the cluster is a hash of the lower-cased words, null without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sources, texts = batch.columns
            for start, stop, data, offsets in blocks(texts):
                words = find_words(lowered(data), offsets)
                counts = words.counts
                place = np.arange(len(words.starts)) - np.repeat(words.first[:-1], counts)
                keyed = mix(words.hashes() + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(keyed, dtype=np.uint64)])
                cluster = mix(total[words.first[1:]] - total[words.first[:-1]]).view(np.int64)
                yield pa.RecordBatch.from_arrays([
                    ids.slice(start, stop - start), sources.slice(start, stop - start), pa.array(counts, pa.int64()),
                    pa.array(cluster, pa.int64(), mask=counts == 0),
                ], names=["doc_id", "source", "n_words", "cluster"])

    wanted = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"),
        F.col(text).cast("string").alias("text"))
    return wanted.mapInArrow(run, "doc_id long, source string, n_words long, cluster long")


def best_fit(items: list[tuple[int, int, int]], capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) of each (size, source bit, cluster bit), taken in the given order."""
    residuals: list[int] = []  # those of open bins, each once
    bins: dict[int, list[list[int]]] = {}  # by residual: number, sources, clusters
    out, opened = [], 0
    for size, source, cluster in items:
        chosen = None
        at = bisect_left(residuals, size)
        while chosen is None and at < len(residuals):
            room = residuals[at]
            for candidate in bins[room]:
                if not candidate[1] & source and not candidate[2] & cluster:
                    chosen = candidate
                    break
            at += 1
        if chosen is None:
            room, chosen = capacity, [opened, 0, 0]
            opened += 1
        else:
            bins[room].remove(chosen)
            if not bins[room]:
                del bins[room]
                del residuals[bisect_left(residuals, room)]
        out.append((chosen[0], capacity - room))
        chosen[1] |= source
        chosen[2] |= cluster
        left = room - size
        if left:
            if left not in bins:
                bins[left] = []
                insort(residuals, left)
            bins[left].append(chosen)
    return out


def _pack_shard(capacity: int):
    def bits(values: list) -> list[int]:
        number: dict = {}
        return [0 if v is None else 1 << number.setdefault(v, len(number)) for v in values]

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("length", "descending"), ("doc_id", "ascending"), ("cluster", "ascending")])
        placed = best_fit(
            list(zip(rows["length"].to_pylist(), bits(rows["source"].to_pylist()), bits(rows["cluster"].to_pylist()),
                     strict=True)), capacity)
        shard = rows["shard"][0].as_py()
        return pa.table({
            "doc_id": rows["doc_id"], "piece": rows["piece"], "start": rows["start"], "length": rows["length"],
            "bin_id": pa.array([f"{shard}-{number}" for number, _ in placed], pa.string()),
            "bin_offset": pa.array([offset for _, offset in placed], pa.int64()),
        })

    return run


def pack(items: DataFrame, capacity: int = CAPACITY, shard_items: int = SHARD_ITEMS) -> DataFrame:
    """(doc_id, piece, start, length, bin_id, bin_offset): where each piece of each measured document goes.

    ``items`` has doc_id, source, n_words and cluster, such as ``measured`` gives. Documents without words have no piece. A null source or
    cluster conflicts with nothing. Rows that share an id are items of their own, and their full pieces stay apart. No two items of a bin
    share a source or a cluster. A very long document has many full pieces, which are bins of their own. The shards are sized by a count of the table when this is called.
    """
    shards = max(1, -(-items.count() // shard_items))
    pieces = (F.col("n_words") / capacity).cast("long")
    # Each row has a key of its own: equal rows are counted first and numbered again, in slabs that are dealt out.
    same = items.where("n_words > 0").groupBy("doc_id", "source", "n_words", "cluster").agg(F.count(F.lit(1)).alias("copies"))
    slabs = same.withColumn("slab", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(copies - 1) div {SLAB}"))))
    last = F.least(F.col("copies"), (F.col("slab") + 1) * SLAB) - 1
    rows = slabs.repartition("doc_id", "cluster", "slab").withColumn("copy", F.explode(F.sequence(F.col("slab") * SLAB, last)))
    key = F.xxhash64("doc_id", "source", "n_words", "cluster", "copy")
    cut = rows.select("doc_id", "source", "cluster", "n_words", "copy", pieces.alias("full"), key.alias("key"))
    rest = cut.where(F.col("n_words") % capacity > 0).select(
        F.pmod("key", F.lit(shards)).cast("int").alias("shard"), "doc_id", "source", "cluster",
        F.col("full").alias("piece"), (F.col("full") * capacity).alias("start"),
        (F.col("n_words") % capacity).alias("length"))
    packed = rest.groupBy("shard").applyInArrow(
        _pack_shard(capacity), "doc_id long, piece long, start long, length long, bin_id string, bin_offset long")
    whole = cut.where("full > 0").withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.col("full") - 1)))
    text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit("none"))
    named = F.concat_ws(
        "-", F.lit("full"), text("doc_id"), "n_words", F.hex("cluster"), F.hex(F.xxhash64("source")), "copy", "piece")
    alone = whole.select(
        "doc_id", "piece", (F.col("piece") * capacity).alias("start"), F.lit(capacity).cast("long").alias("length"),
        named.alias("bin_id"), F.lit(0).cast("long").alias("bin_offset"))
    return packed.union(alone)
