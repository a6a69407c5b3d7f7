"""MinHash near-dedup on sets of five-word shingles.

1. One pass gives each document the size of its set, a digest of it and ``hashes`` minima of universal hash functions.
   Documents with one digest are one class; its smallest id stands for it from here on.
2. The minima are cut into bands. Classes that share a band form a bucket; each member is paired with the smallest of its
   bucket, so a bucket of any size gives as many pairs as members. Pairs whose signatures agree well enough are
   confirmed on full sets, and the links joined to components by large-star and small-star.
3. Components that still meet in a bucket form a cluster. Its members outside its largest component are compared with
   all members of other components, tile by tile in blocks of bounded size: signatures choose the pairs, full sets
   decide, and a tile gives back at most one link for each pair of components it joins, never the pairs themselves. Nothing within
   a component is compared, and no bucket or cluster is cut short.

A pair at the wanted similarity of 0.85 is missed by all 20 bands of 5 with a probability of 8e-6, and by the signature
check (68 of 100 equal) with one of about 1e-5. Higher similarities are missed more seldom still.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .tables import stored
from .words import blocks, find_words, lowered, mix, sequence_hashes


@dataclass(frozen=True)
class Settings:
    shingle: int = 5
    bands: int = 20
    rows: int = 5
    percent: int = 85  # links have 100 * intersection >= percent * union
    agree: int = 68  # equal minima for a pair to be confirmed on full sets
    block: int = 256  # members of a cluster on one side of a task

    @property
    def hashes(self) -> int:
        return self.bands * self.rows


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; a text with fewer words has its whole sequence as one."""
    words = find_words(lowered(data), offsets)
    hashes = words.hashes()
    runs = sequence_hashes(hashes, width)
    out = []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        if b - a >= width:
            out.append(np.unique(runs[a:b - width + 1]))
        elif b > a:
            out.append(sequence_hashes(hashes[a:b], b - a, 1000 + b - a))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def minima(sets: list[np.ndarray], count: int) -> np.ndarray:
    """(sets x count) minima of ``x -> (a x + b) >> 32``; sets must not be empty."""
    out = np.empty((len(sets), count), np.int32)
    if not sets:
        return out
    keys = np.random.default_rng(77).integers(1, 2**63, (count, 2), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    values = np.concatenate(sets)
    first = np.cumsum([0, *map(len, sets[:-1])])
    hashed = np.empty_like(values)
    for i, (a, b) in enumerate(keys):
        np.multiply(values, a, out=hashed)
        hashed += b
        out[:, i] = (np.minimum.reduceat(hashed, first) >> np.uint64(32)).astype(np.uint32).view(np.int32)
    return out


SIGNED = "doc_id long, n_shingles long, set_key binary, signature array<int>"


def signatures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """(doc_id, n_shingles, set_key, signature) of every row; an empty set has no key and an empty signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.columns
            for start, stop, data, offsets in blocks(texts):
                sets = shingle_sets(data, offsets, settings.shingle)
                full = np.array([len(s) > 0 for s in sets])
                found = minima([s for s in sets if len(s)], settings.hashes)
                edges = np.concatenate([[0], np.cumsum(full)]) * settings.hashes
                signed = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(found.reshape(-1)))
                yield pa.RecordBatch.from_arrays([
                    ids.slice(start, stop - start),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets],
                             pa.binary()),
                    signed,
                ], names=["doc_id", "n_shingles", "set_key", "signature"])

    pairs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return pairs.mapInArrow(run, SIGNED)


def full_sets(docs: DataFrame, nodes: DataFrame, doc_id: str, text: str, settings: Settings) -> DataFrame:
    """(node, shingles) of the wanted documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.columns
            for start, stop, data, offsets in blocks(texts):
                sets = [s.view(np.int64) for s in shingle_sets(data, offsets, settings.shingle)]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(start, stop - start), pa.array(sets, pa.list_(pa.int64()))], names=["node", "shingles"])

    wanted = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    # Merged at every size: the nodes grow with the documents, so they are not broadcast while they happen to be few.
    wanted = wanted.join(nodes.select(F.col("node").alias("doc_id")).hint("merge"), "doc_id", "left_semi")
    return wanted.mapInArrow(run, "node long, shingles array<long>")


def confirmed(pairs: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """Pairs (u, v) whose full sets are similar enough."""
    both = F.size(F.array_intersect("set_u", "set_v"))
    union = F.size("set_u") + F.size("set_v") - both
    return (
        pairs.join(sets.select(F.col("node").alias("u"), F.col("shingles").alias("set_u")), "u")
        .join(sets.select(F.col("node").alias("v"), F.col("shingles").alias("set_v")), "v")
        .where(100 * both >= settings.percent * union).select("u", "v")
    )


def _agreeing(a: Column, b: Column) -> Column:
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: same))


def _link(settings: Settings):
    """Links of the members outside a cluster's largest component with members of other components in one tile.

    Signatures choose the pairs, full sets decide. A pair whose components this tile has already joined is left out, so
    there are fewer links than members.
    """

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("outside", "ascending"), ("node", "ascending")])
        role = np.array(rows["outside"].to_pylist(), bool)
        node, label = (np.array(rows[c].to_pylist(), np.int64) for c in ("node", "label"))
        signed = np.asarray(rows["signature"].combine_chunks().flatten()).reshape(len(node), -1)
        values = rows["shingles"].combine_chunks()
        edges, shingles = np.asarray(values.offsets), np.asarray(values.values)
        of = lambda i: shingles[edges[i]:edges[i + 1]]
        size = np.diff(edges)
        members = np.flatnonzero(~role)
        u, v = [], []
        for i in np.flatnonzero(role).tolist():
            equal = (signed[members] == signed[i]).sum(axis=1)
            agree = np.flatnonzero((equal >= settings.agree) & (label[members] != label[i]))
            own = of(i)
            for j in members[agree[np.argsort(-equal[agree], kind="stable")]].tolist():
                if label[j] == label[i]:
                    continue
                other = of(j)
                at = np.minimum(np.searchsorted(own, other), len(own) - 1)
                both = int((own[at] == other).sum())
                if 100 * both >= settings.percent * (size[i] + size[j] - both):
                    u.append(node[i])
                    v.append(node[j])
                    label[label == label[j]] = label[i]
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return run


def _across(
    members: DataFrame, links: DataFrame, signature: DataFrame, sets: DataFrame, settings: Settings
) -> DataFrame:
    """Links (u, v) between components that share a bucket."""
    labelled = members.select("bucket", "node").join(links, "node", "left").select(
        "bucket", "node", F.coalesce("component", "node").alias("label"))
    spans = labelled.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("_high"))
    mixed = stored(labelled.join(spans.where("low < _high"), "bucket").select("node", "label", "low"), "mixed")
    clusters = components(mixed, "label", "low").select(F.col("node").alias("label"), F.col("component").alias("cluster"))
    apart = stored(
        mixed.select("node", "label").distinct().join(clusters, "label", "left")
        .select("node", "label", F.coalesce("cluster", "label").alias("cluster")), "apart")
    sizes = apart.groupBy("cluster", "label").agg(F.count(F.lit(1)).alias("size")).groupBy("cluster").agg(
        F.max_by("label", F.struct("size", "label")).alias("major"), F.max("size").alias("most"), F.sum("size").alias("size"))
    parts = lambda n: F.ceil(n / settings.block).cast("int")
    rows = (
        apart.join(sizes, "cluster").join(signature, "node").join(sets, "node")
        .withColumn("blocks", parts(F.col("size"))).withColumn("cuts", parts(F.col("size") - F.col("most")))
    )
    mine = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    columns = ["cluster", "node", "label", "signature", "shingles"]
    inside = rows.select(
        *columns, F.lit(False).alias("outside"), mine("blocks").alias("i"), F.explode(every("cuts")).alias("j"))
    outside = rows.where("label <> major").select(
        *columns, F.lit(True).alias("outside"), F.explode(every("blocks")).alias("i"), mine("cuts").alias("j"))
    return inside.unionByName(outside).groupBy("cluster", "i", "j").applyInArrow(_link(settings), "u long, v long")


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", settings: Settings = Settings(),
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row; a document is kept if it is the smallest of its component.

    Words are lower-cased in A-Z. Null and empty texts have an empty set and link with nothing, and neither do rows
    without an id, whose component is null and which are kept. Rows that share an id are judged by their own texts. Other columns are
    dropped. A very long text is held whole by one task, in a block of its own.
    Runs jobs when called and writes signatures, buckets and links to the shared folder.
    """
    signed = stored(signatures(docs, doc_id, text, settings), "signatures")
    linked = signed.where("n_shingles > 0 and doc_id is not null")
    classes = linked.groupBy("set_key").agg(F.min("doc_id").alias("node"))
    heads = stored(
        linked.join(classes, "set_key").where("doc_id = node").select("node", "signature"), "heads")
    bands = F.array(*[
        F.xxhash64(F.lit(i), F.slice("signature", settings.rows * i + 1, settings.rows)) for i in range(settings.bands)])
    banded = heads.select("node", F.explode(bands).alias("bucket"))
    shared = banded.groupBy("bucket").agg(
        F.min("node").alias("leader"), F.max("node").alias("_last")).where("leader < _last").drop("_last")
    members = stored(banded.join(shared, "bucket"), "buckets")
    nodes = members.select("node").distinct()
    signature = stored(heads.join(nodes, "node").dropDuplicates(["node"]), "compared")
    sets = stored(full_sets(docs, nodes, doc_id, text, settings), "sets")

    pairs = members.where("node <> leader").select(F.col("node").alias("u"), F.col("leader").alias("v")).distinct()
    agree = (
        pairs.join(signature.select(F.col("node").alias("u"), F.col("signature").alias("sign_u")), "u")
        .join(signature.select(F.col("node").alias("v"), F.col("signature").alias("sign_v")), "v")
        .where(_agreeing(F.col("sign_u"), F.col("sign_v")) >= settings.agree).select("u", "v")
    )
    links = components(confirmed(agree, sets, settings))
    links = components(_across(members, links, signature, sets, settings).union(links))

    found = (
        linked.select("doc_id", "n_shingles", "set_key").join(classes, "set_key")
        .join(links, "node", "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "node").alias("component_id"))
    )
    alone = signed.where("n_shingles = 0 or doc_id is null").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return found.union(alone).withColumn("kept", F.coalesce(F.expr("doc_id = component_id"), F.lit(True)))


def keep_first(
    docs: DataFrame, columns: tuple[str, ...], doc_id: str = "doc_id", text: str = "text", settings: Settings = Settings(),
) -> DataFrame:
    """The wanted columns of one document of each component: that with the smallest id. Rows without an id all stay.

    Rows that share an id but not their text are documents of their own and come behind all others of their component; each is
    dropped for its own text only. Of rows that share id and text one stays, with the smallest other columns.
    """
    sign = F.xxhash64(text)
    many = docs.where(F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).cast("long").alias("_many")).agg(
        F.min(sign).alias("_low"), F.max(sign).alias("_high")).where("_low < _high").select("_many")
    own = F.shiftrightunsigned(F.xxhash64(F.col(doc_id), F.col(text)), 2)
    top = docs.agg(F.greatest(F.lit(0).cast("long"), F.max(F.col(doc_id).cast("long")))).scalar()
    # Numbers above every id in use; without room above they are negative.
    number = F.when(top < F.lit(1 << 62), top + own + 1).otherwise(-own - 1)
    wanted = docs.select(*columns, F.col(doc_id).cast("long").alias("_doc")).join(many, F.col("_doc") == F.col("_many"), "left")
    numbered = wanted.withColumn("_node", F.when(F.col("_many").isNotNull(), number).otherwise(F.col("_doc")))
    dropped = near_duplicates(numbered, "_node", text, settings).where("not kept").select(F.col("doc_id").alias("_gone"))
    left = numbered.join(dropped.distinct(), F.col("_node") == F.col("_gone"), "left_anti")
    row = F.struct(*columns)
    one = left.where("_node is not null").groupBy("_node").agg(F.min(row).alias("row")).select("row.*")
    return one.union(left.where("_node is null").select(*columns))
