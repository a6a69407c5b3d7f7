"""Language-model scoring with a log-frequency Bloom filter.

Learning: tasks cut training texts into tokens (lower-cased words and an end mark) and count pairs of a token and the one before it.
Counts of a stretch of text go to buckets by hash; a bucket adds them up and enters each pair with a count of c into its
slice of the filter 1 + floor(log2 c) times, once for each level. A slice has the size that its counted entries need, and the
number of buckets grows with the text, so the filter grows with the corpus and no task or driver holds more than a slice.
Buckets also give the number of training tokens and of distinct ones.

Scoring: a chunk of documents sends its distinct tokens and pairs to the same buckets. They give back the exact counts of the
tokens and the levels of the pairs; nothing is broadcast. The level of a pair is found by repeated membership probes, level
after level until one is missing or the top level of the slice is reached, which can only overstate it; the counts of its two
tokens bound it from above. With c(h, w) from the level, P1 the smoothed share of a single token
and T = c(h) ** ``novelty`` as the expected number of distinct successors,

    P(w | h) = (c(h, w) + T * P1(w)) / (c(h) + T),   P1(w) = (c(w) + 1) / (N + V + 1),

and P = P1 where h was never seen. The first token of a text follows a start mark, whose count is the number of training texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import bucket_count, chunked, pack, slices, stored, text_bytes, unpack
from .words import blocks, find_words, lowered, mix, text_buffer

END = np.uint64(0x517CC1B727220A95)  # token of the end of a text
START = np.uint64(0x2545F4914F6CDD1D)  # what the first token follows
PAIR = np.uint64(0xD6E8FEB86659FD93)
STEP = np.uint64(0x9E3779B97F4A7C15)

PARTS = 256  # slices of the filter at least, each of 512 bits at least
STRETCH = 1_500_000  # tokens counted together before they are sent


@dataclass(frozen=True)
class Settings:
    bits_per_pair: int = 10  # for each level that it is entered at
    probes: int = 5
    novelty: float = 0.8


def held_out(doc_id: Column) -> Column:
    """Texts that are not learned from; a row without an id is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 7 == 2, F.lit(False))


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(tokens of all texts with an end mark each, where each text begins)."""
    words = find_words(lowered(data), offsets)
    first = words.first + np.arange(len(words.first))
    out = np.empty(first[-1], np.uint64)
    ends = first[1:] - 1
    inside = np.ones(len(out), bool)
    inside[ends] = False
    out[ends] = END
    out[inside] = words.hashes()
    return out, first


def histories(found: np.ndarray, first: np.ndarray) -> np.ndarray:
    before = np.empty_like(found)
    before[1:] = found[:-1]
    before[first[:-1]] = START
    return before


def pair_keys(before: np.ndarray, found: np.ndarray) -> np.ndarray:
    """48 bits of hash in the upper bits of a word."""
    return mix(mix(before * PAIR) + found) & ~np.uint64(0xFFFF)


def places(keys: np.ndarray, level: int, bits: int, probes: int) -> tuple[np.ndarray, np.ndarray]:
    """(word of a slice of the filter, mask) of each probe: a hash of pair and level chooses the 512-bit line and the bits in it."""
    spread = mix(keys + np.uint64(level * int(STEP) % 2**64))
    line = ((spread >> np.uint64(32)) * np.uint64(bits // 512)) >> np.uint64(32)
    chosen = mix(spread + STEP)
    at = np.stack([(chosen >> np.uint64(9 * i)) & np.uint64(511) for i in range(probes)], axis=1)
    word = (line[:, None] << np.uint64(3)) | (at >> np.uint64(6))
    return word.astype(np.int64), np.uint64(1) << (at & np.uint64(63))


def _present(words: np.ndarray, keys: np.ndarray, level: int, probes: int) -> np.ndarray:
    at, mask = places(keys, level, len(words) * 64, probes)
    alive = np.ones(len(keys), bool)
    for i in range(probes):
        alive &= (words[at[:, i]] & mask[:, i]) != 0
    return alive


def levels(words: np.ndarray, keys: np.ndarray, probes: int, top: int = 64) -> np.ndarray:
    """The largest level, ``top`` at most, up to which every probe of a pair is found."""
    out = np.zeros(len(keys), np.int64)
    at, level = np.arange(len(keys)), 1
    while len(at) and level <= top:
        step = np.concatenate([
            _present(words, keys[at[i:i + 200_000]], level, probes) for i in range(0, len(at), 200_000)])
        at = at[step]
        out[at] = level
        level += 1
    return out


def _count_pairs(buckets: int):
    """Rows (bucket, kind, keys, counts) of stretches of text: kind 0 for single tokens, 1 for pairs."""
    kinds = {"bucket": pa.int32(), "kind": pa.int32(), "keys": pa.binary(), "counts": pa.binary()}

    def send(singles: list[np.ndarray], pairs: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        for kind, parts in enumerate((singles, pairs)):
            keys, counts = np.unique(np.concatenate(parts), return_counts=True)
            edges = slices(keys, buckets)
            out = {name: [] for name in kinds}
            for bucket in np.flatnonzero(np.diff(edges)).tolist():
                part = slice(edges[bucket], edges[bucket + 1])
                out["bucket"].append(bucket)
                out["kind"].append(kind)
                out["keys"].append(pack(keys[part]))
                out["counts"].append(pack(counts[part].astype(np.uint32)))
            yield pa.RecordBatch.from_arrays([pa.array(out[n], t) for n, t in kinds.items()], names=list(kinds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        singles, pairs, size = [], [], 0
        for batch in batches:
            for _, _, data, offsets in blocks(batch.column(0)):
                found, first = tokens(data, offsets)
                singles.append(found)
                pairs.append(pair_keys(histories(found, first), found))
                size += len(found)
                if size >= STRETCH:
                    yield from send(singles, pairs)
                    singles, pairs, size = [], [], 0
        if size:
            yield from send(singles, pairs)

    return run, "bucket int, kind int, keys binary, counts binary"


def _summed(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate([unpack(k, np.uint64) for k in rows["keys"].to_pylist()])
    counts = np.concatenate([unpack(c, np.uint32) for c in rows["counts"].to_pylist()]).astype(np.int64)
    keys, which = np.unique(keys, return_inverse=True)
    return keys, np.bincount(which, counts, len(keys)).astype(np.int64)


def _fill(settings: Settings):
    """(bucket, words, top, tokens, types, pairs): the slice of the filter that a bucket owns, its top level, and figures."""
    kinds = {"bucket": pa.int32(), "words": pa.binary(), "top": pa.int32(), "tokens": pa.int64(), "types": pa.int64(),
             "pairs": pa.int64()}

    def run(rows: pa.Table) -> pa.Table:
        kind = np.array(rows["kind"].to_pylist())
        single, pair = (rows.take(pa.array(np.flatnonzero(kind == k))) for k in (0, 1))
        counted = types = entered = most = 0
        words = np.zeros(0, np.uint64)
        if single.num_rows:
            _, counts = _summed(single)
            counted, types = int(counts.sum()), len(counts)
        if pair.num_rows:
            keys, counts = _summed(pair)
            top = np.frexp(counts.astype(np.float64))[1]  # 1 + floor(log2 c)
            entered, most = len(keys), int(top.max())
            words = np.zeros(-(-int(top.sum()) * settings.bits_per_pair // 512) * 8, np.uint64)
            for level in range(1, most + 1):
                at, mask = places(keys[top >= level], level, len(words) * 64, settings.probes)
                np.bitwise_or.at(words, at.reshape(-1), mask.reshape(-1))
        values = (rows["bucket"][0].as_py(), words.tobytes(), most, counted, types, entered)
        return pa.table({n: pa.array([v], t) for (n, t), v in zip(kinds.items(), values, strict=True)})

    return run, "bucket int, words binary, top int, tokens long, types long, pairs long"


@dataclass
class Model:
    """What learning leaves: the slices of the filter and the corpus figures."""

    slices: DataFrame  # (bucket, words, top), one row for each bucket with training tokens
    buckets: int
    tokens: int  # N
    types: int  # V
    texts: int
    pairs: int
    settings: Settings


def learn(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> Model:
    """Count the training texts and write the filter to the shared folder. Runs jobs; the driver receives only figures."""
    wanted = docs.where(~held_out(F.col(doc_id))).select(F.col(text).cast("string").alias("text"))
    # Sized by all texts: those held out ask the same buckets.
    size, texts = docs.agg(F.sum(F.octet_length(text)), F.count_if(~held_out(F.col(doc_id)))).first()
    buckets = bucket_count((size or 0) // 7, least=PARTS)
    count, schema = _count_pairs(buckets)
    fill, filled = _fill(settings)
    found = stored(wanted.mapInArrow(count, schema).groupBy("bucket").applyInArrow(fill, filled), "pair-filter")
    n_tokens, n_types, n_pairs = (n or 0 for n in found.agg(F.sum("tokens"), F.sum("types"), F.sum("pairs")).first())
    return Model(found.select("bucket", "words", "top"), buckets, n_tokens, n_types, texts, n_pairs, settings)


def _chunk_tokens(rows: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    rows = rows.sort_by([("doc_id", "ascending"), ("text", "ascending")])
    data, offsets = text_buffer(rows["text"])
    found, first = tokens(data, offsets)
    keys, which = np.unique(found, return_inverse=True)
    return rows, found, first, keys, which


def _chunk_pairs(found: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(pair_keys(histories(found, first), found), return_inverse=True)


def _ask(buckets: int):
    """Rows (bucket, chunk, keys, counts, pairs): the distinct tokens of a chunk, how often its training texts have them, and
    its distinct pairs."""
    kinds = {"bucket": pa.int32(), "chunk": pa.int32(), "keys": pa.binary(), "counts": pa.binary(), "pairs": pa.binary()}

    def run(rows: pa.Table) -> pa.Table:
        number = rows["chunk"][0].as_py()
        rows, found, first, keys, which = _chunk_tokens(rows)
        learned = ~np.array(rows["held_out"].to_pylist(), bool)
        counts = np.bincount(which[np.repeat(learned, np.diff(first))], minlength=len(keys))
        pairs, _ = _chunk_pairs(found, first)
        edges, pair_edges = slices(keys, buckets), slices(pairs, buckets)
        out = {name: [] for name in kinds}
        for bucket in np.flatnonzero(np.diff(edges) + np.diff(pair_edges)).tolist():
            part, pair_part = (slice(e[bucket], e[bucket + 1]) for e in (edges, pair_edges))
            values = (bucket, number, pack(keys[part]), pack(counts[part].astype(np.uint32)), pack(pairs[pair_part]))
            for name, value in zip(kinds, values, strict=True):
                out[name].append(value)
        return pa.table({n: pa.array(out[n], t) for n, t in kinds.items()})

    return run, "bucket int, chunk int, keys binary, counts binary, pairs binary"


def _answer(probes: int):
    """Rows (chunk, bucket, counts, levels): what the bucket knows of the tokens and pairs that each chunk asks for."""

    names = ["chunk", "bucket", "counts", "levels"]

    def run(rows: pa.Table, owned: pa.Table) -> pa.Table:
        if not rows.num_rows:  # nobody asks this bucket
            return pa.table([[], [], [], []], pa.schema(list(zip(names, [pa.int32()] * 2 + [pa.binary()] * 2, strict=True))))
        keys, total = _summed(rows)
        counts = [pack(total[np.searchsorted(keys, unpack(k, np.uint64))]) for k in rows["keys"].to_pylist()]
        asked = [unpack(p, np.uint64) for p in rows["pairs"].to_pylist()]
        pairs, which = np.unique(np.concatenate(asked), return_inverse=True)
        level = np.zeros(len(pairs), np.uint8)  # a bucket without training pairs knows none
        if owned.num_rows and owned["top"][0].as_py():
            words = np.frombuffer(owned["words"][0].as_py(), np.uint64)
            level = levels(words, pairs, probes, owned["top"][0].as_py()).astype(np.uint8)
        found = np.split(level[which], np.cumsum([len(p) for p in asked])[:-1])
        return pa.table(dict(zip(names, [
            rows["chunk"], rows["bucket"], pa.array(counts, pa.binary()),
            pa.array([f.tobytes() for f in found], pa.binary())], strict=True)))

    return run, "chunk int, bucket int, counts binary, levels binary"


def _score(model: Model):
    settings = model.settings
    n_tokens, n_types, texts = model.tokens, model.types, model.texts
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def run(rows: pa.Table, answers: pa.Table) -> pa.Table:
        rows, found, first, keys, which = _chunk_tokens(rows)
        answers = answers.sort_by("bucket")
        count = np.concatenate([unpack(c, np.int64) for c in answers["counts"].to_pylist()])[which]
        alone = (count + 1) / (n_tokens + n_types + 1)
        before = np.empty_like(count)
        before[1:] = count[:-1]
        before[first[:-1]] = texts
        bound = np.minimum(before, count)
        _, of = _chunk_pairs(found, first)
        level = np.frombuffer(b"".join(answers["levels"].to_pylist()), np.uint8).astype(np.int64)[of]
        # The middle of the counts of a level, at most what the two tokens allow.
        together = np.where(level > 1, 1.4 * np.exp2(level - 1), level)
        together = np.minimum(together, bound)
        novel = before.astype(np.float64) ** settings.novelty
        both = np.where(before > 0, (together + novel * alone) / np.maximum(before + novel, 1), alone)
        add = lambda values: np.add.reduceat(values, first[:-1])  # noqa: E731  every text has its end mark
        return pa.table(dict(zip(names, [
            rows["doc_id"], rows["held_out"], pa.array(np.diff(first), pa.int64()),
            pa.array(add((count > 0).astype(np.int64)), pa.int64()),
            pa.array(np.full(rows.num_rows, n_tokens), pa.int64()),
            pa.array(add(np.log10(alone))), pa.array(add(np.log10(both))),
        ], strict=True)))

    return run, (
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row; scores are log10.

    ``docs`` is the corpus the model was learned from: exact counts come from its training texts. A null or empty text is one end
    mark. Rows that share an id are scored one by one; a row without an id counts as training text. A very long text is
    held whole by one task. Other columns are dropped.
    """
    size, rows = text_bytes(docs, text)
    parts = chunked(docs, doc_id, text, size, rows).withColumn("held_out", held_out(F.col("doc_id")))
    ask, schema = _ask(model.buckets)
    answer, answered = _answer(model.settings.probes)
    asked = parts.groupBy("chunk").applyInArrow(ask, schema)
    known = asked.groupBy("bucket").cogroup(model.slices.groupBy("bucket")).applyInArrow(answer, answered)
    run, schema = _score(model)
    return parts.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(run, schema)
