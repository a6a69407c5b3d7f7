"""Substring dedup by relative Lempel-Ziv parsing.

The reference of a document is everything that comes before it, by document id and place. The corpus is cut into chunks;
every chunk is a reference block that is indexed once and against which all others are parsed:

1. Of each window of ``window`` words the smallest hash of its inner runs of ``anchor`` words is taken. Equal windows
   have equal anchors, so a window whose anchor occurs once in the corpus needs no further look. A chunk sends its
   distinct anchors to buckets by hash and gets back which of them are met elsewhere.
2. The remaining distinct windows of the chunk go to buckets by their own hash (80 bits) with their first place. A bucket
   knows the first place of each window in all blocks and answers with the source, from which later places copy.
3. Every document is parsed from left to right: a factor starts at the first window that has an earlier source and
   goes on while the next window continues the same source. Windows over the edge of two factors have an answer of
   their own and start a factor as well. Factors of at least ``window`` words become duplicate spans.

Every window is looked up, not only those at the edges of factors that were extended word by word: which words go follows from the
answers alone, and factors group them to spans.

A chunk sends a window once, however many of its documents hold it, so a passage that a third of all documents share
brings a bucket one entry for each chunk. Texts are shuffled once; the three passes read the same exchange.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .tables import bucket_count, chunked, pack, slices, text_bytes, unpack
from .words import Words, find_words, mix, sequence_hashes, text_buffer

WINDOW = 20
ANCHOR = 8
NO_ID = np.iinfo(np.int64).max  # rows without an id come last

SPANS = "array<struct<start:long,length:long>>"


class Chunk:
    """The documents of one chunk in the order of the corpus, with their windows."""

    def __init__(self, rows: pa.Table, window: int) -> None:
        rows = rows.combine_chunks()
        rows = rows.sort_by([("doc_id", "ascending"), ("text", "ascending")])
        self.ids = rows["doc_id"]
        self.texts = rows["text"]
        self.rows = rows
        self.order = np.array([NO_ID if i is None else i for i in self.ids.to_pylist()], np.int64)
        data, offsets = text_buffer(rows["text"])
        self.words: Words = find_words(data, offsets)
        self.hashes = self.words.hashes()
        self.owners = self.words.owners()
        self.window = window
        self.starts = self._inside(window)
        self.keys = sequence_hashes(self.hashes, window, 7)[self.starts]

    def _inside(self, width: int) -> np.ndarray:
        count = len(self.hashes) - width + 1
        if count <= 0:
            return np.zeros(0, np.int64)
        return np.flatnonzero(self.owners[:count] == self.owners[width - 1:])

    def distinct(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(sorted distinct window keys, the first place of each, the key of each window)."""
        keys, first, which = np.unique(self.keys, return_index=True, return_inverse=True)
        return keys, self.starts[first], which

    def anchors(self, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(sorted distinct anchors, whether each occurs twice here, the anchor of each window)."""
        runs = sequence_hashes(self.hashes, width, 11)
        if not len(self.starts):
            return np.zeros(0, np.uint64), np.zeros(0, bool), np.zeros(0, np.int64)
        all_runs, counts = np.unique(runs[self._inside(width)], return_counts=True)
        least, reach, span = runs, 1, self.window - width + 1
        while 2 * reach <= span:
            least, reach = np.minimum(least[:-reach], least[reach:]), 2 * reach
        if span > reach:
            least = np.minimum(least[:len(least) - (span - reach)], least[span - reach:])
        anchors, which = np.unique(least[self.starts], return_inverse=True)
        return anchors, counts[np.searchsorted(all_runs, anchors)] > 1, which


def _rows(columns: dict[str, list], kinds: dict[str, pa.DataType]) -> pa.Table:
    return pa.table({name: pa.array(columns[name], kind) for name, kind in kinds.items()})


def _send_anchors(buckets: int, window: int, anchor: int):
    kinds = {"bucket": pa.int32(), "chunk": pa.int32(), "keys": pa.binary(), "twice": pa.binary()}

    def run(rows: pa.Table) -> pa.Table:
        number = rows["chunk"][0].as_py()
        anchors, twice, _ = Chunk(rows, window).anchors(anchor)
        edges = slices(anchors, buckets)
        out = {name: [] for name in kinds}
        for bucket in np.flatnonzero(np.diff(edges)).tolist():
            part = slice(edges[bucket], edges[bucket + 1])
            for name, value in zip(kinds, (
                    bucket, number, pack(anchors[part] >> np.uint64(16)), np.packbits(twice[part]).tobytes()), strict=True):
                out[name].append(value)
        return _rows(out, kinds)

    return run, "bucket int, chunk int, keys binary, twice binary"


def _meet_anchors():
    kinds = {"chunk": pa.int32(), "bucket": pa.int32(), "met": pa.binary()}

    def run(rows: pa.Table) -> pa.Table:
        keys = [unpack(k, np.uint64) for k in rows["keys"].to_pylist()]
        sizes = [len(k) for k in keys]
        twice = np.concatenate([
            np.unpackbits(np.frombuffer(t, np.uint8), count=n).astype(np.int64)
            for t, n in zip(rows["twice"].to_pylist(), sizes, strict=True)])
        _, which = np.unique(np.concatenate(keys), return_inverse=True)
        met = np.bincount(which, 1 + twice)[which] > 1
        cuts = np.split(met, np.cumsum(sizes)[:-1])
        out = {"chunk": rows["chunk"].to_pylist(), "bucket": rows["bucket"].to_pylist(),
               "met": [np.packbits(c).tobytes() for c in cuts]}
        return _rows(out, kinds)

    return run, "chunk int, bucket int, met binary"


def _send_windows(buckets: int, window: int, anchor: int):
    kinds = {"bucket": pa.int32(), "chunk": pa.int32(), "keys": pa.binary(), "more": pa.binary(), "doc": pa.binary(),
             "place": pa.binary(), "rank": pa.binary()}

    def run(rows: pa.Table, answers: pa.Table) -> pa.Table:
        out = {name: [] for name in kinds}
        if not rows.num_rows or not answers.num_rows:
            return _rows(out, kinds)
        number = rows["chunk"][0].as_py()
        chunk = Chunk(rows, window)
        anchors, _, which = chunk.anchors(anchor)
        edges = slices(anchors, buckets)
        met = np.zeros(len(anchors), bool)
        for bucket, bits in zip(answers["bucket"].to_pylist(), answers["met"].to_pylist(), strict=True):
            size = edges[bucket + 1] - edges[bucket]
            met[edges[bucket]:edges[bucket + 1]] = np.unpackbits(np.frombuffer(bits, np.uint8), count=size)
        keys, place, of = chunk.distinct()
        wanted = np.zeros(len(keys), bool)
        wanted[of[met[which]]] = True
        rank = np.flatnonzero(wanted)
        keys, place = keys[rank], place[rank]
        owner = chunk.owners[place]
        more = sequence_hashes(chunk.hashes, window, 13)[place] >> np.uint64(48)
        offset = place - chunk.words.first[owner]
        edges = slices(keys, buckets)
        for bucket in np.flatnonzero(np.diff(edges)).tolist():
            part = slice(edges[bucket], edges[bucket + 1])
            for name, value in zip(kinds, (
                    bucket, number, pack(keys[part]), pack(more[part].astype(np.uint16)),
                    pack(chunk.order[owner[part]]), pack(offset[part].astype(np.uint32)),
                    pack(np.diff(rank[part], prepend=0).astype(np.uint32))), strict=True):
                out[name].append(value)
        return _rows(out, kinds)

    return run, ("bucket int, chunk int, keys binary, more binary, doc binary, place binary, rank binary")


def _find_sources():
    kinds = {"chunk": pa.int32(), "rank": pa.binary(), "source": pa.binary()}

    def run(rows: pa.Table) -> pa.Table:
        read = lambda name, kind: [unpack(x, kind) for x in rows[name].to_pylist()]
        keys = read("keys", np.uint64)
        sizes = np.array([len(k) for k in keys])
        rank = np.concatenate([np.cumsum(r) for r in read("rank", np.uint32)])
        keys, more = np.concatenate(keys), np.concatenate(read("more", np.uint16))
        doc, place = np.concatenate(read("doc", np.int64)), np.concatenate(read("place", np.uint32))
        row = np.repeat(np.arange(len(sizes)), sizes)
        chunk = np.array(rows["chunk"].to_pylist())[row]
        order = np.lexsort((place, chunk, doc, more, keys))
        sorted_keys, sorted_more = keys[order], more[order]
        new = np.ones(len(order), bool)
        new[1:] = (sorted_keys[1:] != sorted_keys[:-1]) | (sorted_more[1:] != sorted_more[:-1])
        head = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
        tag = (mix(doc[head].astype(np.uint64)) + place[head]).astype(np.uint32)
        later = np.zeros(len(order), bool)
        source = np.zeros(len(order), np.uint32)
        later[order], source[order] = ~new, tag
        out = {name: [] for name in kinds}
        for i, (a, b) in enumerate(zip(np.cumsum(sizes) - sizes, np.cumsum(sizes), strict=True)):
            part = np.flatnonzero(later[a:b]) + a
            if len(part):
                out["chunk"].append(int(chunk[a]))
                out["rank"].append(pack(np.diff(rank[part], prepend=0).astype(np.uint32)))
                out["source"].append(pack(source[part]))
        return _rows(out, kinds)

    return run, "chunk int, rank binary, source binary"


def factors(starts: np.ndarray, source: np.ndarray, owners: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Greedy factors (first word, words) from the windows with an earlier source, in the order of the text."""
    if not len(starts):
        return starts, starts
    cut = np.ones(len(starts), bool)
    cut[1:] = (
        (starts[1:] != starts[:-1] + 1) | (source[1:] != (source[:-1] + np.uint32(1)))
        | (owners[starts[1:]] != owners[starts[:-1]]))
    head = np.flatnonzero(cut)
    return starts[head], np.diff(np.append(head, len(starts))) + window - 1


def _parse(window: int, original: bool, carry: tuple[str, ...]):
    kinds = {"doc_id": pa.int64(), "n_words": pa.int64(), "n_removed": pa.int64(), "kept_text": pa.string(),
             "spans": pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))}

    def run(rows: pa.Table, answers: pa.Table) -> pa.Table:
        chunk = Chunk(rows, window)
        words = chunk.words
        _, place, of = chunk.distinct()
        first_at = place[of]
        known = np.zeros(len(place), bool)
        tags = np.zeros(len(place), np.uint32)
        for rank, source in zip(answers["rank"].to_pylist(), answers["source"].to_pylist(), strict=True):
            at = np.cumsum(unpack(rank, np.uint32))
            known[at], tags[at] = True, unpack(source, np.uint32)
        # A window copies from the first place of all blocks, or from the first place in this one.
        here = (mix(chunk.order[chunk.owners[place]].astype(np.uint64))
                + (place - words.first[chunk.owners[place]]).astype(np.uint64)).astype(np.uint32)
        source = np.where(known, tags, here)[of]
        later = known[of] | (first_at != chunk.starts)
        begin, length = factors(chunk.starts[later], source[later], chunk.owners, window)
        covered = np.zeros(len(words.starts) + 1, np.int64)
        np.add.at(covered, begin, 1)
        np.add.at(covered, begin + length, -1)
        gone = np.cumsum(covered[:-1]) > 0
        total = np.concatenate([[0], np.cumsum(gone)])
        removed = total[words.first[1:]] - total[words.first[:-1]]
        raw = words.data.tobytes()
        starts, ends = words.starts.tolist(), words.ends.tolist()
        factor_owner = chunk.owners[begin] if len(begin) else begin
        factor_cut = np.searchsorted(factor_owner, np.arange(len(chunk.order) + 1))
        texts, spans = [], []
        for i, (a, b) in enumerate(zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True)):
            if original and not removed[i]:
                texts.append(chunk.texts[i].as_py())
            elif removed[i]:
                texts.append(b" ".join([raw[starts[j]:ends[j]] for j in (np.flatnonzero(~gone[a:b]) + a).tolist()]).decode())
            else:
                texts.append(b" ".join([raw[starts[j]:ends[j]] for j in range(a, b)]).decode())
            spans.append([{"start": int(s) - a, "length": int(n)} for s, n in zip(
                begin[factor_cut[i]:factor_cut[i + 1]], length[factor_cut[i]:factor_cut[i + 1]], strict=True)])
        out = _rows({"doc_id": chunk.ids.to_pylist(), "n_words": words.counts, "n_removed": removed,
                     "kept_text": texts, "spans": spans}, kinds)
        for name in carry:
            out = out.append_column(name, chunk.rows[name])
        return out

    return run, f"doc_id long, n_words long, n_removed long, kept_text string, spans {SPANS}"


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, anchor: int = ANCHOR,
    original: bool = False, carry: tuple[str, ...] = (),
) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text, spans, carried columns): every word in a window that also starts earlier is removed.

    ``kept_text`` has the kept words with single spaces; with ``original`` a document that loses nothing keeps its text
    as it was. ``spans`` are the factors, in words, which may overlap. Windows are judged on the input. A null or empty
    text has no words. Rows that share an id come in the order of their texts and keep a row each; rows without an id come
    last. A very long text is held whole by one task. Columns that are not carried are dropped. Sizing the chunks is one aggregation over the table when this is called.
    """
    size, count = text_bytes(docs, text)
    buckets = bucket_count(size // 20)
    parts = chunked(docs, doc_id, text, size, count, carry=carry)
    chunks = lambda: parts.groupBy("chunk")
    send, schema = _send_anchors(buckets, window, anchor)
    meet, met_schema = _meet_anchors()
    met = chunks().applyInArrow(send, schema).groupBy("bucket").applyInArrow(meet, met_schema)
    send, schema = _send_windows(buckets, window, anchor)
    found, found_schema = _find_sources()
    sources = (
        chunks().cogroup(met.groupBy("chunk")).applyInArrow(send, schema)
        .groupBy("bucket").applyInArrow(found, found_schema))
    parse, parse_schema = _parse(window, original, carry)
    parse_schema += "".join(f", `{name}` {docs.schema[name].dataType.simpleString()}" for name in carry)
    return chunks().cogroup(sources.groupBy("chunk")).applyInArrow(parse, parse_schema)
