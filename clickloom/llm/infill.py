"""Fill-in-the-middle documents, cut at line ends that a compressed boundary set selects.

The places where a text may be cut are the byte offsets 0 and behind each of its lines. They are kept as a set of containers, one for each
2**16 offsets that hold any: a sorted array where few are set, runs where neighbours are set, a bitmap where many are. Containers carry
cumulative cardinalities, so the k-th boundary is found by a search over containers and a select inside one of them. A cut after k lines is
the k-th boundary; two selects give both offsets, and the parts are slices of the text's own bytes.

A line is a run of characters up to and with a line feed, or what stands after the last one. Which documents are cut, where, and in which
order the parts stand follow from a hash of the seed and the document's id, so the output doesn't depend on partitions or retries.

Texts are worked on in blocks of Arrow batches; a document needs room for its boundaries, at most two bytes for a line or 8 KiB for 65,536
bytes of text. Rebuilding the text from an output takes DataFrame functions only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .words import blocks

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
CONTAINER_BITS = 16
BITMAP_BYTES = 1 << (CONTAINER_BITS - 3)


@dataclass(frozen=True)
class Settings:
    seed: int = 7
    cut_percent: int = 100  # of the documents that can be cut; the others stay plain
    suffix_first_percent: int = 50


class ArrayContainer:
    def __init__(self, low: np.ndarray):
        self.low = low.astype(np.uint16)

    def select(self, rank: int) -> int:
        return int(self.low[rank])


class RunContainer:
    def __init__(self, low: np.ndarray):
        first = np.flatnonzero(np.diff(low, prepend=-2) != 1)
        self.starts = low[first].astype(np.uint16)
        self.before = first.astype(np.int32)  # members ahead of each run

    def select(self, rank: int) -> int:
        run = int(np.searchsorted(self.before, rank, "right")) - 1
        return int(self.starts[run]) + rank - int(self.before[run])


class BitmapContainer:
    def __init__(self, low: np.ndarray):
        bits = np.zeros(1 << CONTAINER_BITS, np.uint8)
        bits[low] = 1
        self.words = np.packbits(bits, bitorder="little").view("<u8")
        self.upto = np.cumsum(np.bitwise_count(self.words), dtype=np.int32)

    def select(self, rank: int) -> int:
        word = int(np.searchsorted(self.upto, rank, "right"))
        left = rank - (int(self.upto[word - 1]) if word else 0)
        bits = np.unpackbits(self.words[word:word + 1].view(np.uint8), bitorder="little")
        return 64 * word + int(np.flatnonzero(bits)[left])


def container(low: np.ndarray) -> ArrayContainer | RunContainer | BitmapContainer:
    """The smallest form for ascending distinct numbers under 2**16."""
    runs = 1 + int(np.count_nonzero(np.diff(low) != 1))
    sizes = {ArrayContainer: 2 * len(low), RunContainer: 6 * runs, BitmapContainer: BITMAP_BYTES + 4 * (BITMAP_BYTES // 8)}
    return min(sizes, key=sizes.get)(low)


class BoundarySet:
    """Ascending distinct offsets with select."""

    def __init__(self, offsets: np.ndarray):
        high = offsets >> CONTAINER_BITS
        first = np.flatnonzero(np.diff(high, prepend=-1))
        stops = [*first[1:].tolist(), len(offsets)][:len(first)]
        low = offsets & ((1 << CONTAINER_BITS) - 1)
        self.keys = high[first]
        self.containers = [container(low[a:b]) for a, b in zip(first.tolist(), stops, strict=True)]
        self.upto = np.array(stops, np.int64)  # members up to and with each container

    def __len__(self) -> int:
        return int(self.upto[-1]) if len(self.upto) else 0

    def select(self, rank: int) -> int:
        """The offset with ``rank`` smaller ones in the set."""
        if not 0 <= rank < len(self):
            raise IndexError(rank)
        at = int(np.searchsorted(self.upto, rank, "right"))
        inside = rank - (int(self.upto[at - 1]) if at else 0)
        return (int(self.keys[at]) << CONTAINER_BITS) + self.containers[at].select(inside)


def draws(seed: int, doc_id: int | None) -> tuple[int, int, int, int]:
    """The first four 32-bit numbers of the hash of a document; without an id that of the seed alone."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[i:i + 4], "big") for i in (0, 4, 8, 12))


def _format(settings: Settings):
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    prefix_mark, suffix_mark, middle_mark = marks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for start, stop, data, offsets in blocks(batch.column(1)):
                ends = np.flatnonzero(data == 10) + 1
                first = np.searchsorted(ends, offsets, "right")
                chars = np.cumsum((data & 0xC0) != 0x80, dtype=np.int64)
                count = lambda a, b, chars=chars: int(chars[b - 1] - (chars[a - 1] if a else 0)) if b > a else 0
                rows = []
                for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
                    inner = ends[first[i]:first[i + 1]] - a
                    loose = b > a and (not len(inner) or inner[-1] != b - a)
                    n = len(inner) + loose
                    text = data[a:b].tobytes()
                    one, two, three, four = draws(settings.seed, ids[start + i])
                    if not text or three % 100 >= settings.cut_percent or any(m in text for m in marks):
                        rows.append((n, "plain", None, None, text))
                        continue
                    allowed = BoundarySet(np.concatenate([[0], inner, [b - a] if loose else []]).astype(np.int64))
                    low, high = (allowed.select(k) for k in sorted((one % (n + 1), two % (n + 1))))
                    prefix, middle, suffix = text[:low], text[low:high], text[high:]
                    if four % 100 < settings.suffix_first_percent:
                        form, parts = "spm", (suffix_mark, suffix, prefix_mark, prefix, middle_mark, middle)
                    else:
                        form, parts = "psm", (prefix_mark, prefix, suffix_mark, suffix, middle_mark, middle)
                    rows.append((n, form, count(a, a + low), count(a + low, a + high), b"".join(parts)))
                n, form, before, inside, output = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(start, stop - start), pa.array(n, pa.int64()), pa.array(form, pa.string()),
                    pa.array(before, pa.int64()), pa.array(inside, pa.int64()),
                    pa.array(output, pa.binary()).cast(pa.string()),
                ], names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def fill_in_middle(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", settings: Settings = Settings(),
) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) for every row.

    ``n`` counts lines. ``form`` is ``psm``, ``spm`` or ``plain``; a text that is null or empty or holds one of the marks is plain, as are those
    that ``cut_percent`` leaves out, and has null sizes. Prefix and middle may be empty. Rows that share an id are cut by the same draws, so
    repeated rows give repeated outputs; rows without an id share the draws of the seed alone. Other columns are dropped. A text is one value
    and is held whole by its task.
    """
    run, schema = _format(settings)
    wanted = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return wanted.mapInArrow(run, schema)


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made from. No part holds a mark, so the first of each is the one that was put in."""
    body = F.substring(output, F.lit(len(PREFIX) + 1), F.length(output))
    cut = F.when(form == "psm", F.locate(SUFFIX, body)).otherwise(F.locate(PREFIX, body))
    middle = F.locate(MIDDLE, body)
    first = F.substring(body, F.lit(1), cut - 1)
    second = F.substring(body, cut + len(PREFIX), middle - cut - len(PREFIX))
    third = F.substring(body, middle + len(MIDDLE), F.length(body))
    return (
        F.when(form == "plain", output).when(form == "psm", F.concat(first, third, second))
        .otherwise(F.concat(second, third, first)))
