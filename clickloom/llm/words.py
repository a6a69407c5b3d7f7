"""Words, word hashes and shingle hashes of whole Arrow batches of text, without a loop over words.

A word is a maximal run of bytes other than space and the bytes 9 to 13. All of those are ASCII, so cutting the
UTF-8 bytes gives the same words as cutting the characters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# Texts are worked on in blocks of about this many bytes; a longer text is a block of its own.
BLOCK_BYTES = 2 * 1024 * 1024

_RANDOM = np.random.default_rng(20240)
_BYTE_KEYS = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_UNBASE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))


class Cache(dict):
    """A dictionary that travels empty when a function that uses it is sent to a worker."""

    def __reduce__(self):
        return Cache, ()


_POWERS = Cache()


def _powers(base: np.uint64, count: int) -> np.ndarray:
    have = _POWERS.get(int(base))
    if have is None or len(have) < count:
        size = 1 << max(16, (count - 1).bit_length())
        have = np.full(size, base, np.uint64)
        have[0] = 1
        have = np.cumprod(have, dtype=np.uint64)
        if size <= 2 * BLOCK_BYTES:
            _POWERS[int(base)] = have
    return have[:count]


def mix(values: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits."""
    values = values ^ (values >> np.uint64(30))
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the offset of each; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], np.int64, len(texts) + 1, texts.offset * 8) if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


@dataclass
class Words:
    """Words of some texts: the bytes, where words start and end, and the range of words of each text."""

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # one more than there are texts

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word, the same wherever the word stands."""
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        keyed = _BYTE_KEYS[self.data]
        keyed *= _powers(_BASE, len(keyed))
        total = np.cumsum(keyed, dtype=np.uint64)
        before = np.where(self.starts > 0, total[self.starts - 1], np.uint64(0))
        sums = (total[self.ends - 1] - before) * _powers(_UNBASE, len(keyed))[self.starts]
        return mix(sums + (self.ends - self.starts).astype(np.uint64))

    def owners(self) -> np.ndarray:
        """The text that each word belongs to."""
        return np.repeat(np.arange(len(self.counts)), self.counts)


def find_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    inside = np.zeros(len(data) + 2, bool)
    np.logical_not(SPACE[data], out=inside[1:-1])
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | cut[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | cut[1:])) + 1
    return Words(data, offsets, starts, ends, np.searchsorted(starts, offsets))


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, every other byte as it is."""
    return LOWER[data]


def blocks(texts: pa.Array, block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(from, to, bytes, offsets) for runs of texts of about ``block_bytes``."""
    data, offsets = text_buffer(texts)
    start = 0
    while start < len(offsets) - 1:
        stop = int(np.searchsorted(offsets, offsets[start] + block_bytes, "right")) - 1
        stop = max(stop, start + 1)
        yield start, stop, data[offsets[start]:offsets[stop]], offsets[start:stop + 1] - offsets[start]
        start = stop


def sequence_hashes(hashes: np.ndarray, width: int, seed: int = 1) -> np.ndarray:
    """A hash of each run of ``width`` consecutive values; runs over the edges of texts are the caller's to leave out."""
    count = len(hashes) - width + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    keys = np.random.default_rng(seed).integers(1, 2**63, width, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    total = np.zeros(count, np.uint64)
    for i, key in enumerate(keys):
        total += hashes[i:i + count] * key
    return mix(total)
