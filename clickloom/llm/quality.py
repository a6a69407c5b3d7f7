"""Line-first cleaning: judge every line, take out those that fail, then reject documents that lose too much text.

Rules of a line (only lines with a word are judged):

* punctuation: most of its words carry signs such as ``#*$%&|<>``, or it shouts, that is more than every third word
  ends in ``!`` or ``?`` and nearly all of its letters are capitals;
* repetition: most of its words equal the word before them;
* navigation: many of its words are nothing but separators (``|`` and the like), or it is all separators and digits;
* boilerplate: it is short and holds a phrase of page furniture.

Figures of the whole text are counted beside them: words, their characters, symbols, repeated lines, and words in
eight-word windows that occur at least twice. A document fails the base rules with fewer than 20 words or with more than 30 %
of its words in repeated windows. It is kept if it passes those and loses at most half of its word characters.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import Words, blocks, find_words, mix, sequence_hashes


def _table(signs: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(signs)] = True
    return table


SYMBOLS = _table(b"#*$%&|<>")
SEPARATORS = _table(b"|/\\>-*=_~+:;.,")
SHOUTS = _table(b"!?")
CAPITALS = _table(bytes(range(65, 91)))
SMALL = _table(bytes(range(97, 123)))
DIGITS = _table(bytes(range(48, 58)))

PHRASES = re.compile(
    rb"all rights reserved|privacy policy|terms of (?:use|service)|cookie policy|we use cookies|accept cookies|"
    rb"sign in|log in|subscribe to|newsletter|click here|read more|share on|skip to (?:main )?content|"
    rb"enable javascript|back to top|lorem ipsum|powered by|site map", re.IGNORECASE)


@dataclass(frozen=True)
class Rules:
    window: int = 8
    min_words: int = 20
    max_repeat_percent: int = 30
    max_symbols: float = 0.5  # symbols for each word of a line
    min_shouts: float = 1 / 3
    max_separators: float = 0.3  # words that are only separators
    max_echo: float = 0.5  # words that equal the one before
    phrase_words: int = 12
    max_loss: float = 0.5  # of the word characters


def _between(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[ends] - total[starts]


def _per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[first[1:]] - total[first[:-1]]


def repeated_words(words: Words, hashes: np.ndarray, owners: np.ndarray, width: int) -> np.ndarray:
    """Flags of the words in a window of ``width`` words that occurs at least twice in its text."""
    count = len(hashes) - width + 1
    covered = np.zeros(len(hashes) + 1, np.int64)
    if count > 0:
        inside = np.flatnonzero(owners[:count] == owners[width - 1:])
        keys = sequence_hashes(hashes, width)[inside]
        keys = mix(keys + owners[inside].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        _, which, times = np.unique(keys, return_inverse=True, return_counts=True)
        found = inside[times[which] > 1]
        np.add.at(covered, found, 1)
        np.add.at(covered, found + width, -1)
    return np.cumsum(covered[:-1]) > 0


def judge_block(data: np.ndarray, offsets: np.ndarray, rules: Rules) -> dict[str, object]:
    words = find_words(data, offsets)
    hashes, owners, count = words.hashes(), words.owners(), len(words.starts)
    starts, ends, first = words.starts, words.ends, words.first
    whole = (offsets[:-1], offsets[1:])
    letters = (data & 0xC0) != 0x80
    signs = SYMBOLS[data]
    characters = _between(letters, starts, ends)

    # Lines with a word, as runs of words.
    breaks = np.flatnonzero(data == 10)
    number = np.searchsorted(breaks, starts)
    new = np.ones(count, bool)
    new[1:] = (number[1:] != number[:-1]) | (owners[1:] != owners[:-1])
    head = np.flatnonzero(new)
    lines = len(head)
    until = np.append(head[1:], count)
    line_owner = owners[head]
    bounded = np.concatenate([[-1], breaks, [len(data)]])
    line_start = np.maximum(bounded[number[head]] + 1, offsets[line_owner])
    line_end = np.minimum(bounded[number[head] + 1], offsets[line_owner + 1])
    line_first = np.searchsorted(line_owner, np.arange(len(offsets)))

    line_words = Words(data, offsets, line_start, line_end, line_first).hashes()
    keys = mix(line_words + line_owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, example = np.unique(keys, return_index=True)
    distinct = np.zeros(lines, bool)
    distinct[example] = True

    size = until - head
    pair = (starts[head], ends[until - 1]) if lines else (starts, ends)
    only = _between(~SEPARATORS[data], starts, ends) == 0
    bare = _between(~(SEPARATORS | DIGITS)[data], starts, ends) == 0
    shouting = SHOUTS[data[ends - 1]] if count else only
    capital, small = _between(CAPITALS[data], *pair), _between(SMALL[data], *pair)
    per_line = lambda flags: np.add.reduceat(flags.astype(np.int64), head) if lines else np.zeros(0, np.int64)
    failed = _between(signs, *pair) > rules.max_symbols * size
    failed |= (per_line(shouting) > rules.min_shouts * size) & (capital > 4 * small) & (size >= 3)
    failed |= (per_line(only) > rules.max_separators * size) | (per_line(bare) == size)
    echo = np.zeros(count, bool)
    echo[1:] = (hashes[1:] == hashes[:-1]) & ~new[1:]
    failed |= (per_line(echo) > rules.max_echo * size) & (size >= rules.window)
    raw = data.tobytes()
    for line in np.flatnonzero((size <= rules.phrase_words) & ~failed).tolist():
        failed[line] = PHRASES.search(raw, line_start[line], line_end[line]) is not None

    n_words = words.counts
    repeats = _per_text(repeated_words(words, hashes, owners, rules.window), first)
    word_chars = _per_text(characters, first)
    lost = _per_text(np.add.reduceat(characters, head) * failed if lines else np.zeros(0, np.int64), line_first)
    base = (n_words < rules.min_words) | (100 * repeats > rules.max_repeat_percent * n_words)
    removed = _per_text(failed, line_first)
    return {
        "n_words": n_words, "word_chars": word_chars, "n_symbols": _between(signs, *whole),
        "n_dup_lines": _per_text(~distinct, line_first), "n_repeat_words": repeats, "base_failed": base,
        "n_lines": np.diff(line_first), "n_lines_removed": removed, "lost_chars": lost,
        "kept": ~base & (lost <= rules.max_loss * word_chars),
        "cut": (removed, line_first, failed, line_start, line_end),
    }


def _cleaned(texts: pa.Array, data: np.ndarray, offsets: np.ndarray, cut: tuple) -> list[str | None]:
    removed, line_first, failed, line_start, line_end = cut
    out = texts.to_pylist()
    for i in np.flatnonzero(removed):
        raw, base = data[offsets[i]:offsets[i + 1]].tobytes(), offsets[i]
        drop = [(a - base, b - base) for a, b, f in zip(
            line_start[line_first[i]:line_first[i + 1]], line_end[line_first[i]:line_first[i + 1]],
            failed[line_first[i]:line_first[i + 1]], strict=True) if f]
        parts, at = [], 0
        for a, b in drop:  # with the line break that ends it
            parts.append(raw[at:a])
            at = min(b + 1, len(raw))
        out[i] = (b"".join(parts) + raw[at:]).decode("utf-8")
    return out


SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, n_lines long, n_lines_removed long, lost_chars long"
)
FIGURES = [part.split()[0] for part in SCHEMA.split(", ")[1:]]


def clean(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rules: Rules = Rules(), with_text: bool = True,
) -> DataFrame:
    """One row per document: its figures, the verdict ``kept`` and ``clean_text``, the text without failing lines.

    Null and empty texts have no words, fail the base rules and stay as they are. Every row is judged by itself, so null
    or repeated ids are carried through; a text of any length is one block. Other columns are dropped.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.columns
            for start, stop, data, offsets in blocks(texts):
                found = judge_block(data, offsets, rules)
                columns = [ids.slice(start, stop - start), *[pa.array(found[name]) for name in FIGURES]]
                names = ["doc_id", *FIGURES]
                if with_text:
                    part = texts.slice(start, stop - start)
                    columns.append(pa.array(_cleaned(part, data, offsets, found["cut"]), pa.string()))
                    names.append("clean_text")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    pairs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return pairs.mapInArrow(run, SCHEMA + (", clean_text string" if with_text else ""))


def keep_clean(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: str = "n_chars", rules: Rules = Rules(),
) -> DataFrame:
    """The kept rows of ``docs`` with their failing lines taken out; ``size`` is counted again where a text changed.

    A row that loses no line is returned as it was. Ids and other columns may be null and are carried along.
    """
    columns, schema = docs.columns, docs.schema
    text_at, size_at = columns.index(text), columns.index(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text_at)
            for start, stop, data, offsets in blocks(texts):
                found = judge_block(data, offsets, rules)
                keep = np.flatnonzero(found["kept"])
                if not len(keep):
                    continue
                part = batch.slice(start, stop - start)
                cleaned = _cleaned(part.column(text_at), data, offsets, found["cut"])
                sizes = part.column(size_at).to_pylist()
                for i in np.flatnonzero(found["n_lines_removed"]).tolist():
                    sizes[i] = len(cleaned[i])
                out = part.columns
                out[text_at] = pa.array(cleaned, part.column(text_at).type)
                out[size_at] = pa.array(sizes, part.column(size_at).type)
                yield pa.RecordBatch.from_arrays(out, names=columns).take(pa.array(keep))

    return docs.mapInArrow(run, schema)
