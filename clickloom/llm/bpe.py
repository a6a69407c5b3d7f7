"""BPE encoding and decoding with a tokenization automaton.

The merges of a byte-level BPE vocabulary are compiled into a deterministic automaton whose arcs are labelled with
tokens and whose paths are exactly the correct tokenizations. It starts as one state with an arc for every byte.
A merge (u, v) -> w then adds one gadget:

* the state entered by u loses its arc v, because u followed by v is always merged;
* every state that has an arc u gets an arc w;
* the state entered by w is a copy of the one entered by v.

A state is therefore named by the token that enters it. Copies are not written out: a token remembers its two parts
and the turn it was born in, so whether a state has an arc is looked up by following parts to earlier turns until a
lost arc or two bytes are reached, and the answer is kept in a table. Because every prefix of a word has one correct
tokenization, a position is reached in one state at most, and a position that leads nowhere is left for good: the time
for a word grows linearly with its length.

Texts are cut into words as the byte-level vocabulary does it: a contraction, letters, numbers or other signs each with
one space before them, and white space. All columns are built with numpy for a whole block; a word is encoded once per
task. Decoding emits the arc labels.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import Words, blocks

# Words of at most this many are remembered by a task at once.
KNOWN_WORDS = 200_000
# Bytes of text that are worked on at once.
BLOCK = 512 * 1024
# Rows that are given back at once.
ROWS = 1000

LETTER, NUMBER, SIGN, BLANK = 0, 1, 2, 3

# Fixed values of the vocabulary: white space, and what may follow an apostrophe as one word.
WHITE_SPACE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
CONTRACTIONS = ["s", "t", "re", "ve", "m", "ll", "d"]


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    shown, extra = [], 256
    for byte in range(256):
        if byte in printable:
            shown.append(chr(byte))
        else:
            shown.append(chr(extra))
            extra += 1
    return shown


def character_kinds() -> np.ndarray:
    kinds = np.full(0x110000, SIGN, np.uint8)
    for code in range(0x110000):
        first = unicodedata.category(chr(code))[0]
        if first == "L":
            kinds[code] = LETTER
        elif first == "N":
            kinds[code] = NUMBER
    kinds[WHITE_SPACE] = BLANK
    return kinds


class Automaton:
    """The compiled merges."""

    def __init__(self, definition: str) -> None:
        parts = json.loads(definition)
        vocabulary = parts["model"]["vocab"]
        to_byte = {shown: byte for byte, shown in enumerate(byte_characters())}
        self.label: dict[int, bytes] = {number: bytes(to_byte[c] for c in shown) for shown, number in vocabulary.items()}
        self.special = {entry["content"].encode(): entry["id"] for entry in parts.get("added_tokens") or []}
        self.label.update({number: content for content, number in self.special.items()})
        self.born: dict[int, int] = {}
        self.left: dict[int, int] = {}
        self.right: dict[int, int] = {}
        self.lost: dict[tuple[int, int], int] = {}
        self.arcs: dict[tuple[int, int], bool] = {}
        self.token: dict[bytes, int] = {}
        for shown, byte in to_byte.items():
            if shown in vocabulary:
                self.born[vocabulary[shown]] = -1
                self.token[bytes([byte])] = vocabulary[shown]
        for turn, merge in enumerate(parts["model"]["merges"]):
            first, second = merge if isinstance(merge, list) else merge.split(" ")
            self._gadget(turn, vocabulary[first], vocabulary[second], vocabulary[first + second])
        self._index()

    def _gadget(self, turn: int, u: int, v: int, w: int) -> None:
        if u not in self.born or v not in self.born or not self._arc(u, v, turn):
            return  # no path reads u and then v: the merge never happens
        self.lost[u, v] = turn
        if w not in self.born:
            self.born[w], self.left[w], self.right[w] = turn, u, v
            self.token[self.label[w]] = w

    def _arc(self, state: int, token: int, turn: int) -> bool:
        """Whether the state has the arc just before a turn."""
        while True:
            if self.lost.get((state, token), turn) < turn:
                return False
            p, t = self.born[state], self.born[token]
            if p < 0 and t < 0:
                return True
            if p > t:
                state, turn = self.right[state], p
            elif t > p:
                token, turn = self.left[token], t + 1
            else:
                state, token, turn = self.right[state], self.left[token], p

    def _index(self) -> None:
        last = 1 << 60
        self.end = last
        self.size = {number: len(label) for label, number in self.token.items()}
        self.shorter = {}
        self.sizes: dict[bytes, list[int]] = {}  # of the labels of four bytes and more, by their first four
        for label, number in self.token.items():
            cut = len(label) - 1
            while cut and label[:cut] not in self.token:
                cut -= 1
            self.shorter[number] = self.token[label[:cut]] if cut else -1
            if len(label) >= 4:
                sizes = self.sizes.setdefault(label[:4], [])
                if len(label) not in sizes:
                    sizes.append(len(label))
        for sizes in self.sizes.values():
            sizes.sort(reverse=True)
        count = max(self.label) + 1
        sizes = np.array([len(self.label.get(i, b"")) for i in range(count)])
        self.label_at = np.concatenate([[0], np.cumsum(sizes)])
        self.labels = np.frombuffer(b"".join(self.label.get(i, b"") for i in range(count)), np.uint8)

    def _match(self, word: bytes, at: int) -> int:
        """The longest label at a place of a word."""
        token = self.token
        for size in self.sizes.get(word[at:at + 4], ()):
            found = token.get(word[at:at + size])
            if found is not None:
                return found
        for size in (3, 2, 1):
            found = token.get(word[at:at + size])
            if found is not None:
                return found
        raise ValueError(f"byte {word[at]} is not in the vocabulary")

    def encode(self, word: bytes) -> list[int]:
        """The path that spells a word: always the longest arc that still leads to its end."""
        whole = self.token.get(word)
        if whole is not None:
            return [whole]
        arcs, size, shorter, length = self.arcs, self.size, self.shorter, len(word)
        path: list[int] = []
        dead: set[int] = set()
        at, token = 0, self._match(word, 0)
        while True:
            state = path[-1] if path else -1
            while token >= 0:
                if at + size[token] not in dead:
                    if state < 0:
                        break
                    has = arcs.get((state, token))
                    if has is None:
                        has = arcs[state, token] = self._arc(state, token, self.end)
                    if has:
                        break
                token = shorter[token]
            if token >= 0:
                path.append(token)
                at += size[token]
                if at == length:
                    return path
                token = self._match(word, at)
            else:
                dead.add(at)
                token = path.pop()
                at -= size[token]
                token = shorter[token]

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of all arc labels, one after the other."""
        starts = self.label_at[ids]
        sizes = self.label_at[ids + 1] - starts
        return self.labels[_ranges(starts, sizes)]


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each pair, joined."""
    total = int(sizes.sum())
    steps = np.ones(total, np.int64)
    keep = sizes > 0
    starts, sizes = starts[keep], sizes[keep]
    if not len(starts):
        return np.zeros(0, np.int64)
    steps[0] = starts[0]
    steps[np.cumsum(sizes)[:-1]] = starts[1:] - (starts[:-1] + sizes[:-1] - 1)
    return np.cumsum(steps)


def cut_words(data: np.ndarray, offsets: np.ndarray, kinds: np.ndarray) -> Words:
    """The words of a block of texts as byte ranges."""
    empty = np.zeros(0, np.int64)
    if not len(data):
        return Words(data, offsets, empty, empty, np.zeros(len(offsets), np.int64))
    at = np.flatnonzero((data & 0xC0) != 0x80)  # where characters start
    code = data[at].astype(np.uint32)
    wide = np.flatnonzero(code >= 0x80)
    if len(wide):
        padded = np.concatenate([data, np.zeros(3, np.uint8)])
        lead, place = code[wide], at[wide]
        b1, b2, b3 = ((padded[place + i] & 0x3F).astype(np.uint32) for i in (1, 2, 3))
        code[wide] = np.where(
            lead < 0xE0, (lead & 0x1F) << 6 | b1,
            np.where(lead < 0xF0, (lead & 0x0F) << 12 | b1 << 6 | b2, (lead & 0x07) << 18 | b1 << 12 | b2 << 6 | b3))
    kind = kinds[code]
    count = len(code)
    begins = np.zeros(count + 1, bool)  # of a text
    begins[np.searchsorted(at, offsets)] = True
    ends = begins[1:]
    begins = begins[:-1]
    change = np.ones(count, bool)
    change[1:] = kind[1:] != kind[:-1]
    change |= begins
    blank = kind == BLANK
    follows = np.zeros(count, bool)  # another character than white space comes next in the text
    follows[:-1] = ~blank[1:]
    follows &= ~ends
    # The last blank before something else starts a word; a space takes what follows with it.
    starts = change | (blank & follows)
    joined = np.zeros(count, bool)
    joined[1:] = (code == 32)[:-1] & follows[:-1]
    starts &= ~(joined & ~blank)
    # Contractions start at an apostrophe that starts a word, and what follows them starts another.
    quote = np.flatnonzero((code == 39) & starts)
    if len(quote):
        text_end = at.searchsorted(offsets[1:])
        for tail in CONTRACTIONS:
            width = len(tail)
            stop = text_end[np.searchsorted(text_end, quote, "right")]
            fits = quote + width < stop
            for i, sign in enumerate(tail):
                fits &= code[np.minimum(quote + 1 + i, count - 1)] == ord(sign)
            found = quote[fits]
            for i in range(1, width + 1):
                starts[found + i] = False
            after = found + width + 1
            starts[after[after < count]] = True
            quote = quote[~fits]
    first = at[np.flatnonzero(starts)]
    stops = np.append(first[1:], len(data))
    return Words(data, offsets, first, stops, np.searchsorted(first, offsets))


class Encoder:
    """Encodes blocks of texts; remembers the words of its task."""

    def __init__(self, definition: str) -> None:
        self.automaton = Automaton(definition)
        self.kinds = character_kinds()
        self._forget()

    def _forget(self) -> None:
        self.known: dict[int, int] = {}
        self.at = np.zeros(1024, np.int64)
        self.size = np.zeros(1024, np.int64)
        self.ids = np.zeros(4096, np.int32)
        self.used = 0

    def _learn(self, key: int, ids: list[int]) -> None:
        number = len(self.known)
        if number == len(self.at):
            self.at, self.size = np.resize(self.at, 2 * number), np.resize(self.size, 2 * number)
        while self.used + len(ids) > len(self.ids):
            self.ids = np.resize(self.ids, 2 * len(self.ids))
        self.ids[self.used:self.used + len(ids)] = ids
        self.at[number], self.size[number] = self.used, len(ids)
        self.used += len(ids)
        self.known[key] = number

    def _block(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        words = cut_words(data, offsets, self.kinds)
        if len(self.known) > KNOWN_WORDS or self.used > 16 * KNOWN_WORDS:
            self._forget()
        keys, example, which = np.unique(words.hashes(), return_index=True, return_inverse=True)
        raw = data.tobytes()
        numbers = np.empty(len(keys), np.int64)
        known, encode = self.known, self.automaton.encode
        starts, ends = words.starts[example].tolist(), words.ends[example].tolist()
        for i, key in enumerate(keys.tolist()):
            number = known.get(key)
            if number is None:
                self._learn(key, encode(raw[starts[i]:ends[i]]))
                number = known[key]
            numbers[i] = number
        numbers = numbers[which]
        sizes = self.size[numbers]
        ids = self.ids[_ranges(self.at[numbers], sizes)]
        if not np.array_equal(self.automaton.decode(ids), data):  # two words with one hash: encode each by itself
            each = [encode(raw[a:b]) for a, b in zip(words.starts.tolist(), words.ends.tolist(), strict=True)]
            sizes = np.array([len(x) for x in each], np.int64)
            ids = np.array([i for x in each for i in x], np.int32)
        total = np.concatenate([[0], np.cumsum(sizes)])[words.first]
        return [ids[a:b] for a, b in zip(total[:-1], total[1:], strict=True)]

    def batch(self, texts: pa.Array) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        out: list[bytes] = []
        for _, _, data, offsets in blocks(texts, BLOCK):
            if any(content in data.tobytes() for content in self.automaton.special):
                out += [self._special(data[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            else:
                out += [ids.astype("<u4").tobytes() for ids in self._block(data, offsets)]
        return out

    def _special(self, text: bytes) -> bytes:
        """A text that may hold special tokens: the parts between them are encoded as texts of their own."""
        pieces: list[bytes | int] = [text]
        for content, number in self.automaton.special.items():
            cut: list[bytes | int] = []
            for piece in pieces:
                if isinstance(piece, int):
                    cut.append(piece)
                    continue
                for i, part in enumerate(piece.split(content)):
                    cut += [number, part] if i else [part]
            pieces = cut
        out = b""
        for piece in pieces:
            if isinstance(piece, int):
                out += np.uint32(piece).astype("<u4").tobytes()
            elif piece:
                data = np.frombuffer(piece, np.uint8)
                out += self._block(data, np.array([0, len(data)]))[0].astype("<u4").tobytes()
        return out


def _texts(automaton: Automaton, encoded: list[bytes | None]) -> pa.Array:
    return pa.array([
        automaton.decode(np.frombuffer(ids or b"", "<u4").astype(np.int64)).tobytes().decode("utf-8", "replace")
        for ids in encoded], pa.string())


def encode(
    docs: DataFrame, definition: str, doc_id: str = "doc_id", text: str = "text", with_decoded: bool = False,
) -> DataFrame:
    """(doc_id, token_ids): the ids of every whole text as little-endian unsigned 32-bit integers.

    ``with_decoded`` adds ``decoded``, what ``decode`` makes of them, in the same pass. ``definition`` is the JSON text of a byte-level BPE vocabulary; its size is bounded by the vocabulary. A null or empty
    text has no ids; ids of documents may be null or repeat, each row is encoded by itself; other columns are dropped.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in batches:
            if not batch.num_rows:
                continue
            encoder = encoder or Encoder(shared.value)
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                ids = encoder.batch(part.column(1))
                columns, names = [part.column(0), pa.array(ids, pa.binary())], ["doc_id", "token_ids"]
                if with_decoded:
                    columns.append(_texts(encoder.automaton, ids))
                    names.append("decoded")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    shared = docs.sparkSession.sparkContext.broadcast(definition)
    pairs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return pairs.mapInArrow(run, "doc_id long, token_ids binary" + (", decoded string" if with_decoded else ""))


def decode(encoded: DataFrame, definition: str, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The carried columns and ``decoded``: the text that ``token_ids`` spell; bytes that are no UTF-8 become U+FFFD.

    Null ids give an empty text. An id outside the vocabulary is an error.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = None
        for batch in batches:
            if not batch.num_rows:
                continue
            automaton = automaton or Automaton(shared.value)
            texts = _texts(automaton, batch.column(len(carry)).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(carry)], texts], names=[*carry, "decoded"])

    shared = encoded.sparkSession.sparkContext.broadcast(definition)
    columns = encoded.select(*carry, F.col("token_ids").cast("binary").alias("token_ids"))
    schema = ", ".join(f"`{c}` {columns.schema[c].dataType.simpleString()}" for c in carry)
    return columns.mapInArrow(run, f"{schema}, decoded string")
