"""Repair of the structure of conversations: the cheapest edits that give legal turns, as an audit string.

The initials of the repaired roles must be nothing, or an optional system turn and then pairs of user and assistant. Rows are kept (K), get
another role (R) or are deleted (D); turns without text are inserted (I). Of equally cheap audits the least in ASCII order is taken.

A dynamic program goes over the rows once and holds one audit for each of the grammar's four states. Audits are persistent: a node
has a letter, its parent, its ancestors at distances of powers of two and a rolling hash of all letters up to it, so states share their
prefixes and nothing is copied. Equally cheap audits are compared at the end of their longest common prefix, which is found by lifting both
while hashes differ; where hashes say that prefixes are equal, the nodes must be the same or the letters are compared (see ``before``).

Equal rows are first combined to a row and its count. Rows are then dealt by ranges of (conversation, turn, role, text), so
a conversation that holds a third of all rows is spread over many tasks. A task streams its sorted rows. It finishes the conversations that lie inside its range.
Of its first and last conversation it gives a piece: for every state before and behind it the cheapest audit. Pieces are joined in
order by the same comparison, and only these few conversations' rows are read again, in order and a batch at a time, for the digest
of their repaired text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from .tables import stored

START, SYSTEM, USER, ASSISTANT = range(4)
STEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
WANTED = {START: "user", SYSTEM: "user", USER: "assistant", ASSISTANT: "user"}  # the role an edit can put behind a state
LEGAL_PAIRS = ("su", "ua", "au")
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 2, 3, 2, 1
WHITE = " \t\n\x0b\f\r"
MODULUS, BASE = (1 << 61) - 1, 911_382_323


class Node:
    """An audit: its last letter and the audit before it."""

    __slots__ = ("depth", "hash", "letter", "ups")

    def __init__(self, parent: Node | None = None, letter: str = ""):
        self.letter = letter
        if parent is None:
            self.depth, self.hash, self.ups = 0, 0, ()
            return
        self.depth = parent.depth + 1
        self.hash = (parent.hash * BASE + ord(letter)) % MODULUS
        ups = [parent]
        while len(ups[-1].ups) >= len(ups):
            ups.append(ups[-1].ups[len(ups) - 1])
        self.ups = tuple(ups)

    def above(self, depth: int) -> Node:
        node = self
        while node.depth > depth:
            node = node.ups[min(len(node.ups), (node.depth - depth).bit_length()) - 1]
        return node

    def text(self) -> str:
        letters, node = [], self
        while node.depth:
            letters.append(node.letter)
            node = node.ups[0]
        return "".join(reversed(letters))


def same(x: Node, y: Node) -> bool:
    """Whether two audits of one length and hash are equal, letter by letter down to a node that both share."""
    while x is not y:
        if x.letter != y.letter:
            return False
        x, y = x.ups[0], y.ups[0]
    return True


def before(x: Node, y: Node) -> bool:
    """Whether audit ``x`` comes before ``y`` in ASCII order."""
    depth = min(x.depth, y.depth)
    a, b = x.above(depth), y.above(depth)
    if a.hash == b.hash:
        if same(a, b):
            return x.depth < y.depth
        return x.text() < y.text()
    for k in range(len(a.ups) - 1, -1, -1):
        if k < len(a.ups) and a.ups[k].hash != b.ups[k].hash:
            a, b = a.ups[k], b.ups[k]
    if not same(a.ups[0], b.ups[0]):  # two prefixes share a hash
        return x.text() < y.text()
    return a.letter < b.letter


@dataclass
class Way:
    """The best edits that lead to a state: cost, audit, and the digest of the repaired text with what is still to be added to it."""

    cost: int
    audit: Node
    digest: object = None
    added: tuple = ()

    def then(self, letter: str, cost: int, turn: bytes | None = None) -> Way:
        return Way(self.cost + cost, Node(self.audit, letter), self.digest, self.added if turn is None else (*self.added, turn))

    def better(self, other: Way | None) -> bool:
        if other is None or self.cost != other.cost:
            return other is None or self.cost < other.cost
        return before(self.audit, other.audit)


def _offer(ways: dict[int, Way], state: int, way: Way) -> bool:
    if way.better(ways.get(state)):
        ways[state] = way
        return True
    return False


def _turn(state: int, role: str, text: str) -> bytes:
    return f"{'' if state == START else chr(10)}{role}:{text}".encode("utf-8", "surrogatepass")


def with_inserts(ways: dict[int, Way]) -> dict[int, Way]:
    """Also the states that inserted turns lead to."""
    ways = dict(ways)
    waiting = list(ways)
    while waiting:
        state = waiting.pop()
        role = WANTED[state]
        after = STEP[state, role[0]]
        if _offer(ways, after, ways[state].then(INSERT, INSERT_COST, _turn(state, role, ""))):
            waiting.append(after)
    return ways


def over_row(ways: dict[int, Way], role: str, text: str, fault: str | None) -> dict[int, Way]:
    """The best ways behind a row, given those before it."""
    out: dict[int, Way] = {}
    extra = TRUNCATED_COST if fault == "truncated" else 0
    for state, way in with_inserts(ways).items():
        _offer(out, state, way.then(DELETE, DELETE_COST))
        if fault in ("blank", "duplicate"):
            continue
        kept = STEP.get((state, role[:1]))
        if kept is not None:
            _offer(out, kept, way.then(KEEP, extra, _turn(state, role, text)))
        if WANTED[state][0] != role[:1]:
            _offer(out, STEP[state, WANTED[state][0]], way.then(REROLE, REROLE_COST + extra, _turn(state, WANTED[state], text)))
    for way in out.values():
        if way.digest is not None and way.added:
            way.digest = way.digest.copy()
            for part in way.added:
                way.digest.update(part)
        way.added = ()
    return out


def finished(ways: dict[int, Way]) -> Way:
    """The best way to a legal end."""
    ways = with_inserts(ways)
    ends = [ways[state] for state in (START, ASSISTANT) if state in ways]
    best = ends[0]
    for way in ends[1:]:
        if way.better(best):
            best = way
    if best.digest is not None:
        best.digest = best.digest.copy()
        for part in best.added:
            best.digest.update(part)
    return best


@dataclass
class Figures:
    """Counts of a run of rows, with what is needed to count over the edge to the next run."""

    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    turns: int = 0
    first_turn: int | None = None
    last_turn: int | None = None
    first_initial: str | None = None
    last_initial: str | None = None

    def extend(self, other: Figures) -> None:
        if other.first_initial is None:
            return
        for name in ("blank", "duplicate", "truncated", "illegal", "turns"):
            setattr(self, name, getattr(self, name) + getattr(other, name))
        if self.first_initial is None:
            self.first_initial = other.first_initial
        else:
            self.illegal += self.last_initial + other.first_initial not in LEGAL_PAIRS
        if self.last_turn is not None and self.last_turn == other.first_turn:
            self.turns -= 1
        if self.first_turn is None:
            self.first_turn = other.first_turn
        if other.last_turn is not None:
            self.last_turn = other.last_turn
        self.last_initial = other.last_initial

    def gaps(self) -> int:
        return 0 if self.turns == 0 else self.last_turn - self.first_turn + 1 - self.turns


def _row_figures(turn: int | None, role: str, count: int, fault: str | None) -> Figures:
    later = "blank" if fault == "blank" else "duplicate"  # the fault of all copies but the first
    found = Figures(
        illegal=count - 1, turns=turn is not None, first_turn=turn, last_turn=turn, first_initial=role[:1], last_initial=role[:1])
    for name, times in ((fault, 1), (later, count - 1)):
        if name:
            setattr(found, name, getattr(found, name) + times)
    return found


@dataclass
class Piece:
    """The rows of a conversation that lie in one task."""

    conv_id: int | None
    entries: dict[int, dict[int, Way]]
    figures: Figures = field(default_factory=Figures)

    @classmethod
    def begin(cls, conv_id: int | None, inside: bool) -> Piece:
        starts = [START] if inside else [START, SYSTEM, USER, ASSISTANT]
        return cls(conv_id, {
            s: {s: Way(0, Node(), hashlib.sha256() if s == START else None)} for s in starts})

    def add(self, turn: int | None, role: str, text: str, count: int, fault: str | None) -> None:
        self.figures.extend(_row_figures(turn, role, count, fault))
        for entry, ways in self.entries.items():
            ways = over_row(ways, role, text, fault)
            for _ in range(count - 1):
                ways = over_row(ways, role, text, "blank" if fault == "blank" else "duplicate")
            self.entries[entry] = ways


RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
FIGURES = (
    "struct<blank:long,duplicate:long,truncated:long,illegal:long,turns:long,first_turn:long,last_turn:long,"
    "first_initial:string,last_initial:string>")
ROW = "turn long, role string, text string, count long, fault string"
PIECES = (
    f"kind string, conv_id long, part int, place long, {RESULT}, {ROW}, figures {FIGURES}, "
    "ways array<struct<entry:int,exit:int,cost:long,audit:string>>")


def _result(figures: Figures, best_cost: int, audit: str, digest: str | None) -> dict:
    return {
        "gaps": figures.gaps(), "blank": figures.blank, "duplicate": figures.duplicate, "truncated": figures.truncated,
        "illegal": figures.illegal, "cost": best_cost, "audit": audit, "repaired_sha256": digest}


def _pieces(schema: pa.Schema):
    """Streams sorted rows: ``whole`` conversations, and ``piece`` and ``row`` records of the first and the last one of the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, out = TaskContext.get().partitionId(), []
        piece, held, first = None, [], True

        def close(at_edge: bool) -> None:
            if at_edge:
                out.extend(held)
                out.append({
                    "kind": "piece", "conv_id": piece.conv_id, "part": part, "figures": vars(piece.figures), "ways": [
                        {"entry": entry, "exit": state, "cost": way.cost, "audit": way.audit.text()}
                        for entry, ways in piece.entries.items() for state, way in ways.items()]})
            else:
                best = finished(piece.entries[START])
                out.append({"kind": "whole", "conv_id": piece.conv_id} | _result(
                    piece.figures, best.cost, best.audit.text(), best.digest.hexdigest()))
            held.clear()

        place = 0
        for batch in batches:
            for conv_id, turn, role, text, count, fault in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if piece is None or conv_id != piece.conv_id:
                    if piece is not None:
                        close(first)
                        first = False
                    piece = Piece.begin(conv_id, not first)
                held.append({
                    "kind": "row", "conv_id": conv_id, "part": part, "place": place, "turn": turn, "role": role, "text": text,
                    "count": count, "fault": fault})
                place += 1
                piece.add(turn, role, text, count, fault)
                if first:  # it goes out in any case
                    out.extend(held)
                    held.clear()
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        if piece is not None:
            close(True)
            yield pa.RecordBatch.from_pylist(out, schema)

    return run


def _joined(rows: pa.Table) -> pa.Table:
    """The pieces of one conversation in order, joined."""
    found = sorted(rows.to_pylist(), key=lambda r: r["part"])
    best, figures = {START: (0, "")}, Figures()
    for piece in found:
        figures.extend(Figures(**piece["figures"]))
        after: dict[int, tuple[int, str]] = {}
        for way in piece["ways"]:
            if way["entry"] in best:
                cost, audit = best[way["entry"]]
                offered = (cost + way["cost"], audit + way["audit"])
                if way["exit"] not in after or offered < after[way["exit"]]:
                    after[way["exit"]] = offered
        best = after
    missing = {START: 0, ASSISTANT: 0, USER: 1, SYSTEM: 2}  # turns to insert up to a legal end
    cost, audit = min((cost + missing[s] * INSERT_COST, audit + missing[s] * INSERT) for s, (cost, audit) in best.items())
    kinds = {name: (pa.string() if kind == "string" else pa.int64()) for name, kind in (c.split() for c in RESULT.split(", "))}
    made = {"conv_id": found[0]["conv_id"]} | _result(figures, cost, audit, None)
    return pa.Table.from_pylist([made], pa.schema({"conv_id": pa.int64()} | kinds))


def _edited(rows: Iterator[tuple]) -> Iterator[tuple]:
    """(conv_id, role, text) of repaired turns from (conv_id, audit, role, text, count) rows in order."""
    current, audit, at, state = None, None, 0, START

    def inserts(conv_id: int | None) -> Iterator[tuple]:
        nonlocal at, state
        while at < len(audit) and audit[at] == INSERT:
            role = WANTED[state]
            yield conv_id, role, ""
            state, at = STEP[state, role[0]], at + 1

    for conv_id, found, role, text, count in rows:
        if audit is None or conv_id != current:
            if audit is not None:
                yield from inserts(current)
            current, audit, at, state = conv_id, found, 0, START
        for _ in range(count):
            yield from inserts(conv_id)
            letter, at = audit[at], at + 1
            if letter == DELETE:
                continue
            given = role if letter == KEEP else WANTED[state]
            yield conv_id, given, text
            state = STEP[state, given[:1]]
    if audit is not None:
        yield from inserts(current)


def _each_row(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv_id, digest) of the repaired texts of sorted rows, holding one batch at a time."""
    made: list[tuple] = []
    digest, current, empty = None, None, True
    for conv_id, role, text in _edited(_each_row(batches)):
        if digest is None or conv_id != current:
            if digest is not None:
                made.append((current, digest.hexdigest()))
            digest, current, empty = hashlib.sha256(), conv_id, True
        digest.update(_turn(START if empty else USER, role, text))
        empty = False
    if digest is not None:
        made.append((current, digest.hexdigest()))
    yield pa.RecordBatch.from_pydict({
        "conv_id": pa.array([c for c, _ in made], pa.int64()), "digest": pa.array([d for _, d in made], pa.string())})


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    made, position, current = [], 0, object()

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([
            pa.array([m[0] for m in made], pa.int64()), pa.array([m[1] for m in made], pa.int64()),
            pa.array([m[2] for m in made], pa.string()), pa.array([m[3] for m in made], pa.string()),
        ], names=["conv_id", "position", "role", "text"])

    for conv_id, role, text in _edited(_each_row(batches)):
        position = position + 1 if conv_id == current else 0
        current = conv_id
        made.append((conv_id, position, role, text))
        if len(made) == 4096:
            yield batch()
            made = []
    yield batch()


def damaged(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows with planted faults: a checksum of conversation and turn drops, empties, cuts, repeats or relabels a fifth of them."""
    space = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    kind = F.crc32(F.encode(F.concat(space(conv_id), F.lit(":"), space(turn)), "UTF-8")) % 20
    said = F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(space(text), "[.!?]", "")).otherwise(space(text))
    return rows.where(kind != 0).select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), F.when(kind == 4, F.lit("user")).otherwise(space(role)).alias("role"),
        said.alias("text"), F.explode(F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1))).alias("_copy")).drop("_copy")


def faulty_rows(
    rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
) -> DataFrame:
    """(conv_id, turn, role, text, count, fault): distinct rows, and the first fault of the first copy of each.

    Only (role, text) pairs that a conversation has at several turns are joined back.
    """
    blank = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    plain = rows.select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"), blank(role).alias("role"),
        blank(text).alias("text"))
    distinct = plain.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("count"))
    distinct = distinct.withColumn("key", F.unhex(F.sha2(F.encode("text", "UTF-8"), 256)))
    again = distinct.groupBy("conv_id", "role", "key").agg(
        F.min(F.struct("turn")).alias("first"), F.count(F.lit(1)).alias("turns")).where("turns > 1").select(
        F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), F.col("key").alias("_key"), "first")
    same_row = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role")) & (F.col("key") == F.col("_key"))
    end = F.right(F.rtrim("text", F.lit(WHITE)), F.lit(1))
    later = F.col("first").isNotNull() & ~F.col("first.turn").eqNullSafe(F.col("turn"))
    fault = (
        F.when(end == "", F.lit("blank")).when(later, F.lit("duplicate"))
        .when(~end.isin(".", "!", "?"), F.lit("truncated")))
    return distinct.join(again, same_row, "left").select("conv_id", "turn", "role", "text", "count", fault.alias("fault"))


ORDER = ("conv_id", "turn", "role", "text")


def repair(
    rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
) -> DataFrame:
    """One row per conversation: counts of faults, cost and audit of the cheapest edits, and the digest of the repaired text.

    Rows are taken by turn (null first), ties by role and text. A null role or text is one space. Rows without an id are
    one conversation. ``blank``, ``duplicate`` (role and text seen earlier) and ``truncated`` count each row's first fault, ``illegal``
    adjacent roles that cannot follow each other, ``gaps`` numbers between the least and the largest turn that no row has. Repeated rows are
    duplicates. A role that is neither system, user nor assistant by its first character can't be kept. An empty table gives no rows; other
    columns are dropped. The audit of a conversation is one value. Runs a job when called: pieces are written to the shared folder.
    """
    # The beginning of a text orders as the text does, and keeps what is sampled for the ranges small.
    ranges = [*ORDER[:-1], F.left("text", F.lit(32))]
    ordered = faulty_rows(rows, conv_id, turn, role, text).repartitionByRange(*ranges).sortWithinPartitions(*ORDER)
    kinds = rows.sparkSession.createDataFrame([], PIECES).schema
    pieces = stored(ordered.mapInArrow(_pieces(to_arrow_schema(kinds)), PIECES), "pieces")
    names = [c.split()[0] for c in RESULT.split(", ")]
    whole = pieces.where("kind = 'whole'").select("conv_id", *names)
    split = pieces.where("kind = 'piece'").select("conv_id", "part", "figures", "ways")
    joined = split.groupBy("conv_id").applyInArrow(_joined, f"conv_id long, {RESULT}").drop("repaired_sha256")
    audits = joined.select(F.col("conv_id").alias("_conv"), "audit")
    left = pieces.where("kind = 'row'").select("conv_id", "part", "place", "role", "text", "count")
    left = left.join(audits, F.col("conv_id").eqNullSafe(F.col("_conv"))).repartition("conv_id").sortWithinPartitions(
        "conv_id", "part", "place")
    digests = left.select("conv_id", "audit", "role", "text", "count").mapInArrow(_digests, "_conv long, digest string")
    split_done = joined.join(digests, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").select(
        "conv_id", *names[:-1], F.coalesce("digest", F.sha2(F.lit(b""), 256)).alias("repaired_sha256"))
    return whole.union(split_done)


def repaired_turns(
    rows: DataFrame, audits: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
) -> DataFrame:
    """(conv_id, position, role, text): the turns that the audits of ``repair`` make of the same rows, one row each.

    A conversation's rows go through one task in order, a batch at a time.
    """
    given = audits.select(F.col("conv_id").alias("_conv"), "audit")
    found = faulty_rows(rows, conv_id, turn, role, text)
    sorted_rows = found.join(given, F.col("conv_id").eqNullSafe(F.col("_conv"))).repartition("conv_id").sortWithinPartitions(*ORDER)
    return sorted_rows.select("conv_id", "audit", "role", "text", "count").mapInArrow(
        _turns, "conv_id long, position long, role string, text string")
