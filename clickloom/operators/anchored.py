"""Segments that are anchored at their first event, cut exactly and in parallel.

Two rules share this code. With ``closes`` the first event more than ``span`` after the start still belongs
to the segment and ends it (capped sessions). Without it the first event at least ``span`` after the start
opens the next segment itself (a cached value with a lifetime).

Where a segment starts depends on the one before it, so a timeline is cut into chunks. A chunk is reduced
to a small table that tells which segment is open at its end for every segment that may be open at its
beginning; these tables are chained per key, and then every chunk finds its own starts. Two segment starts
are at least ``span`` apart, which bounds every intermediate table by time and not by rows: one row per
key and chunk, and one per key and ``span``-wide bucket.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ordered import DAY_MS, block_start, null_safe_left

NONE_OPEN = -1  # marks "no segment is open" where a start position is expected


def _key_changes(rows: pa.RecordBatch | pa.Table, columns: Sequence[str]) -> np.ndarray:
    """Whether each row has another key than the row before; true for the first row."""
    changes = np.zeros(rows.num_rows, bool)
    changes[:1] = True
    for name in columns:
        column = rows.column(name)
        here, before = column.slice(1), column.slice(0, max(len(column) - 1, 0))
        unequal = pc.fill_null(pc.not_equal(here, before), False)
        unequal = pc.or_(unequal, pc.xor(pc.is_null(here), pc.is_null(before)))
        changes[1:] |= unequal.to_numpy(zero_copy_only=False) if isinstance(unequal, pa.Array) else unequal.to_numpy()
    return changes


def _key_at(rows: pa.RecordBatch, columns: Sequence[str], index: int) -> tuple:
    return tuple(rows.column(name)[index].as_py() for name in columns)


def _whole_groups(batches: Iterator[pa.RecordBatch], columns: Sequence[str]) -> Iterator[pa.Table]:
    """Tables of complete groups from sorted batches; the last group of a batch waits for the next batch."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        edges = np.flatnonzero(_key_changes(batch, columns))
        if held and _key_at(held[-1], columns, held[-1].num_rows - 1) == _key_at(batch, columns, 0):
            edges = edges[1:]
        if len(edges):
            ready = [b for b in (*held, batch.slice(0, edges[-1])) if b.num_rows]
            held = [batch.slice(edges[-1])]
            if ready:
                yield pa.Table.from_batches(ready)
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def _longs(table: pa.Table, name: str) -> np.ndarray:
    return pc.fill_null(table.column(name), 0).to_numpy().astype(np.int64, copy=False)


def _batch(table: pa.Table, rows: np.ndarray, names: Sequence[str], added: dict[str, pa.Array]) -> pa.RecordBatch:
    """The named columns of some rows, and new columns."""
    picked = pa.array(rows, pa.int64())
    columns = {name: table.column(name).take(picked).combine_chunks() for name in names}
    return pa.RecordBatch.from_pydict({**columns, **added})


class _Chunks:
    """The ticks of several whole chunks, as arrays over which all jumps are computed at once."""

    def __init__(self, table: pa.Table, columns: Sequence[str], position: str, span: int, chunk: int, closes: bool):
        self.first = np.flatnonzero(_key_changes(table, columns))
        self.end = np.append(self.first[1:], table.num_rows)
        self.group = np.repeat(np.arange(len(self.first)), self.end - self.first)
        self.at = _longs(table, position)
        self.repeated = _longs(table, "_n") >= 2
        self.base = _longs(table, "_chunk")[self.first]
        self.stride = chunk + span + 1
        self.line = self.group * self.stride + (self.at - self.base[self.group])
        self.span, self.closes = span, closes
        self.breaker = np.searchsorted(self.line, self.line + span, "right" if closes else "left")

    def breaker_of(self, groups: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """First tick of each group that breaks a segment started at an earlier position."""
        offset = np.maximum(starts + self.span - self.base[groups], -1)
        return np.searchsorted(self.line, groups * self.stride + offset, "right" if self.closes else "left")

    def start_after(self, groups: np.ndarray, breaker: np.ndarray) -> np.ndarray:
        """The tick that starts the next segment; the group's end where none is left."""
        if not self.closes:
            return breaker
        safe = np.minimum(breaker, len(self.at) - 1)
        return np.where((breaker < self.end[groups]) & ~self.repeated[safe], breaker + 1, breaker)

    def follow(self, groups: np.ndarray, starts: np.ndarray, visit=None) -> np.ndarray:
        """The start position still open at the end of the chunk, when segments begin at ``starts``."""
        result = np.full(len(starts), NONE_OPEN, np.int64)
        which = np.arange(len(starts))
        alive = starts < self.end[groups]
        which, groups, starts = which[alive], groups[alive], starts[alive]
        while len(which):
            if visit is not None:
                visit(starts)
            breaker = self.breaker[starts]
            stays = breaker >= self.end[groups]
            result[which[stays]] = self.at[starts[stays]]
            which, groups, breaker = which[~stays], groups[~stays], breaker[~stays]
            starts = self.start_after(groups, breaker)
            alive = starts < self.end[groups]
            which, groups, starts = which[alive], groups[alive], starts[alive]
        return result


def segment_table(
    events: DataFrame, keys: Sequence[str], position: str, order: str, span: int, *,
    closes: bool, chunk: int = DAY_MS,
) -> DataFrame:
    """Per key and bucket of ``span``: the segment open before it, the one that starts in it, its edge row."""
    keys = list(keys)
    chunk = max(1, round(chunk / span)) * span
    columns = [*keys, "_chunk"]
    ticks = (
        events.groupBy(*keys, position)
        .agg(F.count("*").alias("_n"), F.min(order).alias("_order"))
        .withColumn("_chunk", block_start(F.col(position), chunk))
    )
    key_fields = [ticks.schema[k] for k in keys]
    long = lambda name: T.StructField(name, T.LongType())
    longs = lambda name: T.StructField(name, T.ArrayType(T.LongType()))

    def reduce_chunks(batches):
        for table in _whole_groups(batches, columns):
            c = _Chunks(table, columns, position, span, chunk, closes)
            previous = np.append(c.line[:1], c.line[:-1]) - c.group * c.stride
            is_first = np.zeros(len(c.at), bool)
            is_first[c.first] = True
            heads = np.flatnonzero(is_first | (previous < span))
            groups = c.group[heads]
            exits = c.follow(groups, c.start_after(groups, heads))
            fresh = c.follow(np.arange(len(c.first)), c.first)
            last = np.append((groups[1:] != groups[:-1]) | (exits[1:] != exits[:-1]), True)
            heads, groups, exits = heads[last], groups[last], exits[last]
            offsets = pa.array(np.searchsorted(groups, np.arange(len(c.first) + 1)), pa.int32())
            yield _batch(table, c.first, columns, {
                "_fresh": pa.array(fresh, pa.int64()),
                "_bounds": pa.ListArray.from_arrays(offsets, pa.array(c.at[heads], pa.int64())),
                "_exits": pa.ListArray.from_arrays(offsets, pa.array(exits, pa.int64())),
            })

    summaries = (
        ticks.repartition(*[F.col(k) for k in columns]).sortWithinPartitions(*columns, position)
        .mapInArrow(reduce_chunks, T.StructType([*key_fields, long("_chunk"), long("_fresh"), longs("_bounds"),
                                                  longs("_exits")]))
    )

    def chain_chunks(batches):
        key, open_start = None, NONE_OPEN
        find = bisect_right if closes else bisect_left
        for batch in batches:
            if not batch.num_rows:
                continue
            changes = _key_changes(batch, keys)
            changes[0] = _key_at(batch, keys, 0) != key
            key = _key_at(batch, keys, batch.num_rows - 1)
            edges = batch.column("_bounds").offsets.to_numpy().tolist()
            bounds, exits = (batch.column(name).values.to_numpy() for name in ("_bounds", "_exits"))
            fresh = batch.column("_fresh").to_numpy().tolist()
            entries = np.empty(batch.num_rows, np.int64)
            for i, changed in enumerate(changes.tolist()):
                if changed:
                    open_start = NONE_OPEN
                entries[i] = open_start
                if open_start == NONE_OPEN:
                    open_start = fresh[i]
                else:
                    at = find(bounds, open_start + span, edges[i], edges[i + 1])
                    if at < edges[i + 1]:
                        open_start = int(exits[at])
            yield pa.RecordBatch.from_pydict(
                {**{name: batch.column(name) for name in columns}, "_entry": pa.array(entries, pa.int64())}
            )

    entries = (
        summaries.repartition(*[F.col(k) for k in keys]).sortWithinPartitions(*columns)
        .mapInArrow(chain_chunks, T.StructType([*key_fields, long("_chunk"), long("_entry")]))
    )

    def find_starts(batches):
        for table in _whole_groups(batches, columns):
            is_entry = table.column("_entry").is_valid().to_numpy()
            entry = _longs(table, "_entry")[is_entry]
            table = table.filter(pa.array(~is_entry))
            c = _Chunks(table, columns, position, span, chunk, closes)
            groups = np.arange(len(c.first))
            first = np.where(
                entry == NONE_OPEN, c.first, c.start_after(groups, c.breaker_of(groups, entry))
            )
            found = [np.empty(0, np.int64)]
            c.follow(groups, first, found.append)
            starts = np.sort(np.concatenate(found))
            bucket = c.at - c.at % span
            rows = np.flatnonzero(np.append(True, (c.group[1:] != c.group[:-1]) | (bucket[1:] != bucket[:-1])))
            # The segment open before the bucket: the last start before it in the chunk, else the chunk's entry.
            padded = np.append(starts, 0)
            earlier = np.searchsorted(starts, rows) - 1
            candidate = padded[np.maximum(earlier, 0)]
            own = (earlier >= 0) & (c.group[candidate] == c.group[rows])
            carried = np.where(own, c.at[candidate], entry[c.group[rows]])
            started = np.full(len(rows), -1, np.int64)
            started[np.searchsorted(rows, starts, "right") - 1] = starts
            has, begun = started >= 0, np.maximum(started, 0)
            # The edge row: the closer that shares its position with the next start, or the row that opened it.
            edge = has
            if closes:
                broke = np.zeros(len(c.at), bool)
                after = c.breaker[starts]
                broke[after[after < c.end[c.group[starts]]]] = True
                opened = entry != NONE_OPEN
                lead = c.breaker_of(groups[opened], entry[opened])
                broke[lead[lead < c.end[opened]]] = True
                edge = has & broke[begun]
            order_values = _longs(table, "_order")
            yield _batch(table, rows, keys, {
                "_bucket": pa.array(bucket[rows], pa.int64()),
                "_carried": pa.array(carried, pa.int64(), mask=carried == NONE_OPEN),
                "_started": pa.array(c.at[begun], pa.int64(), mask=~has),
                "_edge": pa.array(order_values[begun], pa.int64(), mask=~edge),
            })

    stacked = ticks.withColumn("_entry", F.lit(None).cast("long")).unionByName(entries, allowMissingColumns=True)
    return (
        stacked.repartition(*[F.col(k) for k in columns])
        .sortWithinPartitions(*columns, F.col(position).asc_nulls_first())
        .mapInArrow(find_starts, T.StructType([*key_fields, long("_bucket"), long("_carried"), long("_started"),
                                                long("_edge")]))
    )


def with_segment(
    events: DataFrame, keys: Sequence[str], position: str, order: str, span: int, *,
    closes: bool, start: str = "segment_start", chunk: int = DAY_MS,
) -> DataFrame:
    """Add the start of the segment each event belongs to, and ``opens``: whether the event opened it.

    ``position`` and ``order`` are non-negative longs, ``order`` is unique per key and settles equal
    positions; null keys are a key of their own.
    """
    table = segment_table(events.select(*keys, position, order), keys, position, order, span,
                          closes=closes, chunk=chunk)
    at, rank = F.col(position), F.col(order)
    in_new = F.col("_started").isNotNull() & (
        (at > F.col("_started"))
        | ((at == F.col("_started")) & (F.col("_edge").isNull() | (rank > F.col("_edge") if closes else F.lit(True))))
    )
    joined = null_safe_left(events.withColumn("_bucket", block_start(at, span)), table, [*keys, "_bucket"])
    joined = joined.withColumn(start, F.when(in_new, F.col("_started")).otherwise(F.col("_carried")))
    if not closes:
        joined = joined.withColumn("opens", in_new & (at == F.col("_started")) & (rank == F.col("_edge")))
    return joined.drop("_bucket", "_carried", "_started", "_edge")
