"""A8 as a stream: the figures of the last answers of a service, kept from report to report and not sorted anew.

The last answers lie twice in the state of a key: by arrival in segments of a ring, which tell what leaves, and by value in
sorted blocks, each with its count, mean and sum of squared deviations. An answer that comes or goes touches one block; the
figures follow from the list of blocks and the few that hold a wanted rank. Both are bounded by the length of the window.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql.streaming import StatefulProcessor

from ..operators.latency_stats import OUTLIER_STDS, WINDOW_ROWS
from .processors import _in_order

BLOCK_VALUES = 256
SEGMENT_VALUES = 512
REPORT_MS = 60_000
POINTS = (0.5, 0.95, 0.99)


class SortedBlocks:
    """A multiset of numbers as sorted blocks; ``load`` fetches a block that is not at hand.

    ``index`` has a row (name, low, count, mean, squares) per block in the order of values. A block begins with its lowest
    value when it was cut; the first one takes everything below.
    """

    def __init__(self, index: Sequence[tuple], load: Callable[[int], Sequence[float]], size: int = BLOCK_VALUES):
        self.index, self.load, self.size = [tuple(row) for row in index], load, size
        self.at_hand: dict[int, np.ndarray] = {}
        self.changed: set[int] = set()
        self.dropped: set[int] = set()
        self.next = 1 + max((row[0] for row in self.index), default=-1)

    def values(self, name: int) -> np.ndarray:
        if name not in self.at_hand:
            self.at_hand[name] = np.asarray(self.load(name), np.float64)
        return self.at_hand[name]

    def _row(self, name: int, low: float, values: np.ndarray) -> tuple:
        self.at_hand[name] = values
        self.changed.add(name)
        mean = float(values.mean()) if len(values) else 0.0
        return name, low, len(values), mean, float(((values - mean) ** 2).sum())

    def change(self, come: np.ndarray, go: np.ndarray) -> None:
        """Put ``come`` in and take ``go`` out; every value of ``go`` has to be there or among those that come."""
        if not self.index:
            self.index = [self._row(self.next, -np.inf, np.empty(0))]
            self.next += 1
        come, go = np.sort(come), np.sort(go)
        cuts = [row[1] for row in self.index[1:]]
        ends_come = [0, *np.searchsorted(come, cuts, "left").tolist(), len(come)]
        ends_go = [0, *np.searchsorted(go, cuts, "left").tolist(), len(go)]
        index = []
        for i, row in enumerate(self.index):
            new, old = come[ends_come[i]:ends_come[i + 1]], go[ends_go[i]:ends_go[i + 1]]
            if not len(new) and not len(old):
                index.append(row)
                continue
            values = self.values(row[0])
            values = np.insert(values, np.searchsorted(values, new), new)
            # The n-th of equal values that go is the n-th of those that are there.
            nth = np.arange(len(old)) - np.searchsorted(old, old)
            values = np.delete(values, np.searchsorted(values, old) + nth)
            if not len(values) and i:
                self.at_hand.pop(row[0])
                self.changed.discard(row[0])
                self.dropped.add(row[0])
            elif len(values) <= 2 * self.size:
                index.append(self._row(row[0], row[1], values))
            else:
                index += self._cut(row, values)
        self.index = index

    def _cut(self, row: tuple, values: np.ndarray) -> list[tuple]:
        """Blocks of about ``size`` values; equal values stay together, so that one value has one place."""
        starts = np.unique(np.searchsorted(values, values[self.size::self.size], "left"))
        bounds = [0, *starts[starts > 0].tolist(), len(values)]
        out = [self._row(row[0], row[1], values[:bounds[1]])]
        for a, b in zip(bounds[1:], bounds[2:]):
            out.append(self._row(self.next, float(values[a]), values[a:b]))
            self.next += 1
        return out

    def moments(self, rows: Sequence[tuple]) -> tuple[int, float, float]:
        """Count, mean and squared deviations of some blocks together"""
        counts = np.array([row[2] for row in rows], np.float64)
        means, squares = (np.array([row[at] for row in rows]) for at in (3, 4))
        n = counts.sum()
        if not n:
            return 0, 0.0, 0.0
        mean = float((counts * means).sum() / n)
        return int(n), mean, float((squares + counts * (means - mean) ** 2).sum())

    def below(self, bound: float) -> list[tuple]:
        """The rows of the blocks below ``bound``; the one that holds it is cut there."""
        out = []
        for row in self.index:
            if row[1] >= bound:
                break
            out.append(row)
        while out and not out[-1][2]:
            out.pop()
        if out:
            name, low, count, *_ = out.pop()
            values = self.values(name)
            values = values[:np.searchsorted(values, bound, "left")]
            mean = float(values.mean()) if len(values) else 0.0
            out.append((name, low, len(values), mean, float(((values - mean) ** 2).sum())))
        return out

    def at_ranks(self, rows: Sequence[tuple], ranks: Sequence[int]) -> list[float]:
        ends = np.cumsum([row[2] for row in rows])
        out = []
        for rank in ranks:
            i = int(np.searchsorted(ends, rank, "right"))
            out.append(float(self.values(rows[i][0])[rank - (ends[i] - rows[i][2])]))
        return out

    def figures(self) -> tuple[float, float, float, float, float, int]:
        """p50, p95, p99 and mean without outliers, the deviation of all, and how many there are"""
        n, mean, squares = self.moments(self.index)
        if not n:
            return 0.0, 0.0, 0.0, 0.0, 0.0, 0
        std = float(np.sqrt(squares / n))
        rows = self.below(mean + OUTLIER_STDS * std)
        kept, kept_mean, _ = self.moments(rows)
        if not kept:
            rows, kept, kept_mean = self.index, n, mean
        points = []
        for q in POINTS:
            place = q * (kept - 1)
            low, high = self.at_ranks(rows, [int(place), min(int(place) + 1, kept - 1)])
            points.append(low + (high - low) * (place - int(place)))
        return (*points, kept_mean, std, n)


class ServiceFigures(StatefulProcessor):
    """A8 per service: a row for every period of ``report_ms`` with requests, sent when a later one has come.

    Rows need ts_ms, event_id, latency_ms, ok and cache_hit. An answer without a latency counts for the cache only, a request
    without ``ok`` as failed, one without ``cache_hit`` as neither hit nor miss. Errors count up to the length of the window;
    throughput is over the time from the first request to the last one of the period. Rows that come in a later micro-batch
    than newer ones join the open period.
    """

    def __init__(self, report_ms: int = REPORT_MS, window_rows: int = WINDOW_ROWS):
        self.report, self.window = report_ms, window_rows

    def init(self, handle) -> None:
        self.totals = handle.getValueState(
            "totals", "first long, last long, period long, answered long, errors long, hits long, misses long")
        self.index = handle.getValueState(
            "index", "names array<int>, lows array<double>, counts array<int>, means array<double>, squares array<double>")
        self.blocks = handle.getMapState("blocks", "name int", "numbers array<double>")
        self.ring = handle.getMapState("ring", "segment long", "numbers array<double>")

    def _leaving(self, first: int, last: int) -> np.ndarray:
        """Answers ``first`` to ``last`` - 1 by number; segments that are left behind go"""
        parts = []
        for segment in range(first // SEGMENT_VALUES, -(-last // SEGMENT_VALUES)):
            values = np.asarray(self.ring.getValue((segment,))[0])
            begin = segment * SEGMENT_VALUES
            parts.append(values[max(0, first - begin):last - begin])
            if last >= begin + SEGMENT_VALUES:
                self.ring.removeKey((segment,))
        return np.concatenate(parts) if parts else np.empty(0)

    def _arriving(self, answered: int, values: np.ndarray) -> None:
        at = 0
        while at < len(values):
            segment, filled = divmod(answered + at, SEGMENT_VALUES)
            some = values[at:at + SEGMENT_VALUES - filled]
            before = list(self.ring.getValue((segment,))[0]) if filled else []
            self.ring.updateValue((segment,), (before + some.tolist(),))
            at += len(some)

    def _send(self, key, totals: list, blocks: SortedBlocks) -> tuple:
        first, last, period, _, errors, hits, misses = totals
        *points, mean, std, n = blocks.figures()
        elapsed = (last - first) / 1000.0
        return (
            key[0], period * self.report, *points, mean, std, n / elapsed if elapsed > 0 else 0.0,
            min(errors, self.window) / n if n else 0.0, hits / (hits + misses) if n and hits + misses else 0.0, n)

    def handleInputRows(self, key, rows, timerValues):
        frame = _in_order(rows, ["ts_ms", "event_id"])
        ts = frame["ts_ms"].to_numpy(np.int64)
        known = list(self.totals.get()) if self.totals.exists() else [int(ts[0]), int(ts[0]), int(ts[0]) // self.report, 0, 0, 0, 0]
        index = list(zip(*self.index.get())) if self.index.exists() else []
        blocks = SortedBlocks(index, lambda name: self.blocks.getValue((name,))[0])
        period = np.maximum(ts // self.report, known[2])
        latency = frame["latency_ms"].to_numpy(np.float64, na_value=np.nan)
        ok = frame["ok"].to_numpy(object) == True  # noqa: E712
        hit = frame["cache_hit"].to_numpy(object)
        cuts = np.flatnonzero(np.diff(period, prepend=period[0])).tolist()
        sent = []
        for a, b in zip([0, *cuts], [*cuts, len(ts)]):
            if period[a] > known[2]:
                sent.append(self._send(key, known, blocks))
                known[2] = int(period[a])
            come = latency[a:b][ok[a:b] & ~np.isnan(latency[a:b])]
            answered = known[3]
            self._arriving(answered, come)
            go = self._leaving(max(0, answered - self.window), max(0, answered + len(come) - self.window))
            blocks.change(come, go)
            known[0], known[1] = min(known[0], int(ts[a:b].min())), max(known[1], int(ts[a:b].max()))
            known[3:] = [
                answered + len(come), known[4] + int((~ok[a:b]).sum()),
                known[5] + int((hit[a:b] == True).sum()), known[6] + int((hit[a:b] == False).sum())]  # noqa: E712
        self.totals.update(tuple(known))
        self.index.update(tuple(list(column) for column in zip(*blocks.index)))
        for name in sorted(blocks.changed):
            self.blocks.updateValue((name,), (blocks.at_hand[name].tolist(),))
        for name in sorted(blocks.dropped):
            if self.blocks.containsKey((name,)):
                self.blocks.removeKey((name,))
        if sent:
            yield pd.DataFrame(sent, columns=SERVICE_COLUMNS)

    def close(self) -> None:
        pass


SERVICE_COLUMNS = [
    "service", "period_ms", "p50", "p95", "p99", "mean", "std", "throughput", "error_rate", "cache_hit_rate", "total_predictions"]
SERVICE_OUTPUT = (
    "service long, period_ms long, p50 double, p95 double, p99 double, mean double, std double, throughput double, "
    "error_rate double, cache_hit_rate double, total_predictions long")
