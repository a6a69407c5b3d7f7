"""Keyed state with event-time timers: windows that late events correct (X1, X2, U1), sessions that silence closes (X7), and
state that starts from batch results (X6, S8).

Timers follow the stream's watermark, so results do not depend on the clock of a machine, and a run over what is there ends
with everything sent that the last watermark allows. What a key holds is bounded by the time its windows or its session last.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from ..operators.profiles import PURCHASE, VIEW
from ..operators.sessions import CAP_MS, KEPT_EVENTS
from .buckets import KeyTable, TimedBuckets, in_buckets, unpacked
from .processors import NAMES, SESSION_STATE_MS, MergedProfiles


class CorrectedWindows(TimedBuckets):
    """X2 with allowed lateness, per user: a window is sent when it is complete, and again when a late event enters it.

    The stream's watermark has to lie ``allowed_ms`` behind the one that completes windows, as Spark drops what is older than
    it. A window is thus complete ``allowed_ms`` before its end by that watermark, and dropped at its end; both are timers. A
    frame of rows is reduced to its windows before the next one is read. The state has a row per user and window.
    """

    def __init__(self, size_ms: int = 600_000, allowed_ms: int = 300_000):
        self.size, self.allowed = size_ms, allowed_ms

    def init(self, handle) -> None:
        super().init(handle)
        self.windows = KeyTable(handle, "windows", [*self.keys, "start"], {
            "viewed": NAMES, "purchased": NAMES, "events": pa.int64(), "first": pa.int64(), "last": pa.int64(),
            "revision": pa.int32()})

    def _merged(self, found: dict, frame: pd.DataFrame) -> None:
        for user, ts, kind, product in zip(*(frame[c].tolist() for c in ("user_id", "ts_ms", "event_type", "product_id"))):
            place = user, ts - ts % self.size
            window = found.get(place)
            if window is None:
                window = found[place] = [set(), set(), 0, ts, ts]
            if product is not None and kind in (VIEW, PURCHASE):
                window[0 if kind == VIEW else 1].add(product)
            window[2] += 1
            window[3], window[4] = min(window[3], ts), max(window[4], ts)

    def handleInputRows(self, key, rows, timerValues):
        found: dict[tuple, list] = {}
        for frame in rows:
            self._merged(found, frame)
        watermark, windows, out = timerValues.getCurrentWatermarkInMs(), self.windows.read(), []
        for place, (viewed, purchased, events, first, last) in found.items():
            old = windows.get(place)
            revision = -1
            if old is not None:
                viewed, purchased, events = viewed.union(old[0]), purchased.union(old[1]), events + old[2]
                first, last, revision = min(first, old[3]), max(last, old[4]), old[5]
            if revision >= 0 or place[1] + self.size - self.allowed <= watermark:
                revision += 1
            state = windows[place] = (sorted(viewed), sorted(purchased), events, first, last, revision)
            if revision >= 0:
                out.append((*place, *state))
        self._keep(windows)
        if out:
            yield pd.DataFrame(out, columns=WINDOW_COLUMNS)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark, kept, out = timerValues.getCurrentWatermarkInMs(), {}, []
        for place, state in self.windows.read().items():
            if state[5] < 0 and place[1] + self.size - self.allowed <= watermark:
                state = (*state[:5], 0)
                out.append((*place, *state))
            if place[1] + self.size > watermark:
                kept[place] = state
        self.timer.clear()  # Spark has taken it
        self._keep(kept)
        if out:
            yield pd.DataFrame(out, columns=WINDOW_COLUMNS)

    def _keep(self, windows: dict[tuple, tuple]) -> None:
        self.windows.write(windows)
        self._wake(min((
            start + self.size - (self.allowed if state[5] < 0 else 0) for (_, start), state in windows.items()), default=None))


WINDOW_COLUMNS = [
    "user_id", "window_start_ms", "viewed_products", "purchased_products", "events", "first_activity_ms", "last_activity_ms",
    "revision"]
WINDOW_OUTPUT = (
    "user_id string, window_start_ms long, viewed_products array<string>, purchased_products array<string>, events long, "
    "first_activity_ms long, last_activity_ms long, revision int")


class SilentSessions(TimedBuckets):
    """X4 with X7's lifetime, per user: a session closes at its cap, or is sent by a timer after a silence.

    What a bucket costs in a micro-batch whatever its rows, some 25 ms for its timer, frames and state, was nearly half of the time at 1024.
    """

    buckets = 256

    def __init__(self, cap_ms: int = CAP_MS, silence_ms: int = SESSION_STATE_MS):
        self.cap, self.silence = cap_ms, silence_ms

    def init(self, handle) -> None:
        super().init(handle)
        self.open = KeyTable(handle, "open", self.keys, {
            "start": pa.int64(), "last": pa.int64(), "events": pa.int64(), "products": NAMES, "categories": NAMES})

    def handleInputRows(self, key, rows, timerValues):
        frame, groups = self._in_order(rows, ["ts_ms", "event_id"])
        columns = [frame[c].tolist() for c in ("ts_ms", "product_id", "category_id")]
        sessions, closed = self.open.read(), []
        for name, a, b in groups:
            current = sessions.pop(name, None)
            if current is not None:
                current = [*current[:3], *map(set, current[3:])]
            for ts, product, category in zip(*(c[a:b] for c in columns)):
                if current is not None and ts - current[1] > self.silence:
                    closed.append((name, *current, "silent"))
                    current = None
                if current is None:
                    current = [ts, ts, 0, set(), set()]
                current[1], current[2] = max(current[1], ts), current[2] + 1
                for seen, item in zip(current[3:], (product, category)):
                    if item is not None:
                        seen.add(item)
                if ts - current[0] > self.cap:
                    closed.append((name, *current, "cap"))
                    current = None
            if current is not None:
                sessions[name] = (*current[:3], sorted(current[3]), sorted(current[4]))
        # What the watermark closes goes at once; a timer would read and write the state once more in this micro-batch.
        self._keep(self._open_at(timerValues.getCurrentWatermarkInMs(), sessions, closed))
        if closed:
            yield self._sent(closed)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        closed = []
        kept = self._open_at(timerValues.getCurrentWatermarkInMs(), self.open.read(), closed)
        self.timer.clear()  # Spark has taken it
        self._keep(kept)
        if closed:
            yield self._sent(closed)

    def _open_at(self, watermark: int, sessions: dict[tuple, tuple], closed: list) -> dict[tuple, tuple]:
        kept = {}
        for name, state in sessions.items():
            if state[1] + self.silence < watermark:
                closed.append((name, *state, "silent"))
            else:
                kept[name] = state
        return kept

    def _keep(self, sessions: dict[tuple, tuple]) -> None:
        self.open.write(sessions)
        self._wake(min((state[1] + self.silence + 1 for state in sessions.values()), default=None))

    @staticmethod
    def _sent(closed: Sequence[tuple]) -> pd.DataFrame:
        return pd.DataFrame([
            (name[0], start, last, last - start, min(events, KEPT_EVENTS), len(products), len(categories), reason)
            for name, start, last, events, products, categories, reason in closed], columns=CLOSED_COLUMNS)


CLOSED_COLUMNS = [
    "user_id", "start_time", "last_update", "duration_ms", "event_count", "unique_products", "unique_categories", "reason"]
CLOSED_OUTPUT = (
    "user_id string, start_time long, last_update long, duration_ms long, event_count long, unique_products long, "
    "unique_categories long, reason string")


class ResumedProfiles(MergedProfiles):
    """X6 that goes on from profiles merged in batch (A2)."""

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        profiles = self.profile.read()  # a bucket may come in several frames
        for row in unpacked([initialState]).itertuples(index=False):
            profiles[(row.user_id,)] = (
                list(row.viewed_products), list(row.purchased_products), list(row.categories_preferred), int(row.last_activity_ms),
                int(row.session_count), float(row.avg_session_duration))
        self.profile.write(profiles)


def timed(stream: DataFrame, key: str, processor: TimedBuckets, output: str, delay_ms: int) -> DataFrame:
    """A processor with timers; ``stream`` has event_time, and rows more than ``delay_ms`` behind the largest one are dropped."""
    watermarked = stream.withWatermark("event_time", f"{delay_ms} milliseconds")
    return in_buckets(watermarked, processor, [key]).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=output, outputMode="Append", timeMode="EventTime")


def corrected_windows(
    stream: DataFrame, *, size_ms: int = 600_000, out_of_orderness_ms: int = 5000, allowed_ms: int = 300_000,
) -> DataFrame:
    """Windows of ``main_stream`` events, with a further revision whenever a late event changes a sent one."""
    return timed(stream, "user_id", CorrectedWindows(size_ms, allowed_ms), WINDOW_OUTPUT, out_of_orderness_ms + allowed_ms)


def resumed(stream: DataFrame, profiles: DataFrame, processor: ResumedProfiles, output: str) -> DataFrame:
    """Keyed profiles over a stream of window profiles, with ``profiles`` from a batch as the state to begin with."""
    keys = ["user_id"]
    return in_buckets(stream, processor, keys).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=output, outputMode="Append", timeMode="None",
        initialState=in_buckets(profiles, processor, keys))


def each_once(stream: DataFrame, key: Sequence[str], within: str) -> DataFrame:
    """One row per key of a stream whose rows are delivered again within ``within`` of event time.

    A key leaves the state when the watermark passes the end of its time, so the state is bounded by that time.
    """
    return stream.withWatermark("event_time", within).dropDuplicatesWithinWatermark(list(key))
