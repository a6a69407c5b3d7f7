"""Keyed state for streams: late classes (X3), sessions (X4), trailing activity (W1), profiles and lists (X6),
cached scores (J4).

Micro-batches are handled in the order they arrive, and the rows of a key inside one by time (late classes: by
arrival), so sources that are in order up to the size of a micro-batch give the same rows however they are cut; older rows
that come in a later micro-batch are held against the state as it is then. Spark hands over the rows of one key in one
micro-batch, whose size the source limits; the state of a key is bounded by the cap, the frame or the lifetime it serves.
But for late classes, whose shards are few, keys come and are kept by buckets (``buckets``).
With a lifetime (X7: ``SESSION_STATE_MS`` and its like as ``state_ms``) a key that stops arriving leaves the state by the
clock. Such a query looks at the clock again and again, so it is one that runs on; a run over what is there, which ends,
has no lifetime, and compares stored times with event times where that is asked for.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor

from ..operators.late import DISCARDED, MODERATE, ON_TIME, VERY_LATE
from ..operators.profiles import ENOUGH_VIEWED
from ..operators.recommend import CACHE_LIST_MS
from ..operators.scoring import CACHE_MS
from ..operators.sessions import CAP_MS, KEPT_EVENTS, KEPT_SESSIONS
from .buckets import BucketProcessor, KeyTable, in_buckets

# Lifetimes of keyed state.
SESSION_STATE_MS, WINDOW_STATE_MS, CACHE_STATE_MS = 3_600_000, 300_000, 300_000


def _in_order(frames: Iterator[pd.DataFrame], by: list[str]) -> pd.DataFrame:
    return pd.concat(list(frames), ignore_index=True).sort_values(by, kind="stable", ignore_index=True)


class LateClasses(StatefulProcessor):
    """X3 per shard: the state is the largest timestamp that arrived so far."""

    def __init__(self, out_of_orderness_ms: int = 5000, allowed_ms: int = 300_000, max_ms: int = 1_800_000):
        self.slack, self.allowed, self.max = out_of_orderness_ms, allowed_ms, max_ms

    def init(self, handle) -> None:
        self.latest = handle.getValueState("latest", "ts long")

    def handleInputRows(self, key, rows, timerValues):
        frame = _in_order(rows, ["arrival_ms", "event_id"])
        ts = frame["ts_ms"].to_numpy(np.int64)
        known = self.latest.get()[0] if self.latest.exists() else None
        start = np.iinfo(np.int64).min if known is None else known
        highest = np.maximum.accumulate(np.append(start, ts))
        self.latest.update((int(highest[-1]),))
        has = highest[:-1] != np.iinfo(np.int64).min
        mark = np.where(has, highest[:-1], 0) - self.slack
        delay = mark - ts
        kind = np.select(
            [~has | (delay < 0), delay <= self.allowed, delay <= self.max], [ON_TIME, MODERATE, VERY_LATE], DISCARDED
        )
        window = np.isin(kind, [MODERATE, VERY_LATE])
        start_ms = ts - ts % 60_000
        blank = lambda values, keep: pd.array(np.where(keep, values, 0), "Int64").copy()
        out = pd.DataFrame({"event_id": frame["event_id"], "shard": frame["shard"], "ts_ms": ts})
        for name, values, keep in (
            ("watermark_ms", mark, has), ("window_start_ms", start_ms, window), ("window_end_ms", start_ms + 60_000, window)
        ):
            column = blank(values, keep)
            column[~keep] = pd.NA
            out[name] = column
        out["delay_seconds"] = np.where(has, delay / 1000.0, np.nan)
        out["late_class"] = kind
        yield out

    def close(self) -> None:
        pass


LATE_OUTPUT = (
    "event_id long, shard long, ts_ms long, watermark_ms long, window_start_ms long, window_end_ms long, "
    "delay_seconds double, late_class string"
)


NAMES = pa.list_(pa.string())


class CappedSessions(BucketProcessor):
    """X4 per user: the open session in one table, the starts and durations of the last ten in another."""

    def __init__(self, cap_ms: int = CAP_MS, lifetime_ms: int | None = None, state_ms: int | None = None):
        self.cap, self.lifetime, self.state_ms = cap_ms, lifetime_ms, state_ms

    def init(self, handle) -> None:
        times = pa.list_(pa.int64())
        self.open = KeyTable(handle, "open", self.keys, {
            "start": pa.int64(), "last": pa.int64(), "times": times, "products": NAMES, "categories": NAMES}, self.state_ms)
        self.history = KeyTable(handle, "history", self.keys, {"starts": times, "durations": times}, self.state_ms)

    def handleInputRows(self, key, rows, timerValues):
        frame, groups = self._in_order(rows, ["ts_ms", "event_id"])
        columns = [frame[c].tolist() for c in ("ts_ms", "product_id", "category_id")]
        sessions, out = self.open.read(), []
        for name, a, b in groups:
            current, found = sessions.pop(name, None), []
            if current is not None:
                start, last, times, products, categories = current
                current = [start, last, times, set(products), set(categories)]
            for ts, product, category in zip(*(c[a:b] for c in columns)):
                if current is not None and self.lifetime is not None and ts - current[1] > self.lifetime:
                    current = None
                if current is None:
                    current = [ts, ts, [], set(), set()]
                current[1] = ts
                current[2].append(ts)
                if len(current[2]) > KEPT_EVENTS:
                    del current[2][0]
                if product is not None:
                    current[3].add(product)
                if category is not None:
                    current[4].add(category)
                if ts - current[0] > self.cap:
                    found.append(current)
                    current = None
            if current is not None:
                sessions[name] = (*current[:3], sorted(current[3]), sorted(current[4]))
            if found:
                out.append((name, found))
        self.open.write(sessions)
        if out:
            history = self.history.read()
            for name, found in out:
                kept = [*zip(*history.get(name, ((), ()))), *((c[0], c[1] - c[0]) for c in found)]
                history[name] = tuple(map(list, zip(*sorted(kept)[-KEPT_SESSIONS:])))
            self.history.write(history)
            yield pd.DataFrame(
                [(name[0], c[0], c[1], c[1] - c[0], len(c[2]), len(c[3]), len(c[4])) for name, found in out for c in found],
                columns=["user_id", "start_time", "last_update", "duration_ms", "event_count", "unique_products",
                         "unique_categories"])


SESSION_OUTPUT = (
    "user_id string, start_time long, last_update long, duration_ms long, event_count long, unique_products long, "
    "unique_categories long"
)


class TrailingActivity(BucketProcessor):
    """W1 per user: the events of the trailing frame are the state; each arrival drops what is too old for it."""

    def __init__(self, width_ms: int = 60_000, state_ms: int | None = None):
        self.width, self.state_ms = width_ms, state_ms

    def init(self, handle) -> None:
        self.recent = KeyTable(handle, "recent", self.keys, {"times": pa.list_(pa.int64()), "kinds": NAMES}, self.state_ms)

    def handleInputRows(self, key, rows, timerValues):
        frame, groups = self._in_order(rows, ["ts_ms", "event_id"])
        arrived, arrived_kinds = frame["ts_ms"].tolist(), frame["event_type"].tolist()
        recent, totals, maps = self.recent.read(), [], []
        for name, a, b in groups:
            times, kinds = (list(x) for x in recent.get(name, ((), ())))
            recent[name] = self._counted(times, kinds, zip(arrived[a:b], arrived_kinds[a:b]), totals, maps)
        self.recent.write(recent)
        yield frame[["event_id", "user_id", "ts_ms"]].assign(
            total_events=totals, event_type_counts=maps, events_per_second=np.array(totals) / (self.width / 1000.0))

    def _counted(self, times: list, kinds: list, rows: Iterator[tuple], totals: list, maps: list) -> tuple[list, list]:
        """Adds the figures of the rows of one key; returns what is left in the frame."""
        first, counts = 0, {}
        for kind in kinds:
            counts[kind] = counts.get(kind, 0) + 1
        in_order = times == sorted(times)
        for ts, kind in rows:
            in_order = in_order and (not times or times[-1] <= ts)
            times.append(ts)
            kinds.append(kind)
            counts[kind] = counts.get(kind, 0) + 1
            if not in_order:
                keep = [i for i in range(first, len(times)) if ts - times[i] <= self.width]
                times, kinds, first, counts = [times[i] for i in keep], [kinds[i] for i in keep], 0, {}
                for k in kinds:
                    counts[k] = counts.get(k, 0) + 1
                in_order = times == sorted(times)
            while ts - times[first] > self.width:
                counts[kinds[first]] -= 1
                first += 1
            totals.append(len(times) - first)
            maps.append({k: n for k, n in counts.items() if n})
        return times[first:], kinds[first:]


ACTIVITY_OUTPUT = (
    "event_id long, user_id string, ts_ms long, total_events long, event_type_counts map<string,long>, "
    "events_per_second double"
)


class MergedProfiles(BucketProcessor):
    """X6/R1/A2 per user: the merged profile, and when its list of recommendations was made.

    A profile that arrives while the list is younger than its lifetime reuses it; the stored profile is not
    touched then, as the list is sent again before the profile is looked at.
    """

    def __init__(self, list_ms: int = CACHE_LIST_MS):
        self.list_ms = list_ms

    def init(self, handle) -> None:
        self.profile = KeyTable(handle, "profile", self.keys, {
            "viewed": NAMES, "purchased": NAMES, "categories": NAMES, "last": pa.int64(), "sessions": pa.int64(),
            "mean": pa.float64()})
        self.made = KeyTable(handle, "made", self.keys, {"at": pa.int64(), "route": pa.string()})

    def handleInputRows(self, key, rows, timerValues):
        frame, groups = self._in_order(rows, ["window_start_ms"])
        columns = [frame[c].tolist() for c in (
            "window_start_ms", "viewed_products", "purchased_products", "categories_preferred", "last_activity_ms",
            "avg_session_duration")]
        profiles, lists, out = self.profile.read(), self.made.read(), []
        for name, a, b in groups:
            known, made = profiles.get(name), lists.get(name)
            for at, viewed, purchased, categories, last, duration in zip(*(c[a:b] for c in columns)):
                reused = made is not None and at - made[0] < self.list_ms
                if not reused:
                    sets = [set(viewed), set(purchased), set(categories)]
                    if known is None:
                        route = "personalized" if len(sets[0]) >= ENOUGH_VIEWED else "cold_start"
                        known = (*map(sorted, sets), int(last), 1, float(duration))
                    else:
                        route, n = "personalized", known[4] + 1
                        merged = [old if new.issubset(old) else sorted(new.union(old)) for old, new in zip(known[:3], sets)]
                        known = (*merged, max(known[3], int(last)), n, (known[5] * known[4] + float(duration)) / n)
                    made = (int(at), route)
                out.append((name[0], int(at), made[0], made[1], reused, known[4], known[5], *known[:3]))
            profiles[name], lists[name] = known, made
        self.profile.write(profiles)
        self.made.write(lists)
        yield pd.DataFrame(out, columns=[
            "user_id", "window_start_ms", "generated_at_ms", "route", "reused", "session_count",
            "avg_session_duration", "viewed_products", "purchased_products", "categories_preferred",
        ])


PROFILE_OUTPUT = (
    "user_id string, window_start_ms long, generated_at_ms long, route string, reused boolean, session_count long, "
    "avg_session_duration double, viewed_products array<string>, purchased_products array<string>, "
    "categories_preferred array<string>"
)


class CachedScores(BucketProcessor):
    """J4/R5 per user and product: the stored score and when it was made. A request without a score stores nothing."""

    def __init__(self, ttl_ms: int = CACHE_MS, state_ms: int | None = None):
        self.ttl, self.state_ms = ttl_ms, state_ms

    def init(self, handle) -> None:
        self.entry = KeyTable(handle, "entry", self.keys, {"score": pa.float64(), "at": pa.int64()}, self.state_ms)

    def handleInputRows(self, key, rows, timerValues):
        frame, groups = self._in_order(rows, ["ts_ms", "event_id"])
        times, own = frame["ts_ms"].tolist(), frame["score"].to_numpy(np.float64, na_value=np.nan).tolist()
        entries, cached, scores, made = self.entry.read(), [], [], []
        for name, a, b in groups:
            stored = entries.get(name)
            for ts, score in zip(times[a:b], own[a:b]):
                young = stored is not None and ts - stored[1] < self.ttl
                if not young and score == score:  # not NaN
                    stored = entries[name] = (score, ts)
                answer = stored if young or score == score else (None, None)
                cached.append(young)
                scores.append(answer[0])
                made.append(answer[1])
        self.entry.write(entries)
        yield frame[["event_id", "user_id", "product_id"]].assign(
            score=pd.array(scores, "Float64"), cached=cached, cached_at_ms=pd.array(made, "Int64"))


SCORE_OUTPUT = "event_id long, user_id string, product_id string, score double, cached boolean, cached_at_ms long"


def keyed(df: DataFrame, key: str | list[str], processor: StatefulProcessor, output: str) -> DataFrame:
    keys = [key] if isinstance(key, str) else key
    clock = "ProcessingTime" if getattr(processor, "state_ms", None) else "None"
    grouped = in_buckets(df, processor, keys) if isinstance(processor, BucketProcessor) else df.groupBy(*keys)
    return grouped.transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=output, outputMode="Append", timeMode=clock
    )
