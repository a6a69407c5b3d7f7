"""Profiles over a stream with their sets as bitmap words in keyed state."""

from __future__ import annotations

from itertools import groupby
from operator import itemgetter

import pandas as pd
import pyarrow as pa

from ..operators.bitmaps import DOMAINS
from .buckets import BucketProcessor, KeyTable

BITS = 2**64 - 1


class WordProfiles(BucketProcessor):
    """Per user, a row for each word of each set, and the sizes. A window changes the words it touches, and sends sizes, not sets."""

    def init(self, handle) -> None:
        self.words = KeyTable(handle, "words", [*self.keys, "kind", "word"], {"bits": pa.int64()})
        self.figures = KeyTable(handle, "figures", self.keys, {
            "viewed": pa.int64(), "purchased": pa.int64(), "category": pa.int64(), "sessions": pa.int64(), "last": pa.int64(),
            "spent": pa.float64()})

    def handleInputRows(self, key, rows, timerValues):
        frame, groups = self._in_order(rows, ["window_start_ms"])
        columns = [frame[c].tolist() for c in ("window_start_ms", "kind", "word", "bits", "last_activity_ms", "avg_session_duration")]
        words, figures, out = self.words.read(), self.figures.read(), []
        for name, a, b in groups:
            *known, sessions, last, spent = figures.get(name, (0, 0, 0, 0, None, 0.0))
            sizes = dict(zip(DOMAINS, known))
            for window, shown in groupby(zip(*(c[a:b] for c in columns)), key=itemgetter(0)):
                for _, kind, word, bits, at, duration in shown:
                    if kind in sizes:
                        (old,) = words.get((*name, kind, word), (0,))
                        sizes[kind] += (bits & ~old & BITS).bit_count()
                        words[(*name, kind, word)] = (bits | old,)
                    else:  # the window itself
                        spent, sessions = spent + duration, sessions + 1
                        last = int(at) if last is None else max(last, int(at))
                out.append((name[0], window, *sizes.values(), sessions, last, spent / sessions))
            figures[name] = (*sizes.values(), sessions, last, spent)
        self.words.write(words)
        self.figures.write(figures)
        yield pd.DataFrame(out, columns=SIZE_COLUMNS)


SIZE_COLUMNS = [
    "user_id", "window_start_ms", "viewed_items", "purchased_items", "category_items", "session_count", "last_activity_ms",
    "avg_session_duration"]
SIZE_OUTPUT = (
    "user_id string, window_start_ms long, viewed_items long, purchased_items long, category_items long, session_count long, "
    "last_activity_ms long, avg_session_duration double")
