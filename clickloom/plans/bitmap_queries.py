"""Queries on profile sets as bitmaps."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.bitmaps import (
    in_words, item_numbers, merged_words, profile_events, window_words, word_members, word_sizes,
)
from ..session import prepare_streaming, stored
from ..sources.files import stream_events
from ..sources.tables import behaviour
from ..streaming.blocks import SIZE_OUTPUT, WordProfiles
from ..streaming.processors import keyed
from .aggregate_queries import PROFILES_SQL
from .registry import CHECKS, query
from .stream_queries import ONE_FILE, _finished, _in_files

ENTRIES_SQL = """
entries AS (
  SELECT DISTINCT user_id, 'viewed' AS kind, product_id AS item FROM ev WHERE event_type = 'view' AND product_id IS NOT NULL
  UNION ALL SELECT DISTINCT user_id, 'purchased', product_id FROM ev WHERE event_type = 'purchase' AND product_id IS NOT NULL
  UNION ALL SELECT DISTINCT user_id, 'category', category_code FROM ev
            WHERE event_type IN ('view', 'purchase') AND category_code <> '')
"""


def _words(spark, folder):
    """The sets of all users, from the words of two periods, and the numbers of the items."""
    entries = profile_events(behaviour(spark, folder))
    numbers = stored(item_numbers(entries), "numbers")
    first = F.col("window_start_ms") < F.unix_millis(F.expr("TIMESTAMP '2024-01-16 00:00:00'"))
    periods = [in_words(entries.where(part), numbers, ["user_id"]) for part in (first, ~first)]
    return merged_words(periods[0].unionByName(periods[1]), ["user_id"]), numbers


@query("a2_bitmap_sizes", f"""
WITH {ENTRIES_SQL}
SELECT user_id, count(*) FILTER (kind = 'viewed') AS viewed_items, count(*) FILTER (kind = 'purchased') AS purchased_items,
       count(*) FILTER (kind = 'category') AS category_items FROM entries GROUP BY 1
""")
def a2_bitmap_sizes(spark, folder):
    return word_sizes(_words(spark, folder)[0])


@query("a2_bitmap_members", f"WITH {ENTRIES_SQL} SELECT * FROM entries")
def a2_bitmap_members(spark, folder):
    return word_members(*_words(spark, folder))


@query("a1_item_numbers", f"""
WITH {PROFILES_SQL},
used AS (SELECT 'product' AS domain, product_id AS item, count(*) FILTER (event_type = 'view') + count(*) FILTER (event_type = 'purchase') AS n
         FROM ev WHERE event_type IN ('view', 'purchase') AND product_id IS NOT NULL GROUP BY 2
         UNION ALL SELECT 'category', category_code, count(*) FROM ev WHERE event_type IN ('view', 'purchase') AND category_code <> ''
         GROUP BY 2)
SELECT domain, item, row_number() OVER (PARTITION BY domain ORDER BY CAST(floor(-log2(n)) AS INTEGER), item) AS number FROM used
""")
def a1_item_numbers(spark, folder):
    return item_numbers(profile_events(behaviour(spark, folder)))


@query("x6_stream_blocks", CHECKS["a2_running_profiles"], events=False)
def x6_stream_blocks(spark, folder):
    """A2 at every window, from a stream that keeps the sets as bitmap words."""
    prepare_streaming(spark)
    events = behaviour(spark, folder)
    numbers = stored(item_numbers(profile_events(events)), "numbers")
    rows = window_words(events, numbers).withColumn("event_id", F.xxhash64("user_id", "window_start_ms"))
    path = _in_files(spark, rows, "window_start_ms", "window-words")
    stream = stream_events(spark, path, rows.schema, ONE_FILE)
    found = _finished(spark, keyed(stream, "user_id", WordProfiles(), SIZE_OUTPUT), "block-profiles")
    return found.withColumn("avg_session_duration", F.round("avg_session_duration", 4))
