"""Cold-start lists with their cache per user (R2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.list_cache import list_versions, stored_lists
from ..sources.tables import behaviour
from .registry import query

LIMIT = 20

VERSIONS_SQL = f"""
days AS (SELECT unnest(range((SELECT min(ts_ms) - min(ts_ms) % 86400000 FROM ev), (SELECT max(ts_ms) + 1 FROM ev), 86400000)) AS day),
popular AS (SELECT day, product_id, row_number() OVER (PARTITION BY day ORDER BY count(*) DESC, product_id DESC) AS r
            FROM days JOIN ev ON ts_ms < day WHERE event_type IN ('view', 'purchase') GROUP BY 1, 2 QUALIFY r <= {LIMIT}),
trending AS (SELECT day, product_id, row_number() OVER (PARTITION BY day ORDER BY count(*) DESC, product_id DESC) AS r
             FROM days JOIN ev ON ts_ms < day AND ts_ms >= day - 86400000 WHERE event_type IN ('view', 'purchase')
             GROUP BY 1, 2 QUALIFY r <= {LIMIT}),
merged AS (SELECT day, product_id, min(place) AS place
           FROM (SELECT day, product_id, r AS place FROM popular UNION ALL SELECT day, product_id, 1000 + r FROM trending)
           GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY day ORDER BY min(place)) <= {LIMIT}),
versions AS (SELECT day, coalesce(string_agg(product_id, ',' ORDER BY place), '') AS products
             FROM days LEFT JOIN merged USING (day) GROUP BY 1)
"""


@query("r2_list_versions", f"WITH {VERSIONS_SQL} SELECT day AS period_ms, products FROM versions")
def r2_list_versions(spark, folder):
    versions = list_versions(behaviour(spark, folder, with_catalog=False), LIMIT)
    return versions.select("period_ms", F.array_join("products", ",").alias("products"))


@query("r2_stored_lists", f"""
WITH RECURSIVE {VERSIONS_SQL},
ordered AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts_ms, event_id) AS n FROM ev),
walk AS (
  SELECT user_id, n, event_id, ts_ms AS made_at_ms, false AS reused FROM ordered WHERE n = 1
  UNION ALL
  SELECT o.user_id, o.n, o.event_id, CASE WHEN o.ts_ms - w.made_at_ms < 3600000 THEN w.made_at_ms ELSE o.ts_ms END,
         o.ts_ms - w.made_at_ms < 3600000
  FROM walk w JOIN ordered o ON o.user_id = w.user_id AND o.n = w.n + 1
)
SELECT event_id, user_id, made_at_ms, reused, products FROM walk JOIN versions ON day = made_at_ms - made_at_ms % 86400000
""")
def r2_stored_lists(spark, folder):
    """Every event asks for its user's list; the one in force changes by day."""
    events = behaviour(spark, folder, with_catalog=False)
    found = stored_lists(events.select("user_id", "ts_ms", "event_id"), list_versions(events, LIMIT))
    return found.select("event_id", "user_id", "made_at_ms", "reused", F.array_join("products", ",").alias("products"))
