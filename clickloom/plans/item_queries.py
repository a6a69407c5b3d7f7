"""Queries on item co-occurrence."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.cooccurrence import baskets_of, cooccurring, item_pairs, similar_items
from ..sources.tables import behaviour
from .registry import query

PAIRS_SQL = """
basket AS (SELECT user_id, product_id, bool_or(event_type = 'purchase') AS bought FROM ev
           WHERE event_type IN ('view', 'purchase') GROUP BY 1, 2),
pairs AS (SELECT a.product_id AS item_a, b.product_id AS item_b, count(*) AS users
          FROM basket a JOIN basket b ON a.user_id = b.user_id AND a.product_id < b.product_id GROUP BY 1, 2)
"""

SIMILAR_SQL = f"""
{PAIRS_SQL},
sizes AS (SELECT product_id, count(*) AS users FROM basket GROUP BY 1),
steps AS (SELECT item_a, item_b, CAST(floor(p.users / sqrt(CAST(a.users AS DOUBLE) * b.users) * 1000000000 + 0.5) AS BIGINT) AS step
          FROM pairs p JOIN sizes a ON a.product_id = item_a JOIN sizes b ON b.product_id = item_b),
near AS (SELECT * FROM (SELECT item_a AS product_id, item_b AS neighbour, step FROM steps
                        UNION ALL SELECT item_b, item_a, step FROM steps)
         QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY step DESC, neighbour) <= 50)
"""

# Users with more products than this are counted by blocks; the given users have few, so it is lower than the default.
LIGHT = 20


@query("r3_item_pairs", f"WITH {PAIRS_SQL} SELECT * FROM pairs")
def r3_item_pairs(spark, folder):
    return item_pairs(baskets_of(behaviour(spark, folder, with_catalog=False)), light_items=LIGHT, block_items=16)


@query("r3_similar_items", f"WITH {SIMILAR_SQL} SELECT product_id, neighbour, step / 1000000000.0::DOUBLE AS similarity FROM near")
def r3_similar_items(spark, folder):
    baskets = baskets_of(behaviour(spark, folder, with_catalog=False))
    return similar_items(item_pairs(baskets, light_items=LIGHT), baskets).select("product_id", "neighbour", "similarity")


@query("r3_cooccurrence", f"""
WITH {SIMILAR_SQL},
owned AS (SELECT user_id, count(*) AS n FROM basket GROUP BY 1),
offered AS (SELECT user_id, neighbour AS product_id, sum(step) AS total FROM basket JOIN near USING (product_id) GROUP BY 1, 2),
scored AS (SELECT user_id, product_id, CAST(total AS DOUBLE) / n / 1000000000 AS score FROM offered o JOIN owned USING (user_id)
           WHERE NOT EXISTS (SELECT 1 FROM basket b WHERE b.user_id = o.user_id AND b.product_id = o.product_id AND bought))
SELECT user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY score DESC, product_id) - 1 AS INTEGER) AS position,
       product_id, score, 'cooccurrence' AS reason FROM scored QUALIFY position < 20
""")
def r3_cooccurrence(spark, folder):
    return cooccurring(behaviour(spark, folder, with_catalog=False), light_items=LIGHT)
