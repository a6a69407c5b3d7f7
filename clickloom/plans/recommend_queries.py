"""Queries on recommendations, features and scoring (2.3, 2.8 and the feature rows of 2.4)."""

from __future__ import annotations


from pyspark.sql import functions as F

from ..functions.keys import pair_score
from ..operators.features import (
    hit_ratio, lookup_product_features, lookup_user_features, transactions_of, upsert_features, user_features,
)
from ..operators.ordered import DAY_MS
from ..operators.recommend import (
    FALLBACK_LIMIT, bought_of, cold_start, cold_start_list, enrich, filter_and_rank, interests_of, personalized, ranked_products,
    recommend, touched_products, user_routes,
)
from ..operators.activity import product_scores
from ..operators.scoring import (
    cached_predictions, failed_batches, request_batches, request_pairs, score_with_cache, score_with_weights,
    with_failure_default,
)
from ..sources.tables import behaviour, catalog, table
from .aggregate_queries import PROFILES_SQL
from .inputs import latest_ms
from .registry import query

PAIR_SCORE_SQL = "('0x' || substr(md5(user_id || '_' || product_id), 1, 8))::BIGINT % 1000 / 1000.0::DOUBLE"

COLD_SQL = """
popular AS (SELECT product_id, row_number() OVER (ORDER BY count(*) DESC, product_id DESC) AS r, 1 AS source
            FROM ev WHERE event_type IN ('view', 'purchase') GROUP BY 1 QUALIFY r <= 20),
trending AS (SELECT product_id, row_number() OVER (ORDER BY count(*) DESC, product_id DESC) AS r, 2 AS source
             FROM ev WHERE event_type IN ('view', 'purchase') AND ts_ms >= (SELECT max(ts_ms) FROM ev) - 86400000
             GROUP BY 1 QUALIFY r <= 20),
merged AS (SELECT product_id, min(source * 1000 + r) AS place
           FROM (SELECT * FROM popular UNION ALL SELECT * FROM trending) GROUP BY 1),
generic AS (SELECT product_id, row_number() OVER (ORDER BY place) - 1 AS position FROM merged
            QUALIFY position < 20)
"""

PERSONAL_SQL = """
ranked AS (SELECT category_code, product_id,
                  count(*) / CAST(max(count(*)) OVER (PARTITION BY category_code) AS DOUBLE) AS score
           FROM ev WHERE event_type IN ('view', 'purchase') GROUP BY 1, 2),
liked AS (SELECT DISTINCT user_id, category_code FROM ev WHERE event_type IN ('view', 'purchase')
          AND category_code <> ''),
bought_pairs AS (SELECT DISTINCT user_id, product_id FROM ev WHERE event_type = 'purchase'),
personal AS (
  SELECT l.user_id, r.product_id, r.score,
         row_number() OVER (PARTITION BY l.user_id ORDER BY r.score DESC, r.product_id) - 1 AS position
  FROM liked l JOIN ranked r USING (category_code)
  WHERE NOT EXISTS (SELECT 1 FROM bought_pairs b WHERE b.user_id = l.user_id AND b.product_id = r.product_id)
  QUALIFY position < 20
)
"""

ROUTES_SQL = """
routes AS (
  SELECT user_id, CASE WHEN count(*) > 1 OR len(list_distinct(flatten(list(viewed)))) >= 3 THEN 'personalized'
                       ELSE 'cold_start' END AS route
  FROM profiles GROUP BY user_id
)
"""


@query("recommendations", f"""
WITH {PROFILES_SQL}, {ROUTES_SQL}, {COLD_SQL}, {PERSONAL_SQL},
made AS (
  SELECT r.user_id, g.product_id, 0.7::DOUBLE AS score, 'cold_start' AS reason, g.position
  FROM routes r JOIN generic g ON r.route = 'cold_start'
  UNION ALL
  SELECT p.user_id, p.product_id, p.score, 'personalized', p.position
  FROM personal p JOIN routes r ON r.user_id = p.user_id AND r.route = 'personalized'
),
best AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, position) AS rank
  FROM made WHERE score >= 0.3 QUALIFY rank <= 10
)
SELECT user_id, product_id, round(score, 9) AS score, reason, CAST(rank AS INTEGER) AS rank, p_name AS product_name,
       p_type AS category, p_retailprice AS price, (SELECT max(ts_ms) FROM ev) AS generated_at_ms
FROM best LEFT JOIN part ON CAST(p_partkey AS VARCHAR) = product_id
""")
def recommendations(spark, folder):
    events = behaviour(spark, folder, with_catalog=False)
    made = recommend(events, catalog(spark, folder), latest_ms(events))
    return made.select(
        "user_id", "product_id", F.round("score", 9).alias("score"), "reason", "rank", "product_name", "category",
        "price", "generated_at_ms",
    )


@query("r1_user_routes", f"WITH {PROFILES_SQL}, {ROUTES_SQL} SELECT user_id, route FROM routes")
def r1_user_routes(spark, folder):
    return user_routes(behaviour(spark, folder, with_catalog=False))


@query("r2_cold_start", f"""
WITH {COLD_SQL}
SELECT u.user_id, CAST(position AS INTEGER) AS position, product_id, 0.7::DOUBLE AS score, 'cold_start' AS reason
FROM (SELECT CAST(c_custkey AS VARCHAR) AS user_id FROM customer
      WHERE CAST(c_custkey AS VARCHAR) NOT IN (SELECT user_id FROM ev)) u, generic
""")
def r2_cold_start(spark, folder):
    events = behaviour(spark, folder, with_catalog=False)
    users = table(spark, folder, "customer").select(F.col("c_custkey").cast("string").alias("user_id"))
    new_users = users.join(events.select("user_id").distinct(), "user_id", "left_anti")
    return cold_start(new_users, cold_start_list(events, latest_ms(events), 20))


@query("r2_fallback", f"""
WITH {COLD_SQL}
SELECT u.user_id, CAST(position AS INTEGER) AS position, product_id, 0.7::DOUBLE AS score, 'fallback' AS reason
FROM (SELECT DISTINCT user_id FROM ev) u, generic WHERE position < 10
""")
def r2_fallback(spark, folder):
    events = behaviour(spark, folder, with_catalog=False)
    return cold_start(
        events.select("user_id").distinct(), cold_start_list(events, latest_ms(events), FALLBACK_LIMIT), "fallback"
    )


@query("j5_popular_trending", f"""
WITH {COLD_SQL} SELECT CAST(position AS INTEGER) AS position, product_id FROM generic
""")
def j5_popular_trending(spark, folder):
    events = behaviour(spark, folder, with_catalog=False)
    return cold_start_list(events, latest_ms(events), 20).select(
        F.posexplode("products").alias("position", "product_id")
    )


@query("r3_personalized", f"""
WITH {PERSONAL_SQL}
SELECT user_id, CAST(position AS INTEGER) AS position, product_id, round(score, 9) AS score FROM personal
""")
def r3_personalized(spark, folder):
    events, products = behaviour(spark, folder, with_catalog=False), catalog(spark, folder)
    touched = touched_products(events, products)
    made = personalized(
        interests_of(touched), bought_of(touched), ranked_products(product_scores(events), products)
    )
    return made.select("user_id", "position", "product_id", F.round("score", 9).alias("score"))


def _scored_pairs(spark, folder):
    """Every event as a recommendation of its product to its user, scored by the pair."""
    return behaviour(spark, folder, with_catalog=False).select(
        "user_id", "product_id", F.col("event_id").alias("position"),
        pair_score(F.col("user_id"), F.col("product_id")).alias("score"),
    )


@query("t1_filter_and_rank", f"""
WITH scored AS (SELECT user_id, product_id, event_id AS position, {PAIR_SCORE_SQL} AS score FROM ev),
first AS (SELECT * FROM scored WHERE score >= 0.3
          QUALIFY row_number() OVER (PARTITION BY user_id, product_id ORDER BY position) = 1)
SELECT user_id, product_id, score, position,
       CAST(row_number() OVER (PARTITION BY user_id ORDER BY score DESC, position) AS INTEGER) AS rank
FROM first QUALIFY rank <= 10
""")
def t1_filter_and_rank(spark, folder):
    return filter_and_rank(_scored_pairs(spark, folder)).select("user_id", "product_id", "score", "position", "rank")


@query("j1_enrich", f"""
SELECT event_id AS position, user_id, CAST(CAST(product_id AS BIGINT) * 25 AS VARCHAR) AS product_id,
       p_name AS product_name, p_type AS category, p_retailprice AS price,
       CASE WHEN p_partkey IS NOT NULL THEN '' END AS image_url, (SELECT max(ts_ms) FROM ev) AS generated_at_ms
FROM (SELECT event_id, user_id, product_id FROM ev) e LEFT JOIN part ON p_partkey = CAST(product_id AS BIGINT) * 25
""")
def j1_enrich(spark, folder):
    pairs = _scored_pairs(spark, folder).select(
        "position", "user_id", (F.col("product_id").cast("long") * 25).cast("string").alias("product_id")
    )
    now = latest_ms(behaviour(spark, folder, with_catalog=False))
    return enrich(pairs, catalog(spark, folder), now).select(
        "position", "user_id", "product_id", "product_name", "category", "price", "image_url", "generated_at_ms"
    )


def _features_sql(name: str, source: str, now: str) -> str:
    return f"""
{name}_latest AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts_ms DESC, event_id DESC) AS r FROM {source}
  QUALIFY r <= 100),
{name}_kinds AS (
  SELECT user_id, category, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, min(r)) AS place
  FROM {name}_latest GROUP BY 1, 2),
{name} AS (
  SELECT user_id, round(avg(amount), 6) AS avg_transaction_amount, count(*) AS total_transactions,
         count(*) FILTER ({now} - ts_ms < 3600000) AS recent_transaction_count,
         round(count(*) FILTER ({now} - ts_ms < 3600000) / 3600.0::DOUBLE, 9) AS transaction_velocity,
         any_value(k.category) AS preferred_category, CAST(300 AS BIGINT) AS session_duration_avg,
         round(({now} - max(ts_ms)) / 86400000.0::DOUBLE, 6) AS days_since_last_purchase
  FROM {name}_latest JOIN {name}_kinds k USING (user_id) WHERE k.place = 1 GROUP BY user_id)
"""


BUYS_SQL = """
buys AS (SELECT user_id, ts_ms, event_id, price AS amount, coalesce(category_code, 'unknown') AS category
         FROM ev WHERE event_type = 'purchase')
"""
NOW_SQL = "(SELECT max(ts_ms) FROM ev)"
FEATURES = (
    "user_id, avg_transaction_amount, total_transactions, recent_transaction_count, transaction_velocity, "
    "preferred_category, session_duration_avg, days_since_last_purchase"
)


def _rounded(features):
    return (
        features.withColumn("avg_transaction_amount", F.round("avg_transaction_amount", 6))
        .withColumn("transaction_velocity", F.round("transaction_velocity", 9))
        .withColumn("days_since_last_purchase", F.round("days_since_last_purchase", 6))
    )


@query("a5_user_features", f"WITH {BUYS_SQL}, {_features_sql('features', 'buys', NOW_SQL)} SELECT {FEATURES} FROM features")
def a5_user_features(spark, folder):
    events = behaviour(spark, folder)
    return _rounded(user_features(
        transactions_of(events), latest_ms(behaviour(spark, folder, with_catalog=False))
    ))


@query("a6_preferred_category", f"""
WITH {BUYS_SQL}, {_features_sql('features', 'buys', NOW_SQL)} SELECT user_id, preferred_category FROM features
""")
def a6_preferred_category(spark, folder):
    events = behaviour(spark, folder)
    return user_features(
        transactions_of(events), latest_ms(behaviour(spark, folder, with_catalog=False))
    ).select("user_id", "preferred_category")


LOOKUP_SQL = f"""
{BUYS_SQL},
old_buys AS (SELECT * FROM buys WHERE ts_ms < {NOW_SQL} - 86400000),
{_features_sql('stored', 'old_buys', f'({NOW_SQL} - 86400000)')},
{_features_sql('fresh', 'buys', NOW_SQL)},
asked AS (SELECT CAST(c_custkey AS VARCHAR) AS user_id, c_custkey % 10 < 5 AND c_custkey % 10 * 60000 < 300000 AS young
          FROM customer),
looked AS (
  SELECT {FEATURES}, true AS hit FROM stored JOIN asked USING (user_id) WHERE young
  UNION ALL
  SELECT a.user_id, coalesce(avg_transaction_amount, 0.0), coalesce(total_transactions, 0),
         coalesce(recent_transaction_count, 0), coalesce(transaction_velocity, 0.0),
         coalesce(preferred_category, 'unknown'), coalesce(session_duration_avg, 0),
         coalesce(days_since_last_purchase, 999.0), false
  FROM asked a LEFT JOIN fresh f USING (user_id)
  WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.user_id = a.user_id AND a.young)
)
"""


def _lookup_inputs(spark, folder):
    """Customers ask for features; stored ones are a day old in content and up to nine minutes in age."""
    now = latest_ms(behaviour(spark, folder, with_catalog=False))
    bought = transactions_of(behaviour(spark, folder))
    stored = user_features(bought.where(F.col("ts_ms") < now - DAY_MS), now - DAY_MS).withColumn(
        "computed_at_ms", now - F.pmod(F.col("user_id").cast("long"), F.lit(10)) * 60_000
    )
    users = table(spark, folder, "customer").select(F.col("c_custkey").cast("string").alias("user_id"))
    return stored, users, bought, now


def _user_lookups(spark, folder):
    stored, users, bought, now = _lookup_inputs(spark, folder)
    return lookup_user_features(users, stored, bought, now)


@query("j2_user_features", f"WITH {LOOKUP_SQL} SELECT {FEATURES}, hit FROM looked")
def j2_user_features(spark, folder):
    return _rounded(_user_lookups(spark, folder)).drop("computed_at_ms")


@query("j2_feature_upsert", f"""
WITH {LOOKUP_SQL}
SELECT user_id, preferred_category, total_transactions, false AS kept FROM looked WHERE NOT hit
UNION ALL
SELECT user_id, preferred_category, total_transactions, true FROM stored s
WHERE NOT EXISTS (SELECT 1 FROM looked l WHERE l.user_id = s.user_id AND NOT hit)
""")
def j2_feature_upsert(spark, folder):
    stored, users, bought, now = _lookup_inputs(spark, folder)
    misses = lookup_user_features(users, stored, bought, now).where(~F.col("hit"))
    table_after = upsert_features(stored.withColumn("kept", F.lit(True)), misses.withColumn("kept", F.lit(False)))
    return table_after.select("user_id", "preferred_category", "total_transactions", "kept")


@query("a11_hit_ratio", f"""
WITH {LOOKUP_SQL}
SELECT count(*) FILTER (hit) AS hits, count(*) FILTER (NOT hit) AS misses,
       round(count(*) FILTER (hit) / count(*)::DOUBLE, 9) AS hit_ratio FROM looked
""")
def a11_hit_ratio(spark, folder):
    return hit_ratio(_user_lookups(spark, folder)).withColumn("hit_ratio", F.round("hit_ratio", 9))


@query("j3_product_features", f"""
WITH stored AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_retailprice AS price, p_size AS category_id,
         p_partkey % 120 * 60000 < 3600000 AS young
  FROM part)
SELECT e.event_id, e.product_id, coalesce(s.price, 99.99) AS price, coalesce(s.category_id, 1) AS category_id,
       CASE WHEN s.price IS NULL THEN 0.85 ELSE 0.5 END::DOUBLE AS popularity_score,
       CASE WHEN s.price IS NULL THEN 4.5 ELSE 3.0 END::DOUBLE AS rating,
       CASE WHEN s.price IS NULL THEN 0.12 ELSE 0.25 END::DOUBLE AS click_rate, s.price IS NOT NULL AS hit
FROM ev e LEFT JOIN stored s ON s.product_id = e.product_id AND young
""")
def j3_product_features(spark, folder):
    events = behaviour(spark, folder, with_catalog=False)
    now = latest_ms(events)
    stored = table(spark, folder, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"), F.col("p_retailprice").alias("price"),
        F.col("p_size").alias("category_id"), F.lit(0.5).alias("popularity_score"), F.lit(3.0).alias("rating"),
        F.lit(0.25).alias("click_rate"), (now - F.pmod("p_partkey", F.lit(120)) * 60_000).alias("computed_at_ms"),
    )
    return lookup_product_features(events.select("event_id", "product_id"), stored, now)


@query("j4_cached_predictions", f"""
WITH known AS (SELECT user_id, product_id, ts_ms AS cached_at_ms, {PAIR_SCORE_SQL} AS score FROM ev
               WHERE event_type = 'view')
SELECT e.event_id, k.cached_at_ms IS NOT NULL AND e.ts_ms - k.cached_at_ms < 604800000 AS cached,
       CASE WHEN e.ts_ms - k.cached_at_ms < 604800000 THEN k.score END AS cached_score
FROM (SELECT * FROM ev WHERE event_type <> 'view') e
ASOF LEFT JOIN known k ON e.user_id = k.user_id AND e.product_id = k.product_id AND e.ts_ms >= k.cached_at_ms
""")
def j4_cached_predictions(spark, folder):
    # A week instead of five minutes: a user seldom meets a product again within minutes in the given events.
    events = behaviour(spark, folder, with_catalog=False).select(
        "event_id", "user_id", "product_id", "ts_ms", "event_type"
    )
    known = events.where("event_type = 'view'").select(
        "user_id", "product_id", F.col("ts_ms").alias("cached_at_ms"),
        pair_score(F.col("user_id"), F.col("product_id")).alias("score"),
    )
    return cached_predictions(events.where("event_type != 'view'"), known, 7 * DAY_MS).select(
        "event_id", "cached", "cached_score"
    )


@query("r4_pair_scores", f"SELECT event_id, user_id, product_id, {PAIR_SCORE_SQL} AS score FROM ev")
def r4_pair_scores(spark, folder):
    return behaviour(spark, folder, with_catalog=False).select(
        "event_id", "user_id", "product_id", pair_score(F.col("user_id"), F.col("product_id")).alias("score")
    )


CACHE_WALK_SQL = """
ordered AS (SELECT *, row_number() OVER (PARTITION BY user_id, product_id ORDER BY ts_ms, event_id) AS n FROM ev),
walk AS (
  SELECT user_id, product_id, n, event_id, ts_ms, ts_ms AS cached_at_ms, true AS opens FROM ordered WHERE n = 1
  UNION ALL
  SELECT o.user_id, o.product_id, o.n, o.event_id, o.ts_ms,
         CASE WHEN o.ts_ms - w.cached_at_ms < 604800000 THEN w.cached_at_ms ELSE o.ts_ms END,
         o.ts_ms - w.cached_at_ms >= 604800000
  FROM walk w JOIN ordered o ON o.user_id = w.user_id AND o.product_id = w.product_id AND o.n = w.n + 1
)
"""


@query("r5_cached_scores", f"""
WITH RECURSIVE {CACHE_WALK_SQL}
SELECT event_id, user_id, product_id, cached_at_ms, NOT opens AS cached, {PAIR_SCORE_SQL} AS score,
       CASE WHEN opens THEN price ELSE 0.1 END AS latency_ms
FROM walk JOIN (SELECT event_id, price FROM ev) USING (event_id)
""")
def r5_cached_scores(spark, folder):
    requests = behaviour(spark, folder, with_catalog=False).select(
        "event_id", "user_id", "product_id", "ts_ms", "price"
    )
    scored = score_with_cache(
        requests, pair_score(F.col("user_id"), F.col("product_id")), F.col("price"), 7 * DAY_MS
    )
    return scored.select("event_id", "user_id", "product_id", "cached_at_ms", "cached", "score", "latency_ms")


@query("r5_request_pairs", f"""
WITH placed AS (SELECT *, event_id // 32 AS request_id, event_id % 32 AS position, max(event_id) OVER () AS newest FROM ev)
SELECT request_id, CAST(position AS INTEGER) AS position, user_id, product_id, {PAIR_SCORE_SQL} AS score
FROM placed WHERE position < 31 AND event_id < newest
""")
def r5_request_pairs(spark, folder):
    # Requests of 32 users in the order of the event ids, with one product less than users.
    entry = F.struct("event_id", "user_id", "product_id")
    requests = behaviour(spark, folder, with_catalog=False).groupBy(
        F.floor(F.col("event_id") / 32).alias("request_id")
    ).agg(F.array_sort(F.collect_list(entry)).alias("_e")).select(
        "request_id", F.col("_e.user_id").alias("user_ids"),
        F.slice(F.col("_e.product_id"), 1, F.size("_e") - 1).alias("product_ids"),
    )
    return request_pairs(requests).withColumn("score", pair_score(F.col("user_id"), F.col("product_id")))


@query("r6_failure_default", f"""
SELECT event_id, CASE WHEN event_type = 'error' THEN 0.5 ELSE {PAIR_SCORE_SQL} END AS score,
       CASE WHEN event_type = 'error' THEN 3000.0 ELSE price END AS latency_ms, event_type = 'error' AS failed
FROM ev
""")
def r6_failure_default(spark, folder):
    score = F.when(F.col("event_type") != "error", pair_score(F.col("user_id"), F.col("product_id")))
    scored = behaviour(spark, folder, with_catalog=False).select(
        "event_id", score.alias("score"), F.col("price").alias("latency_ms")
    )
    return with_failure_default(scored)


ENTRY_WALK_SQL = """
ordered AS (SELECT *, row_number() OVER (PARTITION BY user_id, product_id ORDER BY ts_ms, event_id) AS n FROM asked),
walk AS (
  SELECT user_id, product_id, n, event_id, price, CASE WHEN own IS NOT NULL THEN ts_ms END AS since, own AS kept,
         false AS cached FROM ordered WHERE n = 1
  UNION ALL
  SELECT o.user_id, o.product_id, o.n, o.event_id, o.price,
         CASE WHEN coalesce(o.ts_ms - w.since < 604800000, false) THEN w.since WHEN o.own IS NOT NULL THEN o.ts_ms END,
         CASE WHEN coalesce(o.ts_ms - w.since < 604800000, false) THEN w.kept ELSE o.own END,
         coalesce(o.ts_ms - w.since < 604800000, false)
  FROM walk w JOIN ordered o ON o.user_id = w.user_id AND o.product_id IS NOT DISTINCT FROM w.product_id AND o.n = w.n + 1
)
SELECT event_id, product_id, since AS cached_at_ms, cached, kept IS NULL AS failed, coalesce(kept, 0.5) AS score,
       CASE WHEN kept IS NULL THEN 3000.0 WHEN cached THEN 0.1 ELSE price END AS latency_ms
FROM walk
"""


def _entry_requests(spark, folder):
    """Requests whose score is their own price; those of errors fail, and some have no product."""
    return behaviour(spark, folder, with_catalog=False).select(
        "event_id", "user_id", F.when(F.pmod("event_id", F.lit(11)) != 0, F.col("product_id")).alias("product_id"),
        "ts_ms", "price", F.when(F.col("event_type") != "error", F.col("price")).alias("own"),
    )


@query("r5_stored_scores", f"""
WITH RECURSIVE asked AS (
  SELECT event_id, user_id, CASE WHEN event_id % 11 <> 0 THEN product_id END AS product_id, ts_ms, price,
         CASE WHEN event_type <> 'error' THEN price END AS own FROM ev),
{ENTRY_WALK_SQL}
""")
def r5_stored_scores(spark, folder):
    scored = score_with_cache(_entry_requests(spark, folder), F.col("own"), F.col("price"), 7 * DAY_MS)
    return with_failure_default(scored).select(
        "event_id", "product_id", "cached_at_ms", "cached", "failed", "score", "latency_ms")


@query("x8_request_batches", f"""
WITH placed AS (SELECT *, (row_number() OVER (ORDER BY event_id) - 1) // 32 AS batch_id FROM ev),
scored AS (SELECT *, count(*) OVER w AS batch_rows, bool_or(event_id % 700 = 0) OVER w AS failed
           FROM placed WINDOW w AS (PARTITION BY batch_id))
SELECT event_id, batch_id, batch_rows, failed, CASE WHEN failed THEN 0.5 ELSE {PAIR_SCORE_SQL} END AS score FROM scored
""")
def x8_request_batches(spark, folder):
    # Every seven hundredth request makes its batch fail.
    requests = behaviour(spark, folder, with_catalog=False).select(
        "event_id", F.when(F.pmod("event_id", F.lit(700)) != 0, pair_score(F.col("user_id"), F.col("product_id"))).alias("score"))
    return failed_batches(request_batches(requests)).select("event_id", "batch_id", "batch_rows", "failed", "score")


@query("r7_model_scores", """
WITH parts AS (SELECT vec_id, label, generate_subscripts(embedding, 1) AS i, unnest(embedding)::DOUBLE AS x
               FROM embeddings),
weights AS (SELECT i, avg(x) FILTER (label = 0) - avg(x) FILTER (label <> 0) AS w FROM parts GROUP BY i)
SELECT vec_id, round(sum(x * w), 3) AS prediction FROM parts JOIN weights USING (i) GROUP BY vec_id
""", events=False)
def r7_model_scores(spark, folder):
    vectors = table(spark, folder, "embeddings")
    # The model: the direction from the other vectors to those of label 0, one weight per dimension.
    zero = F.col("label") == 0
    sides = vectors.select(zero.alias("_zero"), F.posexplode("embedding").alias("i", "x"))
    weights = sides.groupBy("i").agg(
        (F.avg(F.when(F.col("_zero"), F.col("x").cast("double")))
         - F.avg(F.when(~F.col("_zero"), F.col("x").cast("double")))).alias("w")
    )
    scored = score_with_weights(vectors, weights, "embedding")
    return scored.select("vec_id", F.round("prediction", 3).alias("prediction"))
