"""Figures of services as streams (A8, 2.4), run to their end over the event table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.ordered import DAY_MS
from ..session import prepare_streaming
from ..sources.files import stream_events
from ..streaming.processors import keyed
from ..streaming.service import SERVICE_OUTPUT, ServiceFigures
from .inputs import INSTANCES, SAMPLES_SQL, latency_samples
from .registry import query
from .stream_queries import ONE_FILE, _finished, _in_files

# The given tables have some hundred answers a service, so the window is shorter than its default.
ANSWERS = 200


@query("a8_stream_service_stats", f"""
WITH {SAMPLES_SQL},
parts AS (SELECT *, event_id % {INSTANCES} AS service, ts_ms - ts_ms % {DAY_MS} AS period_ms FROM samples),
counted AS (
  SELECT *, sum(ok::INT) OVER w AS answered, sum((NOT ok)::INT) OVER w AS errors, sum(cache_hit::INT) OVER w AS hits,
         count(*) OVER w AS requests, min(ts_ms) OVER (PARTITION BY service) AS first_ms
  FROM parts WINDOW w AS (PARTITION BY service ORDER BY ts_ms, event_id)),
reports AS (
  SELECT service, period_ms, max(answered) AS answered, max(errors) AS errors, max(hits) AS hits, max(requests) AS requests,
         max(ts_ms) - any_value(first_ms) AS elapsed
  FROM counted GROUP BY 1, 2 QUALIFY period_ms < max(period_ms) OVER (PARTITION BY service)),
held AS (
  SELECT r.service, r.period_ms, c.latency_ms AS x FROM reports r JOIN counted c
  ON c.service = r.service AND c.ok AND c.answered <= r.answered AND c.answered > r.answered - {ANSWERS}),
moments AS (SELECT service, period_ms, avg(x) AS m, stddev_pop(x) AS s, count(*) AS n FROM held GROUP BY 1, 2),
figures AS (
  SELECT service, period_ms, round(quantile_cont(x, 0.5), 6) AS p50, round(quantile_cont(x, 0.95), 6) AS p95,
         round(quantile_cont(x, 0.99), 6) AS p99, round(avg(x), 6) AS mean
  FROM held JOIN moments USING (service, period_ms) WHERE x < m + 3 * s OR s = 0 GROUP BY 1, 2)
SELECT r.service, r.period_ms, coalesce(p50, 0) AS p50, coalesce(p95, 0) AS p95, coalesce(p99, 0) AS p99,
       coalesce(mean, 0) AS mean, coalesce(round(s, 6), 0) AS std,
       CASE WHEN elapsed > 0 THEN round(coalesce(n, 0) / (elapsed / 1000.0), 6) ELSE 0 END AS throughput,
       CASE WHEN n > 0 THEN round(least(errors, {ANSWERS}) / n, 6) ELSE 0 END AS error_rate,
       CASE WHEN n > 0 THEN round(hits / requests, 6) ELSE 0 END AS cache_hit_rate, coalesce(n, 0) AS total_predictions
FROM reports r LEFT JOIN moments USING (service, period_ms) LEFT JOIN figures USING (service, period_ms)
""")
def a8_stream_service_stats(spark, folder):
    """The figures at the end of every day of every service, over its last answers."""
    prepare_streaming(spark)
    samples = latency_samples(spark, folder).withColumn("service", F.pmod("event_id", F.lit(INSTANCES)))
    path = _in_files(spark, samples, "ts_ms", "service-samples")
    stream = stream_events(spark, path, samples.schema, ONE_FILE)
    sent = _finished(spark, keyed(stream, "service", ServiceFigures(DAY_MS, ANSWERS), SERVICE_OUTPUT), "service-figures")
    return sent.select("service", "period_ms", *[F.round(c, 6).alias(c) for c in sent.columns[2:10]], "total_predictions")
