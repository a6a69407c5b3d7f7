"""Queries on drift, latency figures and alerts (2.5, 2.9 and the latency rows of 2.4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.alerts import (
    Rule, absences, available_percent, busy_percent, consumer_lag, evaluate_rules, holding_runs, increases, lag_alerts, lag_over,
    mean_deviation, notifications, roll_up, rules_frame, side_by_side, top_series, used_percent,
)
from ..operators.drift import (
    batch_overview, categorical_baseline, category_divergence, dataset_drift, drift_history, drift_parts,
    drift_report, drift_totals, hour_profile, mean_shift, numeric_baseline, quantile_distance,
)
from ..operators.latency_stats import (
    CONSUMPTION_BUCKETS, PROCESSING_BUCKETS, batch_efficiency, histogram, load_stats, service_stats, sla_stats,
)
from ..operators.activity import price_stats, top_by_count
from ..operators.notify import active_groups, schedule
from ..operators.ordered import HOUR_MS, block_start
from ..session import shared_folder, stored
from ..sources.sinks import read_categorical_baseline, read_numeric_baseline, write_baseline
from ..sources.tables import behaviour, table
from .inputs import (
    CELLS_SQL, COUNTER_SQL, SAMPLES_SQL, counter_samples, hourly_cells, latency_samples, latest_ms, numbered_batches,
    price_samples,
)
from .registry import query

KEYS = ["batch_id"]

# The baseline is the first half of the month; batches of the whole month are held against it.
SPLIT = "TIMESTAMP '2024-01-16 00:00:00'"

BASE_SQL = f"""
base AS (SELECT * FROM ev WHERE ts < {SPLIT}),
ref AS (SELECT avg(price) AS mean, greatest(stddev_samp(price), 0.001) AS std, max(price) - min(price) AS width,
               [quantile_cont(price, 0.05), quantile_cont(price, 0.25), quantile_cont(price, 0.5),
                quantile_cont(price, 0.75), quantile_cont(price, 0.95)] AS points FROM base),
ref_shares AS (
  SELECT 'event_type' AS col, event_type AS val, count(*) / sum(count(*)) OVER () AS p FROM base GROUP BY 2
  UNION ALL
  (SELECT 'category_code', coalesce(category_code, 'unknown'), count(*) / sum(count(*)) OVER () FROM base GROUP BY 2
   ORDER BY count(*) DESC, 2 LIMIT 20)
  UNION ALL
  (SELECT 'brand', coalesce(brand, 'unknown'), count(*) / sum(count(*)) OVER () FROM base GROUP BY 2
   ORDER BY count(*) DESC, 2 LIMIT 20)),
batches AS (SELECT *, event_id // 1000 AS batch_id FROM ev),
sizes AS (SELECT batch_id, count(*) AS batch_size, count(price) AS n, avg(price) AS mean,
                 [quantile_cont(price, 0.05), quantile_cont(price, 0.25), quantile_cont(price, 0.5),
                  quantile_cont(price, 0.75), quantile_cont(price, 0.95)] AS points FROM batches GROUP BY 1),
d1 AS (SELECT batch_id, 'price_mean' AS part,
              least(abs(s.mean - r.mean) / (r.std / sqrt(n)) / 5, 1.0) AS score FROM sizes s, ref r WHERE n >= 10),
d2 AS (SELECT batch_id, 'price_quantiles' AS part,
              least(list_max([abs(s.points[i] - r.points[i]) for i in range(1, 6)]) / width, 1.0) AS score
       FROM sizes s, ref r WHERE n >= 10),
stacked AS (SELECT batch_id, 'event_type' AS col, coalesce(event_type, 'unknown') AS val FROM batches
            UNION ALL SELECT batch_id, 'category_code', coalesce(category_code, 'unknown') FROM batches
            UNION ALL SELECT batch_id, 'brand', coalesce(brand, 'unknown') FROM batches),
shares AS (SELECT batch_id, col, val, count(*) / sum(count(*)) OVER (PARTITION BY batch_id, col) AS q
           FROM stacked GROUP BY 1, 2, 3),
both_sides AS (
  SELECT coalesce(s.batch_id, e.batch_id) AS batch_id, coalesce(s.col, e.col) AS col,
         coalesce(e.p, 1e-10) AS p, coalesce(s.q, 1e-10) AS q
  FROM shares s FULL JOIN (SELECT * FROM (SELECT batch_id FROM sizes WHERE batch_size >= 10), ref_shares) e
    ON s.batch_id = e.batch_id AND s.col = e.col AND s.val = e.val),
scaled AS (SELECT batch_id, col, p / sum(p) OVER w AS p, q / sum(q) OVER w AS q FROM both_sides
           WINDOW w AS (PARTITION BY batch_id, col)),
d3 AS (SELECT batch_id, col AS part,
              least(greatest(0.5 * sum(p * ln((p + 1e-10) / ((p + q) / 2 + 1e-10))
                                       + q * ln((q + 1e-10) / ((p + q) / 2 + 1e-10))), 0.0), 1.0) AS score
       FROM scaled GROUP BY 1, 2),
d4 AS (SELECT batch_id, 'hour' AS part, least(avg(abs(share - 1.0 / 24)) * 10, 1.0) AS score
       FROM (SELECT batch_id, hour(ts), count(*) / sum(count(*)) OVER (PARTITION BY batch_id) AS share
             FROM batches GROUP BY 1, 2) GROUP BY 1),
parts AS (SELECT * FROM d1 UNION ALL SELECT * FROM d2 UNION ALL SELECT * FROM d3 UNION ALL SELECT * FROM d4),
totals AS (SELECT s.batch_id, s.batch_size, CASE WHEN batch_size >= 50 THEN coalesce(avg(score), 0.0) END AS drift_score
           FROM sizes s LEFT JOIN parts p ON p.batch_id = s.batch_id GROUP BY 1, 2)
"""


def _batches(spark, folder):
    return numbered_batches(behaviour(spark, folder))


def _baseline(spark, folder, numeric=True, categorical=True, events=None):
    """The baseline job: its small tables are stored in the shared folder and read back, None if not asked for.

    The categories are those of ``events`` with catalog columns where there are some; prices count once for each event.
    """
    first_half = F.col("event_time") < F.expr(SPLIT)
    path = shared_folder(spark, "baseline")
    write_baseline(
        numeric_baseline(behaviour(spark, folder, with_catalog=False).where(first_half)) if numeric else None,
        categorical_baseline((behaviour(spark, folder) if events is None else events).where(first_half)) if categorical else None,
        path,
    )
    return (
        read_numeric_baseline(spark, path) if numeric else None,
        read_categorical_baseline(spark, path) if categorical else None,
    )


def _round_score(df):
    return df.withColumn("score", F.round("score", 8))


@query("d1_mean_shift", f"WITH {BASE_SQL} SELECT batch_id, part, round(score, 8) AS score FROM d1")
def d1_mean_shift(spark, folder):
    batches = numbered_batches(behaviour(spark, folder, with_catalog=False))
    numeric, _ = _baseline(spark, folder, categorical=False)
    return _round_score(mean_shift(batch_overview(batches, KEYS), numeric, KEYS))


@query("d2_quantile_distance", f"WITH {BASE_SQL} SELECT batch_id, part, round(score, 8) AS score FROM d2")
def d2_quantile_distance(spark, folder):
    batches = numbered_batches(behaviour(spark, folder, with_catalog=False))
    numeric, _ = _baseline(spark, folder, categorical=False)
    return _round_score(quantile_distance(batches, numeric, KEYS))


@query("d3_category_divergence", f"WITH {BASE_SQL} SELECT batch_id, part, round(score, 8) AS score FROM d3")
def d3_category_divergence(spark, folder):
    _, categorical = _baseline(spark, folder, numeric=False)
    return _round_score(category_divergence(_batches(spark, folder), categorical, KEYS))


@query("d4_hour_profile", f"WITH {BASE_SQL} SELECT batch_id, part, round(score, 8) AS score FROM d4")
def d4_hour_profile(spark, folder):
    batches = numbered_batches(behaviour(spark, folder, with_catalog=False))
    return _round_score(hour_profile(batch_overview(batches, KEYS), KEYS))


def _totals(spark, folder):
    numeric, categorical = _baseline(spark, folder)
    return drift_totals(drift_parts(_batches(spark, folder), numeric, categorical, KEYS), KEYS)


@query("d5_drift_score", f"""
WITH {BASE_SQL} SELECT batch_id, batch_size, round(drift_score, 8) AS drift_score FROM totals
""")
def d5_drift_score(spark, folder):
    return _totals(spark, folder).select("batch_id", "batch_size", F.round("drift_score", 8).alias("drift_score"))


@query("d6_drift_level", f"""
WITH {BASE_SQL}
SELECT batch_id, CASE WHEN drift_score > 0.2 THEN 'high' WHEN drift_score > 0.1 THEN 'moderate'
                      WHEN drift_score IS NOT NULL THEN 'none' END AS level FROM totals
""")
def d6_drift_level(spark, folder):
    return _totals(spark, folder).select("batch_id", "level")


REPORT_SQL = f"""
sides AS (SELECT *, ts >= {SPLIT} AS now FROM ev),
long_values AS (SELECT now, 'event_type' AS col, coalesce(event_type, 'unknown') AS val FROM sides
                UNION ALL SELECT now, 'category_code', coalesce(category_code, 'unknown') FROM sides
                UNION ALL SELECT now, 'brand', coalesce(brand, 'unknown') FROM sides),
counted AS (SELECT col, val, count(*) FILTER (NOT now) / sum(count(*) FILTER (NOT now)) OVER (PARTITION BY col) AS p,
                   count(*) FILTER (now) / sum(count(*) FILTER (now)) OVER (PARTITION BY col) AS q
            FROM long_values GROUP BY 1, 2),
guarded AS (SELECT col, coalesce(nullif(p, 0), 1e-10) AS p, coalesce(nullif(q, 0), 1e-10) AS q FROM counted),
scaled AS (SELECT col, p / sum(p) OVER (PARTITION BY col) AS p, q / sum(q) OVER (PARTITION BY col) AS q FROM guarded),
js AS (SELECT col AS "column", 'jensen_shannon' AS method,
              least(greatest(0.5 * sum(p * ln((p + 1e-10) / ((p + q) / 2 + 1e-10))
                                       + q * ln((q + 1e-10) / ((p + q) / 2 + 1e-10))), 0.0), 1.0) AS statistic
       FROM scaled GROUP BY 1),
steps AS (SELECT price, count(*) FILTER (NOT now) / (SELECT count(*) FROM sides WHERE NOT now)
                        - count(*) FILTER (now) / (SELECT count(*) FROM sides WHERE now) AS step
          FROM sides WHERE price IS NOT NULL GROUP BY 1),
ks AS (SELECT 'price' AS "column", 'ks' AS method, max(abs(gap)) AS statistic
       FROM (SELECT sum(step) OVER (ORDER BY price) AS gap FROM steps)),
report AS (SELECT *, statistic > 0.1 AS drifted FROM (SELECT * FROM js UNION ALL SELECT * FROM ks))
"""


def _report(spark, folder):
    events = behaviour(spark, folder)
    old = F.col("event_time") < F.expr(SPLIT)
    return drift_report(events.where(old), events.where(~old))


@query("d7_drift_report", f"""
WITH {REPORT_SQL} SELECT "column", method, round(statistic, 8) AS statistic, drifted FROM report
""")
def d7_drift_report(spark, folder):
    return _report(spark, folder).withColumn("statistic", F.round("statistic", 8))


@query("d7_gated_report", f"""
WITH {BASE_SQL}, {REPORT_SQL.replace("scaled", "evened")}
SELECT "column", method, round(statistic, 8) AS statistic, drifted FROM report
WHERE (SELECT bool_or(drift_score > 0.1 AND batch_size >= 100) FROM totals)
""")
def d7_gated_report(spark, folder):
    # The report is made only if one of the month's batches drifted and is large enough.
    events = behaviour(spark, folder)
    old = F.col("event_time") < F.expr(SPLIT)
    report = drift_report(events.where(old), events.where(~old), gate=_totals(spark, folder))
    return report.withColumn("statistic", F.round("statistic", 8))


@query("d7_dataset_drift", f"""
WITH {REPORT_SQL}
SELECT count(*) AS columns, count(*) FILTER (drifted) AS drifted_columns,
       count(*) FILTER (drifted) / count(*)::DOUBLE AS drifted_share,
       count(*) FILTER (drifted) / count(*) >= 0.5 AS dataset_drift FROM report
""")
def d7_dataset_drift(spark, folder):
    return dataset_drift(_report(spark, folder))


@query("d8_drift_history", f"""
WITH {BASE_SQL}
SELECT * FROM (SELECT batch_id, batch_size, round(drift_score, 8) AS drift_score,
       CAST(sum(batch_size) OVER (ORDER BY batch_id) AS BIGINT) AS processed_total FROM totals)
ORDER BY batch_id DESC LIMIT 1000
""")
def d8_drift_history(spark, folder):
    # The history is a table that batches append to, so it is written before it is summed up.
    return drift_history(stored(_totals(spark, folder), "history"), "batch_id").select(
        "batch_id", "batch_size", F.round("drift_score", 8).alias("drift_score"), "processed_total"
    )


def _rounded(df, names, digits=6):
    return df.select(*[F.round(c, digits).alias(c) if c in names else F.col(c) for c in df.columns])


SERVICE = ["p50", "p95", "p99", "mean", "std", "throughput", "error_rate", "cache_hit_rate"]


@query("a8_service_stats", f"""
WITH {SAMPLES_SQL},
latest AS (SELECT latency_ms AS x FROM samples WHERE ok ORDER BY event_id DESC LIMIT 10000),
moments AS (SELECT avg(x) AS m, stddev_pop(x) AS s, count(*) AS n FROM latest),
kept AS (SELECT x FROM latest, moments WHERE x < m + 3 * s)
SELECT round(quantile_cont(x, 0.5), 6) AS p50, round(quantile_cont(x, 0.95), 6) AS p95,
       round(quantile_cont(x, 0.99), 6) AS p99, round(avg(x), 6) AS mean, round(any_value(s), 6) AS std,
       round(any_value(n) / (SELECT (max(ts_ms) - min(ts_ms)) / 1000.0 FROM samples), 6) AS throughput,
       round(least((SELECT count(*) FROM samples WHERE NOT ok), 10000) / any_value(n), 6) AS error_rate,
       round((SELECT count(*) FILTER (cache_hit) / count(*) FROM samples), 6) AS cache_hit_rate,
       any_value(n) AS total_predictions
FROM kept, moments
""")
def a8_service_stats(spark, folder):
    samples = latency_samples(spark, folder)
    elapsed = samples.agg(((F.max("ts_ms") - F.min("ts_ms")) / 1000.0).alias("s")).scalar()
    return _rounded(service_stats(samples, [F.desc("event_id")], elapsed), SERVICE)


LOAD = ["p50_ms", "p95_ms", "p99_ms", "p999_ms", "mean_ms", "min_ms", "max_ms", "std_ms", "throughput_rps", "error_rate"]


def _load_sql(group: str) -> str:
    by, on = (f"{group}, ", f"USING ({group})") if group else ("", "ON true")
    per = f"GROUP BY {group}" if group else ""
    one = f"ANY_VALUE({group}) AS {group}, " if group else ""
    return f"""
moments AS (SELECT {by}avg(latency_ms) AS m, stddev_pop(latency_ms) AS s FROM samples WHERE ok {per}),
kept AS (SELECT {by}latency_ms AS x FROM samples JOIN moments {on} WHERE ok AND latency_ms < m + 3 * s),
sums AS (SELECT {by}count(*) AS total_requests, count(*) FILTER (ok) AS successful_requests,
                sum(latency_ms) FILTER (ok) AS spent FROM samples {per}),
figures AS (SELECT {by}round(quantile_cont(x, 0.5), 6) AS p50_ms, round(quantile_cont(x, 0.95), 6) AS p95_ms,
                   round(quantile_cont(x, 0.99), 6) AS p99_ms, round(quantile_cont(x, 0.999), 6) AS p999_ms,
                   round(avg(x), 6) AS mean_ms, avg(x) AS raw_mean, min(x) AS min_ms, max(x) AS max_ms,
                   round(stddev_pop(x), 6) AS std_ms FROM kept {per}),
load AS (SELECT figures.*, total_requests, successful_requests,
                round(successful_requests / (spent / 1000), 6) AS throughput_rps,
                round((total_requests - successful_requests) / total_requests::DOUBLE, 6) AS error_rate
         FROM figures JOIN sums {on})
"""


@query("a9_load_stats", f"WITH {SAMPLES_SQL}, {_load_sql('')} SELECT * EXCLUDE (raw_mean) FROM load")
def a9_load_stats(spark, folder):
    return _rounded(load_stats(latency_samples(spark, folder)), LOAD)


@query("a9_load_stats_by_batch_size", f"""
WITH {SAMPLES_SQL}, {_load_sql('batch_size')} SELECT * EXCLUDE (raw_mean) FROM load
""")
def a9_load_stats_by_batch_size(spark, folder):
    return _rounded(load_stats(latency_samples(spark, folder), ["batch_size"]), LOAD)


@query("a12_batch_efficiency", f"""
WITH {SAMPLES_SQL}, {_load_sql('batch_size')}
SELECT batch_size, mean_ms,
       round((SELECT raw_mean FROM load WHERE batch_size = 1) * batch_size / raw_mean, 6) AS efficiency
FROM load WHERE batch_size > 1
""")
def a12_batch_efficiency(spark, folder):
    by_size = load_stats(latency_samples(spark, folder), ["batch_size"])
    return _rounded(batch_efficiency(by_size), ["mean_ms", "efficiency"])


@query("a10_sla_stats", f"""
WITH {SAMPLES_SQL},
sorted AS (SELECT latency_ms AS x, row_number() OVER (ORDER BY latency_ms) - 1 AS i, count(*) OVER () AS n FROM samples)
SELECT count(*) AS count, round(avg(x), 6) AS mean, round(median(x), 6) AS median, min(x) AS min, max(x) AS max,
       max(x) FILTER (i = floor(n * 0.5)) AS p50, max(x) FILTER (i = floor(n * 0.75)) AS p75,
       max(x) FILTER (i = floor(n * 0.9)) AS p90, max(x) FILTER (i = floor(n * 0.95)) AS p95,
       max(x) FILTER (i = floor(n * 0.99)) AS p99, round(stddev_samp(x), 6) AS std_dev,
       max(x) FILTER (i = floor(n * 0.95)) < 75 AS sla_passed
FROM sorted
""")
def a10_sla_stats(spark, folder):
    return _rounded(sla_stats(latency_samples(spark, folder)), ["mean", "median", "std_dev"])


@query("a13_latency_histogram", f"""
WITH {SAMPLES_SQL}
SELECT batch_size, le, count(*) FILTER (latency_ms / 10 <= le) AS events, round(sum(latency_ms / 10), 4) AS sum
FROM samples, (SELECT unnest([0.1, 0.5, 1, 2, 5, 10, CAST('inf' AS DOUBLE)]) AS le) GROUP BY 1, 2
""")
def a13_latency_histogram(spark, folder):
    counted = histogram(
        latency_samples(spark, folder), F.col("latency_ms") / 10.0, PROCESSING_BUCKETS, ["batch_size"]
    )
    return counted.withColumn("sum", F.round("sum", 4))


@query("a13_consumption_histogram", f"""
WITH {SAMPLES_SQL}
SELECT le, count(*) FILTER (latency_ms / 2 <= le) AS events, round(sum(latency_ms / 2), 4) AS sum
FROM samples, (SELECT unnest([0.1, 0.5, 1, 2, 5, 10, 30, 60, CAST('inf' AS DOUBLE)]) AS le) GROUP BY 1
""")
def a13_consumption_histogram(spark, folder):
    counted = histogram(latency_samples(spark, folder), F.col("latency_ms") / 2.0, CONSUMPTION_BUCKETS)
    return counted.withColumn("sum", F.round("sum", 4))


def _runs_sql(source: str, condition: str, hold: str, keys: str = "instance") -> str:
    return f"""
named AS (SELECT *, coalesce(({condition}), false) AS met,
                 max(CASE WHEN NOT coalesce(({condition}), false) THEN ts_ms END)
                   OVER (PARTITION BY {keys} ORDER BY ts_ms) AS after_ms FROM {source}),
runs AS (SELECT {keys}, min(ts_ms) AS active_since_ms, max(ts_ms) AS active_until_ms, count(*) AS samples,
                max(ts_ms) - min(ts_ms) >= max({hold}) AS firing,
                CASE WHEN max(ts_ms) - min(ts_ms) >= max({hold}) THEN min(ts_ms) + max({hold}) END AS fires_at_ms
         FROM named WHERE met GROUP BY {keys}, after_ms)
"""


@query("e1_threshold_runs", f"""
WITH {CELLS_SQL}, {_runs_sql('cells', 'price_mean > 50', '7200000')} SELECT * FROM runs
""")
def e1_threshold_runs(spark, folder):
    return holding_runs(
        price_samples(hourly_cells(spark, folder)), ["instance"], F.col("value") > 50, 2 * HOUR_MS
    )


# The standard rules name metrics the tables lack; these have the same form over hourly figures of the events.
HOURLY_RULES = (
    Rule("HighPrice", "price_mean", ">", 60.0, 2 * HOUR_MS, "critical", "shop"),
    Rule("HighPrice", "price_mean", ">", 45.0, 2 * HOUR_MS, "warning", "shop"),
    Rule("FewEvents", "events", "<", 3.0, HOUR_MS, "warning"),
    Rule("NoErrors", "errors", "==", 0.0, 3 * HOUR_MS, "info", "shop"),
)

RULES_SQL = """
rules(alertname, metric, op, threshold, hold_ms, severity, service) AS (VALUES
  ('HighPrice', 'price_mean', '>', 60.0, 7200000, 'critical', 'shop'),
  ('HighPrice', 'price_mean', '>', 45.0, 7200000, 'warning', 'shop'),
  ('FewEvents', 'events', '<', 3.0, 3600000, 'warning', ''),
  ('NoErrors', 'errors', '==', 0.0, 10800000, 'info', 'shop')),
metrics AS (SELECT instance, ts_ms, 'price_mean' AS metric, price_mean AS value FROM cells
            UNION ALL SELECT instance, ts_ms, 'events', events FROM cells
            UNION ALL SELECT instance, ts_ms, 'errors', errors FROM cells),
ruled AS (SELECT *, CASE op WHEN '>' THEN value > threshold WHEN '<' THEN value < threshold
                            ELSE value = threshold END AS is_met FROM metrics JOIN rules USING (metric))
"""
RULE_KEYS = "alertname, severity, service, instance"


def _metrics(cells):
    named = ["price_mean", "events", "errors"]
    return cells.select("instance", "ts_ms", F.inline(F.array(*[
        F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in named
    ])))


def _alerts(spark, folder):
    return evaluate_rules(_metrics(hourly_cells(spark, folder)), rules_frame(spark, HOURLY_RULES), ["instance"])


@query("e1_rules", f"""
WITH {CELLS_SQL}, {RULES_SQL}, {_runs_sql('ruled', 'is_met', 'hold_ms', RULE_KEYS)} SELECT * FROM runs
""")
def e1_rules(spark, folder):
    return _alerts(spark, folder)


@query("e2_counter_rates", f"""
WITH {CELLS_SQL}, {COUNTER_SQL},
steps AS (SELECT *, lag(value) OVER (PARTITION BY instance ORDER BY ts_ms) AS before FROM counter),
sized AS (SELECT *, CASE WHEN before IS NULL THEN 0 WHEN value >= before THEN value - before ELSE value END AS step
          FROM steps)
SELECT instance, ts_ms, value,
       sum(step) OVER (PARTITION BY instance ORDER BY ts_ms RANGE BETWEEN 17999999 PRECEDING AND CURRENT ROW)
         AS increase,
       round(sum(step) OVER (PARTITION BY instance ORDER BY ts_ms RANGE BETWEEN 17999999 PRECEDING AND CURRENT ROW)
             / 18000, 9) AS rate
FROM sized
""")
def e2_counter_rates(spark, folder):
    rates = increases(counter_samples(hourly_cells(spark, folder)), ["instance"], 5 * HOUR_MS)
    return rates.withColumn("rate", F.round("rate", 9))


@query("e3_absences", f"""
WITH {CELLS_SQL},
gaps AS (SELECT instance, lag(ts_ms) OVER (PARTITION BY instance ORDER BY ts_ms) AS absent_since_ms,
                ts_ms AS absent_until_ms FROM cells
         UNION ALL SELECT instance, max(ts_ms), (SELECT max(ts_ms) FROM ev) + 7200000 FROM cells GROUP BY 1)
SELECT instance, absent_since_ms, absent_until_ms, absent_since_ms + 3600000 AS fires_at_ms
FROM gaps WHERE absent_until_ms - absent_since_ms > 3600000
""")
def e3_absences(spark, folder):
    end = latest_ms(behaviour(spark, folder, with_catalog=False)) + 2 * HOUR_MS
    return absences(hourly_cells(spark, folder), ["instance"], end, HOUR_MS).select(
        "instance", "absent_since_ms", "absent_until_ms", "fires_at_ms"
    )


@query("e4_mean_deviation", f"""
WITH {CELLS_SQL},
moved AS (SELECT instance, ts_ms, avg(price_mean) OVER (PARTITION BY instance ORDER BY ts_ms
                 RANGE BETWEEN 17999999 PRECEDING AND CURRENT ROW) AS mean FROM cells)
SELECT instance, ts_ms, round(mean, 8) AS mean, round(abs(mean - 50) / 50, 8) AS deviation,
       abs(mean - 50) / 50 > 0.5 AS off FROM moved
""")
def e4_mean_deviation(spark, folder):
    moved = mean_deviation(price_samples(hourly_cells(spark, folder)), ["instance"], 5 * HOUR_MS, 50.0)
    return moved.select(
        "instance", "ts_ms", F.round("mean", 8).alias("mean"), F.round("deviation", 8).alias("deviation"),
        (F.col("deviation") > 0.5).alias("off"),
    )


@query("e5_ratio_rules", f"""
WITH {CELLS_SQL},
shares AS (SELECT instance, ts_ms, (events - views) / events::DOUBLE * 100 AS used, views / events::DOUBLE * 100 AS free
           FROM cells),
{_runs_sql('shares', 'used > 85', '7200000')}
SELECT instance, active_since_ms, active_until_ms, samples, firing FROM runs
""")
def e5_ratio_rules(spark, folder):
    metrics = hourly_cells(spark, folder).select("instance", "ts_ms", F.inline(F.array(*[
        F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in ("events", "views")
    ])))
    wide = side_by_side(metrics, ["instance"], ["events", "views"])
    return holding_runs(wide, ["instance"], used_percent("events", "views") > 85, 2 * HOUR_MS).drop("fires_at_ms")


@query("e5_percentages", f"""
WITH {CELLS_SQL}, {COUNTER_SQL},
steps AS (SELECT *, lag(value) OVER (PARTITION BY instance ORDER BY ts_ms) AS before FROM counter),
rates AS (SELECT instance, ts_ms,
                 sum(CASE WHEN before IS NULL THEN 0 WHEN value >= before THEN value - before ELSE value END)
                   OVER (PARTITION BY instance ORDER BY ts_ms RANGE BETWEEN 17999999 PRECEDING AND CURRENT ROW)
                 / 18000 AS rate FROM steps)
SELECT c.instance, c.ts_ms, round(views / events::DOUBLE * 100, 6) AS available,
       round(100 - rate * 100, 6) AS busy
FROM cells c JOIN rates r ON r.instance = c.instance AND r.ts_ms = c.ts_ms
""")
def e5_percentages(spark, folder):
    cells = hourly_cells(spark, folder)
    rates = increases(counter_samples(cells), ["instance"], 5 * HOUR_MS)
    busy = busy_percent(rates, ["instance"]).withColumnRenamed("value", "busy")
    return cells.join(busy, ["instance", "ts_ms"]).select(
        "instance", "ts_ms", F.round(available_percent("views", "events"), 6).alias("available"),
        F.round("busy", 6).alias("busy"),
    )


@query("e6_notifications", f"""
WITH {CELLS_SQL}, {RULES_SQL}, {_runs_sql('ruled', 'is_met', 'hold_ms', RULE_KEYS)},
fired AS (SELECT * FROM runs WHERE firing)
SELECT CASE severity WHEN 'critical' THEN 'critical-alerts' WHEN 'warning' THEN 'warning-alerts'
                     ELSE 'slack-notifications' END AS receiver,
       alertname, instance AS cluster, service, count(*) AS alerts, min(active_since_ms) AS first_since_ms
FROM fired f
WHERE severity <> 'warning' OR NOT EXISTS (
  SELECT 1 FROM fired c WHERE c.severity = 'critical' AND c.alertname = f.alertname AND c.instance = f.instance
                          AND c.service = f.service)
GROUP BY 1, 2, 3, 4
""")
def e6_notifications(spark, folder):
    fired = _alerts(spark, folder).where("firing").withColumnRenamed("instance", "cluster")
    return notifications(fired)


@query("e7_sum_by_type", "SELECT event_type, CAST(count(*) AS DOUBLE) AS value FROM ev GROUP BY 1")
def e7_sum_by_type(spark, folder):
    counts = behaviour(spark, folder, with_catalog=False).groupBy("event_type", "user_id").agg(
        F.count("*").cast("double").alias("value")
    )
    return roll_up(counts, ["event_type"])


@query("e7_top_categories", """
SELECT category_code, CAST(count(*) AS DOUBLE) AS value FROM ev GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10
""")
def e7_top_categories(spark, folder):
    counts = behaviour(spark, folder).groupBy("category_code", "event_type").agg(
        F.count("*").cast("double").alias("value")
    )
    return top_series(roll_up(counts, ["category_code"]), "category_code")


@query("e7_mean_price", f"WITH {CELLS_SQL} SELECT instance, round(avg(price_mean), 6) AS value FROM cells GROUP BY 1")
def e7_mean_price(spark, folder):
    rolled = roll_up(price_samples(hourly_cells(spark, folder)), ["instance"], "avg")
    return rolled.withColumn("value", F.round("value", 6))


OFFSETS_SQL = """
ends AS (SELECT event_type AS topic, CAST(user_id AS BIGINT) % 4 AS partition, count(*) AS end_offset
         FROM ev GROUP BY 1, 2),
taken AS (SELECT g.consumer_group, event_type AS topic, CAST(user_id AS BIGINT) % 4 AS partition,
                 count(*) FILTER (event_id % g.step <> 0) AS committed_offset
          FROM ev, (VALUES ('streaming', 2), ('analytics', 5), ('monitoring', 50)) g(consumer_group, step)
          GROUP BY 1, 2, 3),
lags AS (SELECT consumer_group, topic, partition, end_offset - committed_offset AS lag
         FROM taken JOIN ends USING (topic, partition))
"""


def _lags(spark, folder):
    """Topics are event types; each consumer group has left out a fixed share of the events."""
    events = behaviour(spark, folder, with_catalog=False).select(
        F.col("event_type").alias("topic"), F.pmod(F.col("user_id").cast("long"), F.lit(4)).alias("partition"),
        "event_id",
    )
    left_out = {"streaming": 2, "analytics": 5, "monitoring": 50}
    counted = events.groupBy("topic", "partition").agg(
        F.count("*").alias("end_offset"),
        F.array(*[
            F.struct(F.lit(group).alias("consumer_group"),
                     F.count_if(F.pmod("event_id", F.lit(step)) != 0).alias("committed_offset"))
            for group, step in left_out.items()
        ]).alias("_groups"),
    )
    committed = counted.select("topic", "partition", F.inline("_groups"))
    return consumer_lag(counted.select("topic", "partition", "end_offset"), committed)


@query("j6_consumer_lag", f"WITH {OFFSETS_SQL} SELECT * FROM lags")
def j6_consumer_lag(spark, folder):
    return _lags(spark, folder)


@query("e1_lag_over", f"""
WITH {OFFSETS_SQL}
SELECT consumer_group, topic, CAST(sum(lag) AS BIGINT) AS lag, count(*) AS partitions
FROM lags WHERE lag > 100 GROUP BY 1, 2
""")
def e1_lag_over(spark, folder):
    return lag_over(_lags(spark, folder), 100)


HELD_SQL = """
hourly AS (
  SELECT g.consumer_group, event_type AS topic, CAST(user_id AS BIGINT) % 4 AS partition, ts_ms - ts_ms % 3600000 AS ts_ms,
         count(*) FILTER (event_id % g.step = 0) AS lag
  FROM ev, (VALUES ('streaming', 2), ('analytics', 5), ('monitoring', 50)) g(consumer_group, step) GROUP BY 1, 2, 3, 4),
sampled AS (SELECT consumer_group, topic, ts_ms, bool_or(lag > 0) AS met FROM hourly GROUP BY 1, 2, 3),
named AS (SELECT *, coalesce(max(CASE WHEN NOT met THEN ts_ms END) OVER (PARTITION BY consumer_group, topic ORDER BY ts_ms), -1)
          AS after FROM sampled),
runs AS (SELECT consumer_group, topic, min(ts_ms) AS active_since_ms, max(ts_ms) AS active_until_ms, count(*) AS samples
         FROM named WHERE met GROUP BY consumer_group, topic, after)
"""


@query("e1_lag_alerts", f"""
WITH {HELD_SQL}
SELECT *, active_until_ms - active_since_ms >= 7200000 AS firing,
       CASE WHEN active_until_ms - active_since_ms >= 7200000 THEN active_since_ms + 7200000 END AS fires_at_ms FROM runs
""")
def e1_lag_alerts(spark, folder):
    # The lag of an hour is what a group left out in it; any lag must hold for two hours.
    events = behaviour(spark, folder, with_catalog=False)
    steps = {"streaming": 2, "analytics": 5, "monitoring": 50}
    counted = events.groupBy(
        F.col("event_type").alias("topic"), F.pmod(F.col("user_id").cast("long"), F.lit(4)).alias("partition"),
        block_start(F.col("ts_ms"), HOUR_MS).alias("ts_ms"),
    ).agg(F.array(*[
        F.struct(F.lit(g).alias("consumer_group"), F.count_if(F.pmod("event_id", F.lit(n)) == 0).alias("lag"))
        for g, n in steps.items()]).alias("_lags"))
    return lag_alerts(counted.select("topic", "partition", "ts_ms", F.inline("_lags")), 0, 2 * HOUR_MS)


@query("e3_never_seen", f"""
WITH {CELLS_SQL},
expected AS (SELECT DISTINCT 'node-' || CAST(c_custkey % 7 AS VARCHAR) AS instance FROM customer),
bounds AS (SELECT min(ts_ms) AS low, max(ts_ms) + 7200000 AS high FROM ev)
SELECT instance, low AS absent_since_ms, high AS absent_until_ms, low + 3600000 AS fires_at_ms
FROM expected, bounds WHERE instance NOT IN (SELECT instance FROM cells)
""")
def e3_never_seen(spark, folder):
    events = behaviour(spark, folder, with_catalog=False)
    bounds = events.agg(F.struct(F.min("ts_ms").alias("low"), F.max("ts_ms").alias("high")).alias("b")).scalar()
    expected = table(spark, folder, "customer").select(
        F.concat(F.lit("node-"), F.pmod("c_custkey", F.lit(7))).alias("instance")).distinct().withColumn(
        "since_ms", bounds["low"])
    found = absences(hourly_cells(spark, folder), ["instance"], bounds["high"] + 2 * HOUR_MS, HOUR_MS, expected=expected)
    return found.join(hourly_cells(spark, folder).select("instance").distinct(), "instance", "left_anti").select(
        "instance", "absent_since_ms", "absent_until_ms", "fires_at_ms")


@query("e4_infinite_sample", f"""
WITH {CELLS_SQL},
odd AS (SELECT instance, ts_ms, CASE WHEN ts_ms // 3600000 % 53 = 0 THEN CAST('inf' AS DOUBLE) ELSE price_mean END AS value
        FROM cells),
moved AS (SELECT instance, ts_ms, count(*) FILTER (isinf(value)) OVER w AS endless,
                 avg(CASE WHEN NOT isinf(value) THEN value END) OVER w AS mean
          FROM odd WINDOW w AS (PARTITION BY instance ORDER BY ts_ms RANGE BETWEEN 17999999 PRECEDING AND CURRENT ROW))
SELECT instance, ts_ms, endless > 0 AS endless, CASE WHEN endless = 0 THEN round(mean, 8) END AS mean FROM moved
""")
def e4_infinite_sample(spark, folder):
    cells = hourly_cells(spark, folder)
    odd = F.pmod(F.floor(F.col("ts_ms") / HOUR_MS), F.lit(53)) == 0
    samples = cells.select(
        "instance", "ts_ms", F.when(odd, float("inf")).otherwise(F.col("price_mean")).alias("value"))
    moved = mean_deviation(samples, ["instance"], 5 * HOUR_MS, 50.0)
    endless = F.col("mean") == float("inf")
    return moved.select(
        "instance", "ts_ms", endless.alias("endless"), F.when(~endless, F.round("mean", 8)).alias("mean"))


NAN_SQL = "ev0 AS (SELECT *, CASE WHEN event_id % 7 = 0 THEN CAST('nan' AS DOUBLE) ELSE price END AS cost FROM ev)"


def _some_nan(df):
    """Every seventh price is no number."""
    return df.withColumn("price", F.when(F.pmod("event_id", F.lit(7)) == 0, float("nan")).otherwise(F.col("price")))


@query("a4_nan_prices", f"""
WITH {NAN_SQL}
SELECT event_id // 1000 AS batch_id, round(avg(cost), 8) AS mean, round(stddev_samp(cost), 8) AS std, min(cost) AS min,
       max(cost) AS max, count(*) AS count FROM ev0 WHERE NOT isnan(cost) GROUP BY 1
""")
def a4_nan_prices(spark, folder):
    batches = numbered_batches(_some_nan(behaviour(spark, folder, with_catalog=False)))
    return _rounded(price_stats(batches, KEYS), ["mean", "std"], 8)


@query("a7_nan_baseline", f"""
WITH {NAN_SQL}, known AS (SELECT cost FROM ev0 WHERE NOT isnan(cost))
SELECT round(avg(cost), 8) AS mean, round(stddev_samp(cost), 8) AS std, min(cost) AS min, max(cost) AS max,
       round(quantile_cont(cost, 0.5), 8) AS p50 FROM known
""")
def a7_nan_baseline(spark, folder):
    figures = numeric_baseline(_some_nan(behaviour(spark, folder, with_catalog=False)))
    return _rounded(figures, ["mean", "std", "p50"], 8).select("mean", "std", "min", "max", "p50")


@query("d1_nan_prices", f"""
WITH {NAN_SQL},
ref AS (SELECT avg(cost) AS mean, greatest(stddev_samp(cost), 0.001) AS std FROM ev0 WHERE NOT isnan(cost)),
sizes AS (SELECT event_id // 1000 AS batch_id, avg(cost) AS mean, count(*) AS n FROM ev0 WHERE NOT isnan(cost) GROUP BY 1)
SELECT batch_id, 'price_mean' AS part, round(least(abs(s.mean - r.mean) / (r.std / sqrt(n)) / 5, 1.0), 8) AS score
FROM sizes s, ref r WHERE n >= 10
""")
def d1_nan_prices(spark, folder):
    events = _some_nan(behaviour(spark, folder, with_catalog=False))
    numeric = stored(numeric_baseline(events), "baseline")
    return _round_score(mean_shift(batch_overview(numbered_batches(events), KEYS), numeric, KEYS))


@query("a3_batch_categories", """
SELECT batch_id, category_code, events FROM (
  SELECT event_id // 1000 AS batch_id, coalesce(category_code, 'unknown') AS category_code, count(*) AS events,
         row_number() OVER (PARTITION BY event_id // 1000 ORDER BY count(*) DESC, coalesce(category_code, 'unknown')) AS place
  FROM ev GROUP BY 1, 2) WHERE place <= 20
""")
def a3_batch_categories(spark, folder):
    return top_by_count(_batches(spark, folder), "category_code", keys=KEYS).select("batch_id", "category_code", "events")


# An alert lasts from when it fires to one evaluation after the last sample that met its condition.
TIMED_SQL = f"""
{CELLS_SQL}, {RULES_SQL}, {_runs_sql('ruled', 'is_met', 'hold_ms', RULE_KEYS)},
timed AS (SELECT alertname, instance AS cluster, service, severity, fires_at_ms AS start_ms, active_until_ms + 3600000 AS end_ms
          FROM runs WHERE firing),
parts AS (SELECT CASE severity WHEN 'critical' THEN 'critical-alerts' WHEN 'warning' THEN 'warning-alerts'
                 ELSE 'slack-notifications' END AS receiver, alertname, cluster, service, start_ms, end_ms FROM timed),
edges AS (SELECT DISTINCT * FROM (
            SELECT receiver, alertname, cluster, service, unnest([start_ms, end_ms]) AS t FROM parts
            UNION ALL SELECT 'warning-alerts', alertname, cluster, service, unnest([start_ms, end_ms]) FROM timed
            WHERE severity = 'critical')),
state AS (SELECT e.*, EXISTS (SELECT 1 FROM parts p WHERE p.receiver = e.receiver AND p.alertname = e.alertname
                   AND p.cluster = e.cluster AND p.service = e.service AND p.start_ms <= t AND p.end_ms > t)
                 AND NOT (e.receiver = 'warning-alerts' AND EXISTS (
                   SELECT 1 FROM parts p WHERE p.receiver = 'critical-alerts' AND p.alertname = e.alertname
                   AND p.cluster = e.cluster AND p.service = e.service AND p.start_ms <= t AND p.end_ms > t)) AS is_on
          FROM edges e),
turns AS (SELECT *, coalesce(lag(is_on) OVER w, false) AS was FROM state
          WINDOW w AS (PARTITION BY receiver, alertname, cluster, service ORDER BY t)),
spans AS (SELECT receiver, alertname, cluster, service, t AS active_since_ms, is_on,
                 lead(t) OVER (PARTITION BY receiver, alertname, cluster, service ORDER BY t) AS active_until_ms
          FROM turns WHERE is_on <> was),
active AS (SELECT receiver, alertname, cluster, service, active_since_ms, active_until_ms FROM spans WHERE is_on)
"""


def _timed_alerts(spark, folder):
    return _alerts(spark, folder).where("firing").select(
        "alertname", F.col("instance").alias("cluster"), "service", "severity", F.col("fires_at_ms").alias("start_ms"),
        (F.col("active_until_ms") + HOUR_MS).alias("end_ms"))


@query("e6_active_groups", f"WITH {TIMED_SQL} SELECT * FROM active")
def e6_active_groups(spark, folder):
    return active_groups(_timed_alerts(spark, folder))


@query("e6_schedule", f"""
WITH {TIMED_SQL},
joined AS (
  SELECT DISTINCT a.receiver, a.alertname, a.cluster, a.service, a.active_since_ms, a.active_until_ms,
         greatest(0, CAST(ceil((greatest(p.start_ms, a.active_since_ms) - a.active_since_ms - 30000) / 300000.0) AS BIGINT)) AS tick
  FROM active a JOIN parts p ON p.receiver = a.receiver AND p.alertname = a.alertname AND p.cluster = a.cluster
       AND p.service = a.service AND p.start_ms < a.active_until_ms AND p.end_ms > a.active_since_ms),
ticks AS (SELECT a.*, unnest(range(0, (active_until_ms - active_since_ms) // 300000 + 2)) AS tick FROM active a),
timed_ticks AS (
  SELECT t.*, t.active_since_ms + 30000 + t.tick * 300000 AS sent_ms, j.tick IS NOT NULL AS is_new,
         max(j.tick) OVER (PARTITION BY t.receiver, t.alertname, t.cluster, t.service, t.active_since_ms ORDER BY t.tick) AS last_new
  FROM ticks t LEFT JOIN joined j ON j.receiver = t.receiver AND j.alertname = t.alertname AND j.cluster = t.cluster
       AND j.service = t.service AND j.active_since_ms = t.active_since_ms AND j.tick = t.tick)
SELECT receiver, alertname, cluster, service, active_since_ms, sent_ms, CASE WHEN is_new THEN 'firing' ELSE 'repeat' END AS kind
FROM timed_ticks WHERE sent_ms < active_until_ms AND (is_new OR (tick - last_new) % 48 = 0)
UNION ALL
SELECT receiver, alertname, cluster, service, active_since_ms, min(sent_ms), 'resolved'
FROM timed_ticks WHERE receiver = 'slack-notifications' AND sent_ms >= active_until_ms
  AND active_since_ms + 30000 < active_until_ms GROUP BY ALL
""")
def e6_schedule(spark, folder):
    return schedule(_timed_alerts(spark, folder))
