"""Queries on the two-sample tests of the detailed drift report."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.drift_tests import chi_square, column_tests, number_distances
from ..sources.tables import behaviour
from .monitor_queries import SPLIT
from .registry import query

NUMBERS, CLASSES = ("price", "item", "hour"), ("event_type", "brand", "hour_name")

SIDES_SQL = """
sides AS (SELECT *, ts >= TIMESTAMP '2024-01-16' AS late, CAST(product_id AS DOUBLE) AS item, CAST(hour(ts) AS DOUBLE) AS hour,
                 CASE WHEN event_id % 50 = 0 THEN NULL ELSE CAST(hour(ts) // 2 AS VARCHAR) END AS hour_name
          FROM (SELECT event_id, ts, product_id, event_type, brand, price + CASE WHEN ts >= TIMESTAMP '2024-01-16' THEN 2 ELSE 0 END AS price
                FROM ev))
"""

NUMBERS_SQL = f"""
{SIDES_SQL},
numbers AS (SELECT late, unnest(['price', 'item', 'hour']) AS "column", unnest([price, item, hour]) AS v FROM sides),
sizes AS (SELECT "column", count(*) FILTER (NOT late) AS baseline_rows, count(*) FILTER (late) AS current_rows,
                 greatest(stddev_samp(v) FILTER (NOT late), 0.001) AS std FROM numbers WHERE v IS NOT NULL GROUP BY 1),
steps AS (SELECT "column", v, count(*) FILTER (NOT late) AS a, count(*) FILTER (late) AS b FROM numbers WHERE v IS NOT NULL GROUP BY 1, 2),
walked AS (SELECT s.*, z.baseline_rows, z.current_rows, z.std, lead(v) OVER w - v AS width,
                  abs(sum(a) OVER w / z.baseline_rows::DOUBLE - sum(b) OVER w / z.current_rows::DOUBLE) AS gap
           FROM steps s JOIN sizes z USING ("column") WINDOW w AS (PARTITION BY s."column" ORDER BY v)),
distances AS (SELECT "column", max(gap) AS ks, sum(gap * width) / any_value(std) AS wasserstein, any_value(baseline_rows) AS baseline_rows,
                     any_value(current_rows) AS current_rows FROM walked GROUP BY 1),
tested_numbers AS (
  SELECT *, (SELECT 2 * sum(CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END
                            * exp(-2 * k * k * ks * ks * baseline_rows * current_rows / (baseline_rows + current_rows)::DOUBLE))
             FROM range(1, 2001) t(k)) AS ks_p FROM distances)
"""

CLASSES_SQL = f"""
{SIDES_SQL},
cells AS (SELECT late, unnest(['event_type', 'brand', 'hour_name']) AS "column",
                 coalesce(unnest([event_type, brand, hour_name]), 'unknown') AS v FROM sides),
counted AS (SELECT "column", v, count(*) FILTER (NOT late) AS a, count(*) FILTER (late) AS b FROM cells GROUP BY 1, 2),
expected AS (SELECT *, a * sum(b) OVER c / sum(a) OVER c AS e FROM counted WINDOW c AS (PARTITION BY "column")),
squares AS (SELECT "column", sum((b - e) * (b - e) / e) AS chi_square, count(*) - 1 AS freedom FROM expected GROUP BY 1),
-- The area behind the statistic under the density, by Simpson's rule in the variable sqrt(t); the factor that makes it one likewise.
grid AS (SELECT "column", chi_square, freedom, i,
                i * 60.0::DOUBLE / 20000 AS y, CASE WHEN i IN (0, 20000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END AS w
         FROM squares, range(0, 20001) t(i)),
tested_classes AS (
  SELECT "column", any_value(chi_square) AS chi_square, any_value(freedom) AS freedom,
         sum(w * exp((freedom - 1) * ln(sqrt(chi_square) + y) - (sqrt(chi_square) + y) ** 2 / 2)) FILTER (true)
         / sum(w * CASE WHEN y = 0 THEN 0 ELSE exp((freedom - 1) * ln(y) - y ** 2 / 2) END) AS chi_square_p
  FROM grid GROUP BY 1)
"""


def _sides(spark, folder):
    """The month before and after its middle; the later prices are two higher."""
    late = F.col("event_time") >= F.expr(SPLIT)
    hour = F.hour("event_time")
    rows = behaviour(spark, folder).select(
        late.alias("late"), (F.col("price") + F.when(late, 2).otherwise(0)).alias("price"),
        F.col("product_id").cast("double").alias("item"), hour.cast("double").alias("hour"), "event_type", "brand",
        F.when(F.pmod("event_id", F.lit(50)) != 0, F.floor(hour / 2).cast("string")).alias("hour_name"))
    return rows.where("not late"), rows.where("late")


@query("d7_number_distances", f"""
WITH {NUMBERS_SQL}
SELECT "column", round(ks, 8) AS ks, round(wasserstein, 8) AS wasserstein, baseline_rows, current_rows FROM tested_numbers
""")
def d7_number_distances(spark, folder):
    found = number_distances(*_sides(spark, folder), NUMBERS)
    return found.select(
        "column", F.round("ks", 8).alias("ks"), F.round("wasserstein", 8).alias("wasserstein"), "baseline_rows", "current_rows")


@query("d7_kolmogorov", f"""WITH {NUMBERS_SQL} SELECT "column", round(ks_p, 8) AS ks_p FROM tested_numbers""")
def d7_kolmogorov(spark, folder):
    return number_distances(*_sides(spark, folder), NUMBERS).select("column", F.round("ks_p", 8).alias("ks_p"))


@query("d7_chi_square", f"""
WITH {CLASSES_SQL}
SELECT "column", round(chi_square, 6) AS chi_square, freedom, round(chi_square_p, 6) AS chi_square_p FROM tested_classes
""")
def d7_chi_square(spark, folder):
    return chi_square(*_sides(spark, folder), CLASSES).select(
        "column", F.round("chi_square", 6).alias("chi_square"), "freedom", F.round("chi_square_p", 6).alias("chi_square_p"))


@query("d7_column_tests", f"""
WITH {NUMBERS_SQL}, {CLASSES_SQL.replace(SIDES_SQL + ",", "")}
SELECT "column", 'ks_p' AS test, round(ks_p, 6) AS score, ks_p < 0.05 AS drifted FROM tested_numbers
UNION ALL SELECT "column", 'chi_square_p', round(chi_square_p, 6), chi_square_p < 0.05 FROM tested_classes
""")
def d7_column_tests(spark, folder):
    # The limit is beyond the tables, so the tests by p-value are the ones that are taken.
    found = column_tests(*_sides(spark, folder), NUMBERS, CLASSES, small=10**12)
    return found.withColumn("score", F.round("score", 6))
