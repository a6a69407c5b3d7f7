"""Inputs that the queries derive from the given tables with fixed formulas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.ordered import DAY_MS, HOUR_MS, block_start
from ..sources.tables import behaviour

INSTANCES = 4
SHARDS = 512
BATCH_ROWS = 1000


def latest_ms(events: DataFrame) -> Column:
    """The data's own clock: its largest timestamp, as a scalar subquery."""
    return events.agg(F.max("ts_ms").alias("now")).scalar()


def faulty_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Events as raw text rows; every twentieth of them breaks a rule in one of several ways."""
    kind = F.pmod("event_id", F.lit(20))

    def pick(cases, other):
        flat = [F.lit(x) for case in cases.items() for x in case]
        return F.coalesce(F.try_element_at(F.create_map(*flat), kind.cast("int")), other)

    return behaviour(spark, folder, with_catalog=False).select(
        "event_id",
        pick({0: "", 8: ""}, F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("event_time"),
        "event_type", "product_id",
        F.lit("1234").alias("category_id"), F.lit("cat.sub").alias("category_code"), F.lit("brand").alias("brand"),
        pick(
            {1: "abc", 2: "", 3: "-1", 4: "nan", 5: "1.5f", 6: "1_0", 8: "abc", 9: "x", 10: " 12.5 ", 11: "inf",
             12: "-inf", 13: "+.5e1", 14: "1__0", 15: "5."},
            F.col("price").cast("string"),
        ).alias("price"),
        pick({7: "", 9: ""}, F.col("user_id")).alias("user_id"),
        F.concat(F.lit("sess-"), F.col("user_id")).alias("user_session"),
    )


FAULTY_SQL = """
raw AS (
  SELECT event_id,
         CASE WHEN event_id % 20 IN (0, 8) THEN '' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS event_time,
         event_type, product_id, '1234' AS category_id, 'cat.sub' AS category_code, 'brand' AS brand,
         CASE event_id % 20 WHEN 1 THEN 'abc' WHEN 2 THEN '' WHEN 3 THEN '-1' WHEN 4 THEN 'nan' WHEN 5 THEN '1.5f'
              WHEN 6 THEN '1_0' WHEN 8 THEN 'abc' WHEN 9 THEN 'x' WHEN 10 THEN ' 12.5 ' WHEN 11 THEN 'inf'
              WHEN 12 THEN '-inf' WHEN 13 THEN '+.5e1' WHEN 14 THEN '1__0' WHEN 15 THEN '5.'
              ELSE CAST(price AS VARCHAR) END AS price,
         CASE WHEN event_id % 20 IN (7, 9) THEN '' ELSE user_id END AS user_id,
         'sess-' || user_id AS user_session,
         CASE event_id % 20 WHEN 0 THEN 'missing event_time' WHEN 8 THEN 'missing event_time'
              WHEN 1 THEN 'parse error: could not convert string to float: ''abc'''
              WHEN 5 THEN 'parse error: could not convert string to float: ''1.5f'''
              WHEN 9 THEN 'parse error: could not convert string to float: ''x'''
              WHEN 14 THEN 'parse error: could not convert string to float: ''1__0'''
              WHEN 3 THEN 'negative price' WHEN 12 THEN 'negative price' WHEN 7 THEN 'missing user_id' END AS error,
         CASE event_id % 20 WHEN 2 THEN NULL WHEN 4 THEN CAST('nan' AS DOUBLE) WHEN 6 THEN 10.0 WHEN 10 THEN 12.5
              WHEN 11 THEN CAST('inf' AS DOUBLE) WHEN 13 THEN 5.0 WHEN 15 THEN 5.0 ELSE price END AS number
  FROM ev
)
"""


def arrivals(spark: SparkSession, folder: str) -> DataFrame:
    """Events with a derived arrival time up to 40 minutes late, over several shards."""
    return behaviour(spark, folder, with_catalog=False).select(
        "event_id", "user_id", "event_type", "product_id", "price", "ts_ms",
        (F.col("ts_ms") + F.pmod(F.col("event_id") * 7919, F.lit(2_400_000))).alias("arrival_ms"),
        F.pmod(F.col("user_id").cast("long"), F.lit(SHARDS)).alias("shard"),
    )


ARRIVALS_SQL = """
arrived AS (
  SELECT event_id, user_id, event_type, product_id, price, ts_ms,
         ts_ms + (event_id * 7919) % 2400000 AS arrival_ms, CAST(user_id AS BIGINT) % 512 AS shard
  FROM ev
),
marked AS (
  SELECT *, max(ts_ms) OVER (PARTITION BY shard ORDER BY arrival_ms, event_id
                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 5000 AS watermark_ms
  FROM arrived
),
classified AS (
  SELECT *, (watermark_ms - ts_ms) / 1000.0 AS delay_seconds,
         CASE WHEN watermark_ms IS NULL OR watermark_ms < ts_ms THEN 'on_time'
              WHEN watermark_ms - ts_ms <= 300000 THEN 'moderate'
              WHEN watermark_ms - ts_ms <= 1800000 THEN 'very_late' ELSE 'discarded' END AS late_class
  FROM marked
)
"""


def latency_samples(spark: SparkSession, folder: str) -> DataFrame:
    """Events as latency samples: the value is the latency, errors are failures, clicks are cache hits."""
    return behaviour(spark, folder, with_catalog=False).select(
        "event_id", "ts_ms", F.col("price").alias("latency_ms"),
        (F.col("event_type") != "error").alias("ok"), (F.col("event_type") == "click").alias("cache_hit"),
        F.element_at(F.array(*[F.lit(n) for n in (1, 4, 8, 16, 32, 64)]),
                     (F.pmod("event_id", F.lit(6)) + 1).cast("int")).cast("long").alias("batch_size"),
    )


SAMPLES_SQL = """
samples AS (
  SELECT event_id, ts_ms, price AS latency_ms, event_type <> 'error' AS ok, event_type = 'click' AS cache_hit,
         CAST([1, 4, 8, 16, 32, 64][event_id % 6 + 1] AS BIGINT) AS batch_size
  FROM ev
)
"""


def numbered_batches(events: DataFrame) -> DataFrame:
    """Batches of 1000 rows in the order of the event ids."""
    return events.withColumn("batch_id", F.floor(F.col("event_id") / BATCH_ROWS).cast("long"))


def hourly_cells(spark: SparkSession, folder: str) -> DataFrame:
    """Per instance and hour: events, errors, views and mean value."""
    return (
        behaviour(spark, folder, with_catalog=False)
        .groupBy(
            F.concat(F.lit("node-"), F.pmod(F.col("user_id").cast("long"), F.lit(INSTANCES))).alias("instance"),
            block_start(F.col("ts_ms"), HOUR_MS).alias("ts_ms"),
        )
        .agg(
            F.count("*").alias("events"), F.count_if(F.col("event_type") == "error").alias("errors"),
            F.count_if(F.col("event_type") == "view").alias("views"), F.avg("price").alias("price_mean"),
        )
    )


CELLS_SQL = """
cells AS (
  SELECT 'node-' || CAST(CAST(user_id AS BIGINT) % 4 AS VARCHAR) AS instance, ts_ms - ts_ms % 3600000 AS ts_ms,
         count(*) AS events, count(*) FILTER (event_type = 'error') AS errors,
         count(*) FILTER (event_type = 'view') AS views, avg(price) AS price_mean
  FROM ev GROUP BY 1, 2
)
"""


def price_samples(cells: DataFrame) -> DataFrame:
    return cells.select("instance", "ts_ms", F.col("price_mean").alias("value"))


def counter_samples(cells: DataFrame, column: str = "events") -> DataFrame:
    """A counter that restarts every day; a day has at most 24 samples per instance."""
    day = (
        Window.partitionBy("instance", "_day").orderBy("ts_ms")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return cells.withColumn("_day", block_start(F.col("ts_ms"), DAY_MS)).select(
        "instance", "ts_ms", F.sum(column).over(day).cast("double").alias("value")
    )


COUNTER_SQL = """
counter AS (
  SELECT instance, ts_ms,
         CAST(sum(events) OVER (PARTITION BY instance, ts_ms - ts_ms % 86400000 ORDER BY ts_ms) AS DOUBLE) AS value
  FROM cells
)
"""
