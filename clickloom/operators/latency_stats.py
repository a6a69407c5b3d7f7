"""Latency, throughput and error summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import ratio
from .ordered import exact_percentiles, percentile_columns

WINDOW_ROWS = 10_000
OUTLIER_STDS = 3.0
SLA_MS = 75.0
SLA_POSITIONS = {0.5: "p50", 0.75: "p75", 0.9: "p90", 0.95: "p95", 0.99: "p99"}
LOAD_PERCENTILES = {0.5: "p50_ms", 0.95: "p95_ms", 0.99: "p99_ms", 0.999: "p999_ms"}
# Bucket edges of the two latency histograms, in seconds.
PROCESSING_BUCKETS = (0.1, 0.5, 1, 2, 5, 10)
CONSUMPTION_BUCKETS = (0.1, 0.5, 1, 2, 5, 10, 30, 60)


def service_stats(samples: DataFrame, order: Sequence[Column], elapsed_seconds: Column) -> DataFrame:
    """A8 over the last 10,000 answered requests; ``samples`` has latency_ms, ok and cache_hit.

    The window is bounded by definition, so its rows fit one task.
    """
    latest = samples.where("ok").orderBy(*order).limit(WINDOW_ROWS).select("latency_ms")
    everything = Window.partitionBy()
    x = F.col("latency_ms")
    marked = (
        latest.withColumn("_mean", F.avg(x).over(everything))
        .withColumn("_std", F.stddev_pop(x).over(everything))
        .withColumn("_in", x < F.col("_mean") + OUTLIER_STDS * F.col("_std"))
        .withColumn("_use", F.col("_in") | ~F.max("_in").over(everything))
    )
    used = F.when(F.col("_use"), x)
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    points = F.percentile(used, F.array(F.lit(0.5), F.lit(0.95), F.lit(0.99)))
    figures = marked.agg(
        points.alias("_p"), F.avg(used).alias("_m"), F.max("_std").alias("_s"), F.count("*").alias("total_predictions")
    )
    counters = samples.agg(
        F.count_if(~F.col("ok")).alias("_errors"),
        F.count_if(F.col("cache_hit")).alias("_hits"), F.count_if(~F.col("cache_hit")).alias("_misses"),
    )
    n = F.col("total_predictions")
    some = n > 0
    return (
        figures.withColumn("_c", counters.select(F.struct("*").alias("c")).scalar())
        .withColumn("_elapsed", elapsed_seconds)
        .select(
            zero(F.get("_p", F.lit(0))).alias("p50"), zero(F.get("_p", F.lit(1))).alias("p95"),
            zero(F.get("_p", F.lit(2))).alias("p99"),
            zero(F.col("_m")).alias("mean"), zero(F.col("_s")).alias("std"),
            ratio(n, F.col("_elapsed")).alias("throughput"),
            F.when(some, F.least(F.col("_c._errors"), F.lit(WINDOW_ROWS)) / n).otherwise(0.0).alias("error_rate"),
            F.when(some, ratio(F.col("_c._hits"), F.col("_c._hits") + F.col("_c._misses"))).otherwise(0.0)
            .alias("cache_hit_rate"),
            n,
        )
    )


def _with_stats(df: DataFrame, stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join per-group figures; without keys they come in as one value."""
    if keys:
        return df.join(stats, list(keys))
    whole = stats.select(F.struct(*stats.columns).alias("s")).scalar()
    return df.withColumn("_s", whole).select(*df.columns, "_s.*")


def load_stats(samples: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """A9 over all rows; every percentile is exact and found without sorting a whole group.

    One pass gives the totals and the bound of outliers, which the same rows are then held against.
    """
    keys = list(keys)
    x = F.col("latency_ms")
    answered = F.when(F.col("ok"), x)
    bound = F.avg(answered) + OUTLIER_STDS * F.stddev_pop(answered)
    totals = samples.groupBy(*keys).agg(
        F.count("*").alias("total_requests"), F.count_if(F.col("ok")).alias("successful_requests"),
        F.sum(answered).alias("_sum"),
        F.when(F.min(answered) < bound, bound).otherwise(F.lit(float("inf"))).alias("_bound"),
    )
    kept = _with_stats(samples.where("ok").select(*keys, "latency_ms"), totals, keys).where(x < F.col("_bound"))
    figures = kept.groupBy(*keys).agg(
        F.avg(x).alias("mean_ms"), F.min(x).alias("min_ms"), F.max(x).alias("max_ms"),
        F.stddev_pop(x).alias("std_ms"),
    )
    spread = percentile_columns(exact_percentiles(kept, keys, x, list(LOAD_PERCENTILES)), keys, LOAD_PERCENTILES).drop("rows")
    joined = _with_stats(_with_stats(figures, spread, keys), totals, keys)
    return joined.withColumn(
        "throughput_rps", ratio(F.col("successful_requests"), F.col("_sum") / 1000.0)
    ).withColumn(
        "error_rate", (F.col("total_requests") - F.col("successful_requests")) / F.col("total_requests")
    ).drop("_sum", "_bound")


def sla_stats(samples: DataFrame, limit_ms: float = SLA_MS) -> DataFrame:
    """A10: percentiles are the values at position floor(n * q); passes while p95 is under the limit."""
    x = F.col("latency_ms")
    figures = samples.agg(
        F.count(x).alias("count"), F.avg(x).alias("mean"), F.min(x).alias("min"), F.max(x).alias("max"),
        F.coalesce(F.stddev_samp(x), F.lit(0.0)).alias("std_dev"),
    )
    spread = percentile_columns(
        exact_percentiles(samples, [], x, list(SLA_POSITIONS)), [], {0.5: "median"}, SLA_POSITIONS
    ).drop("rows")
    return (
        _with_stats(figures, spread, [])
        .where(F.col("count") > 0)
        .withColumn("sla_passed", F.col("p95") < limit_ms)
    )


def batch_efficiency(by_batch_size: DataFrame) -> DataFrame:
    """Mean of single requests * batch size / mean of a batch; a row per batch size comes in."""
    single = F.max(F.when(F.col("batch_size") == 1, F.col("mean_ms"))).over(Window.partitionBy())
    return by_batch_size.select(
        "batch_size", "mean_ms", ratio(single * F.col("batch_size"), F.col("mean_ms")).alias("efficiency")
    ).where(F.col("batch_size") > 1)


def histogram(df: DataFrame, value: Column, edges: Sequence[float], keys: Sequence[str] = ()) -> DataFrame:
    """Cumulative counts per upper edge, the last one without bound; one pass with a counter per edge."""
    counters = [F.count_if(value <= e) for e in edges] + [F.count(value)]
    counted = df.groupBy(*keys).agg(F.array(*counters).alias("_counts"), F.sum(value).alias("sum"))
    names = F.array(*[F.lit(float(e)) for e in edges], F.lit(float("inf")))
    return counted.select(*keys, "sum", F.inline(F.arrays_zip(names.alias("le"), F.col("_counts").alias("events"))))
