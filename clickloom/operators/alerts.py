"""Alert rules over metric samples (E1-E7) and consumer lag.

Samples have a series key (one or more columns), ``ts_ms`` and ``value``. Rules use the order of a series
through running aggregates over blocks of time, so a series of any length is worked on in parallel.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import astuple, dataclass, fields

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import ratio
from .ordered import DAY_MS, block_start, finite_parts, finite_total, running, trailing_sums

MINUTE_MS = 60_000


@dataclass(frozen=True)
class Rule:
    alertname: str
    metric: str
    op: str
    threshold: float
    hold_ms: int
    severity: str
    service: str = ""


# Threshold rules with the time a condition must hold.
STANDARD_RULES = (
    Rule("HighKafkaLag", "kafka_consumer_group_lag", ">", 1000, 5 * MINUTE_MS, "critical", "streaming-pipeline"),
    Rule("FlinkCheckpointFailures", "failed_checkpoints_increase", ">", 0, MINUTE_MS, "warning"),
    Rule("HighCheckpointDuration", "last_checkpoint_duration", ">", 60000, 5 * MINUTE_MS, "warning"),
    Rule("HighFlinkBackpressure", "back_pressured_time_ms_per_second", ">", 500, 3 * MINUTE_MS, "warning"),
    Rule("HighDataDrift", "data_drift_score", ">", 0.2, 10 * MINUTE_MS, "warning", "data-processing"),
    Rule("HighLateArrivingData", "late_arriving_events_rate", ">", 10, 5 * MINUTE_MS, "warning"),
    Rule("MissingData", "data_events_processed_rate", "<", 1, 5 * MINUTE_MS, "critical"),
    Rule("DataAnomalyPrice", "data_price_mean_deviation", ">", 0.5, 5 * MINUTE_MS, "warning"),
    Rule("HighMemoryUsage", "memory_used_percent", ">", 85, 5 * MINUTE_MS, "warning"),
    Rule("HighCPUUsage", "cpu_used_percent", ">", 80, 5 * MINUTE_MS, "warning"),
    Rule("DiskSpaceRunningOut", "disk_available_percent", "<", 15, 5 * MINUTE_MS, "warning"),
    Rule("ServiceDown", "up", "==", 0, MINUTE_MS, "critical"),
)
ABSENCE_HOLD_MS = 2 * MINUTE_MS
EXPECTED_PRICE = 150.0
GROUP_LABELS = ("alertname", "cluster", "service")


def rules_frame(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    schema = "alertname string, metric string, op string, threshold double, hold_ms long, severity string, service string"
    rows = [tuple(float(v) if f.name == "threshold" else v for f, v in zip(fields(r), astuple(r))) for r in rules]
    return spark.createDataFrame(rows, schema)


def holding_runs(samples: DataFrame, keys: Sequence[str], condition: Column, hold_ms: Column | int,
                 block_ms: int = DAY_MS) -> DataFrame:
    """Stretches of samples that meet ``condition``, and whether they lasted ``hold_ms``.

    A stretch is named by the last sample before it that failed, which is a running maximum; the
    stretches themselves are then a plain grouping.
    """
    met = F.coalesce(condition, F.lit(False))
    named = running(
        samples.withColumn("_met", met), keys, ["ts_ms"], F.when(~F.col("_met"), F.col("ts_ms")), "_after",
        how="max", block=block_start(F.col("ts_ms"), block_ms),
    )
    hold = F.lit(hold_ms) if isinstance(hold_ms, int) else F.max(hold_ms)
    return (
        named.where("_met").groupBy(*keys, "_after").agg(
            F.min("ts_ms").alias("active_since_ms"), F.max("ts_ms").alias("active_until_ms"),
            F.count("*").alias("samples"), hold.alias("_hold"),
        )
        .withColumn("firing", F.col("active_until_ms") - F.col("active_since_ms") >= F.col("_hold"))
        .withColumn("fires_at_ms", F.when(F.col("firing"), F.col("active_since_ms") + F.col("_hold")))
        .drop("_after", "_hold")
    )


def evaluate_rules(samples: DataFrame, rules: DataFrame, labels: Sequence[str]) -> DataFrame:
    """E1 for all rules at once; ``samples`` has metric, the label columns, ts_ms and value."""
    ruled = samples.join(rules, "metric")
    value, bound = F.col("value"), F.col("threshold")
    met = (
        F.when(F.col("op") == ">", value > bound).when(F.col("op") == "<", value < bound)
        .when(F.col("op") == "==", value == bound)
    )
    keys = ["alertname", "severity", "service", *labels]
    return holding_runs(ruled, keys, met, F.col("hold_ms"))


def increases(samples: DataFrame, keys: Sequence[str], width_ms: int, block_ms: int = DAY_MS) -> DataFrame:
    """``increase`` and ``rate`` of a counter over the trailing time; a drop counts as a restart from zero."""
    previous = running(
        samples, keys, ["ts_ms"], F.col("value"), "_previous", how="last",
        block=block_start(F.col("ts_ms"), block_ms), before=True,
    )
    step = (
        F.when(F.col("_previous").isNull(), F.lit(0.0))
        .when(F.col("value") >= F.col("_previous"), F.col("value") - F.col("_previous"))
        .otherwise(F.col("value"))
    )
    summed = trailing_sums(
        previous, keys, "ts_ms", {"increase": step}, width_ms, include_lower=False,
    )
    return summed.drop("_previous").withColumn("rate", F.col("increase") / (width_ms / 1000.0))


def absences(samples: DataFrame, keys: Sequence[str], now_ms: Column, hold_ms: int = ABSENCE_HOLD_MS,
             block_ms: int = DAY_MS, expected: DataFrame | None = None) -> DataFrame:
    """Times without any sample of a series for longer than ``hold_ms``; the open one ends at ``now_ms``.

    ``expected`` has the keys and ``since_ms`` of series that should report; one that never did is absent from then on.
    """
    gaps = running(
        samples.select(*keys, "ts_ms"), keys, ["ts_ms"], F.col("ts_ms"), "absent_since_ms", how="max",
        block=block_start(F.col("ts_ms"), block_ms), before=True,
    ).withColumnRenamed("ts_ms", "absent_until_ms")
    tail = samples.groupBy(*keys).agg(F.max("ts_ms").alias("absent_since_ms")).withColumn("absent_until_ms", now_ms)
    if expected is not None:
        never = expected.join(samples.select(*keys).distinct(), list(keys), "left_anti")
        tail = tail.unionByName(never.select(
            *keys, F.col("since_ms").alias("absent_since_ms")).withColumn("absent_until_ms", now_ms))
    return gaps.unionByName(tail).where(
        F.col("absent_until_ms") - F.col("absent_since_ms") > hold_ms
    ).withColumn("fires_at_ms", F.col("absent_since_ms") + hold_ms)


def mean_deviation(samples: DataFrame, keys: Sequence[str], width_ms: int, expected: float = EXPECTED_PRICE) -> DataFrame:
    """Relative distance of the trailing mean to an expected value."""
    summed = trailing_sums(
        samples, keys, "ts_ms", {**finite_parts("_sum", F.col("value")), "_n": F.lit(1).cast("long")}, width_ms,
        include_lower=False,
    )
    mean = finite_total("_sum") / F.col("_n")
    return summed.withColumn("mean", mean).withColumn(
        "deviation", F.abs(F.col("mean") - expected) / expected
    ).drop("_sum", "_sum_nan", "_sum_up", "_sum_down", "_n")


def side_by_side(samples: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """E5: metrics of the same series and time as columns."""
    return samples.where(F.col("metric").isin(*metrics)).groupBy(*keys, "ts_ms").agg(
        *[F.max(F.when(F.col("metric") == m, F.col("value"))).alias(m) for m in metrics]
    )


def used_percent(total: str, available: str) -> Column:
    return ratio(F.col(total) - F.col(available), F.col(total)) * 100.0


def available_percent(available: str, total: str) -> Column:
    return ratio(F.col(available), F.col(total)) * 100.0


def busy_percent(idle_rates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """E5: 100 - mean idle rate of an instance's cores * 100."""
    return idle_rates.groupBy(*keys, "ts_ms").agg((100.0 - F.avg("rate") * 100.0).alias("value"))


def notifications(alerts: DataFrame) -> DataFrame:
    """Inhibition, receivers and groups for firing alerts with alertname, cluster, service and severity.

    Alerts are counted per group and severity first; a group then has one entry per severity to look at.
    """
    labels = [F.coalesce(c, F.lit("")).alias(c) for c in GROUP_LABELS]
    counted = alerts.select(*labels, "severity", "active_since_ms").groupBy(*GROUP_LABELS, "severity").agg(
        F.count("*").alias("alerts"), F.min("active_since_ms").alias("first_since_ms")
    )
    entry = F.struct("severity", "alerts", "first_since_ms")
    grouped = counted.groupBy(*GROUP_LABELS).agg(
        F.collect_list(entry).alias("_entries"), F.max(F.col("severity") == "critical").alias("_critical")
    )
    receiver = (
        F.when(F.col("severity") == "critical", F.lit("critical-alerts"))
        .when(F.col("severity") == "warning", F.lit("warning-alerts"))
        .otherwise(F.lit("slack-notifications"))
    )
    kept = grouped.select("*", F.inline("_entries")).where(
        F.coalesce(F.col("severity") != "warning", F.lit(True)) | ~F.coalesce("_critical", F.lit(False))
    )
    return kept.groupBy(receiver.alias("receiver"), *GROUP_LABELS).agg(
        F.sum("alerts").alias("alerts"), F.min("first_since_ms").alias("first_since_ms")
    )


def consumer_lag(end_offsets: DataFrame, committed: DataFrame) -> DataFrame:
    """Lag per consumer group, topic and partition."""
    return committed.join(end_offsets, ["topic", "partition"]).select(
        "consumer_group", "topic", "partition",
        (F.col("end_offset") - F.col("committed_offset")).alias("lag"),
    )


def lag_over(lags: DataFrame, threshold: int = 1000) -> DataFrame:
    """Lag of the partitions beyond the threshold, summed per group and topic (and per sample if there are several)."""
    at = [c for c in ("ts_ms",) if c in lags.columns]
    return lags.where(F.col("lag") > threshold).groupBy("consumer_group", "topic", *at).agg(
        F.sum("lag").alias("lag"), F.count("*").alias("partitions")
    )


def lag_alerts(lags: DataFrame, threshold: int = 1000, hold_ms: int = 5 * MINUTE_MS) -> DataFrame:
    """E1's lag rule: stretches in which the summed lag beyond the threshold exists at every sample, and whether they held.

    ``lags`` has samples of consumer_group, topic, partition, ts_ms and lag.
    """
    series = ["consumer_group", "topic"]
    over = lag_over(lags, threshold).select(*series, "ts_ms", F.lit(True).alias("_over"))
    sampled = lags.select(*series, "ts_ms").distinct().join(over, [*series, "ts_ms"], "left")
    return holding_runs(sampled, series, F.col("_over"), hold_ms).drop("_met", "_over")


def roll_up(samples: DataFrame, by: Sequence[str], how: str = "sum") -> DataFrame:
    """Sum or mean by label."""
    value = {"sum": F.sum, "avg": F.avg}[how]("value")
    return samples.groupBy(*by).agg(value.alias("value"))


def top_series(rolled: DataFrame, label: str, limit: int = 10) -> DataFrame:
    """topk"""
    return rolled.orderBy(F.desc("value"), F.asc(label)).limit(limit)
