"""Baseline statistics and drift of batches against them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import clamp
from .activity import known_number, price_figures
from .intake import late_by_clock, unknown_if_null
from .ordered import COARSE_BLOCKS, block_start, exact_percentiles, percentile_columns, running, top_rows, value_block, value_slot

PERCENTILES = {0.05: "p5", 0.25: "p25", 0.5: "p50", 0.75: "p75", 0.95: "p95"}
CATEGORICAL = ("event_type", "category_code", "brand")
BASELINE_TOP = 20
MISSING_SHARE = 1e-10
LOG_GUARD = 1e-10
MIN_PRICES, MIN_CATEGORY_ROWS, MIN_BATCH, MIN_REPORT_ROWS = 10, 10, 50, 100
HIGH, MODERATE = 0.2, 0.1
HISTORY = 1000


def numeric_baseline(df: DataFrame, column: str = "price") -> DataFrame:
    """One row of figures for a numeric column."""
    value = known_number(column)
    spread = percentile_columns(exact_percentiles(df, [], value, list(PERCENTILES)), [], PERCENTILES).drop("rows")
    moments = df.agg(
        F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"), F.max(value).alias("max"),
    ).withColumn("_p", spread.select(F.struct(*spread.columns).alias("p")).scalar())
    return moments.select(F.lit(column).alias("column"), "mean", "std", "min", "max", "_p.*")


def _category_values(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """keys, column, value, events; null counts as "unknown"."""
    stacked = F.array(*[
        F.struct(F.lit(c).alias("column"), unknown_if_null(c).alias("value")) for c in columns
    ])
    return df.select(*keys, F.inline(stacked)).groupBy(*keys, "column", "value").agg(
        F.count("*").alias("events")
    )


def categorical_baseline(df: DataFrame, top: int = BASELINE_TOP) -> DataFrame:
    """Share per value; all event types without nulls, the top values of the other columns."""
    sizes = df.agg(F.struct(F.count("*").alias("rows"), F.count("event_type").alias("types")).alias("s")).scalar()
    types = df.where(F.col("event_type").isNotNull()).groupBy(F.col("event_type").alias("value")).agg(
        F.count("*").alias("events")
    ).select(F.lit("event_type").alias("column"), "value", "events", sizes["types"].alias("_total"))
    others = top_rows(
        _category_values(df, [], ["category_code", "brand"]), ["column"], [F.desc("events"), F.asc("value")], top
    ).select("column", "value", "events", sizes["rows"].alias("_total"))
    return types.unionByName(others).select(
        "column", "value", (F.col("events") / F.col("_total")).alias("share")
    )


def batch_overview(df: DataFrame, keys: Sequence[str], now: Column | None = None) -> DataFrame:
    """Size, late rows (P7), price figures (A4) and hour counts of every batch in one pass."""
    hour = F.hour("event_time")
    late = F.count_if(late_by_clock("event_time", now)) if now is not None else F.lit(None).cast("long")
    return df.groupBy(*keys).agg(
        F.count("*").alias("batch_size"), late.alias("late_events"), *price_figures("price"),
        F.array(*[F.count_if(hour == h) for h in range(24)]).alias("hours"),
        F.max("event_time").alias("last_event"),
    )


def _with_reference(df: DataFrame, numeric: DataFrame) -> DataFrame:
    """Add ``_r``: the figures of the price baseline as one value; the baseline has one row per column."""
    row = numeric.where("column = 'price'").select(
        F.struct(
            "mean", F.greatest("std", F.lit(0.001)).alias("std"), (F.col("max") - F.col("min")).alias("range"),
            *PERCENTILES.values(),
        ).alias("r")
    )
    return df.withColumn("_r", row.scalar())


def _mean_shift() -> Column:
    z = F.abs(F.col("mean") - F.col("_r.mean")) / (F.col("_r.std") / F.sqrt("count"))
    return F.when(F.col("count") >= MIN_PRICES, F.least(z / 5.0, F.lit(1.0)))


def mean_shift(overview: DataFrame, numeric: DataFrame, keys: Sequence[str]) -> DataFrame:
    """D1"""
    return _with_reference(overview, numeric).select(
        *keys, F.lit("price_mean").alias("part"), _mean_shift().alias("score")
    ).where(F.col("score").isNotNull())


def _quantile_distance(points: Sequence[Column]) -> Column:
    widest = F.greatest(*[F.abs(x - F.col(f"_r.{n}")) for x, n in zip(points, PERCENTILES.values())])
    score = F.least(F.coalesce(F.try_divide(widest, F.col("_r.range")), F.lit(1.0)), F.lit(1.0))
    return F.when(widest == 0, F.lit(0.0)).otherwise(score)


def quantile_distance(df: DataFrame, numeric: DataFrame, keys: Sequence[str]) -> DataFrame:
    """D2 for batches of any size."""
    current = percentile_columns(
        exact_percentiles(df, keys, F.col("price"), list(PERCENTILES)), keys, PERCENTILES
    ).where(F.col("rows") >= MIN_PRICES)
    return _with_reference(current, numeric).select(
        *keys, F.lit("price_quantiles").alias("part"),
        _quantile_distance([F.col(n) for n in PERCENTILES.values()]).alias("score"),
    )


def category_divergence(
    df: DataFrame, categorical: DataFrame, keys: Sequence[str], columns: Sequence[str] = CATEGORICAL
) -> DataFrame:
    """D3: Jensen-Shannon divergence per batch and column over the values of either side."""
    pair = [*keys, "column"]
    current = _category_values(df, keys, columns).withColumn("share", F.lit(None).cast("double"))
    # A baseline lists at most BASELINE_TOP values per column, so each batch gets that many rows more.
    listed = categorical.where(F.col("column").isin(*columns)).agg(
        F.collect_list(F.struct("column", "value", "share")).alias("listed")
    )
    expected = current.select(*keys).distinct().withColumn("_listed", listed.scalar()).select(
        *keys, F.inline("_listed")
    ).withColumn("events", F.lit(None).cast("long"))
    merged = current.unionByName(expected).groupBy(*pair, "value").agg(
        F.max("share").alias("_p"), F.max("events").alias("_events")
    )
    sums = merged.groupBy(*pair).agg(
        F.sum("_events").alias("_rows"),
        F.sum(F.coalesce("_p", F.lit(MISSING_SHARE))).alias("_ps"),
        (1.0 + F.count_if(F.col("_events").isNull()) * MISSING_SHARE).alias("_qs"),
    ).where(F.col("_rows") >= MIN_CATEGORY_ROWS)
    p = F.coalesce("_p", F.lit(MISSING_SHARE)) / F.col("_ps")
    q = F.coalesce(F.col("_events") / F.col("_rows"), F.lit(MISSING_SHARE)) / F.col("_qs")
    return merged.join(sums, pair).groupBy(*pair).agg(
        clamp(F.sum(_divergence(p, q)) / 2.0).alias("score")
    ).select(*keys, F.col("column").alias("part"), "score")


def _divergence(p: Column, q: Column) -> Column:
    """Twice the contribution of one value to the Jensen-Shannon divergence."""
    middle = (p + q) / 2.0
    return p * F.ln((p + LOG_GUARD) / (middle + LOG_GUARD)) + q * F.ln((q + LOG_GUARD) / (middle + LOG_GUARD))


def _hour_distance() -> Column:
    present = F.filter("hours", lambda n: n > 0)
    rows = F.aggregate(present, F.lit(0).cast("long"), lambda a, n: a + n)
    distance = F.aggregate(present, F.lit(0.0), lambda a, n: a + F.abs(n / rows - 1.0 / 24.0))
    return F.when(F.size(present) > 0, F.least(distance / F.size(present) * 10.0, F.lit(1.0)))


def hour_profile(overview: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mean distance to an even day over the hours that occur."""
    return overview.select(*keys, F.lit("hour").alias("part"), _hour_distance().alias("score")).where(
        F.col("score").isNotNull()
    )


def drift_parts(
    df: DataFrame, numeric: DataFrame, categorical: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """D1-D4 in long form: keys, part, score; a part that cannot be computed is null or missing.

    Mean and hours come from one pass, whose rows also bring ``batch_size``.
    """
    part = lambda name, score: F.struct(F.lit(name).alias("part"), score.alias("score"))
    plain = [part("price_mean", _mean_shift()), part("hour", _hour_distance())]
    parts = _with_reference(batch_overview(df, keys), numeric).select(
        *keys, "batch_size", F.inline(F.array(*plain))
    )
    others = category_divergence(df, categorical, keys).unionByName(quantile_distance(df, numeric, keys))
    return parts.unionByName(others, allowMissingColumns=True)


def drift_level(score: Column) -> Column:
    """D6"""
    return F.when(score > HIGH, F.lit("high")).when(score > MODERATE, F.lit("moderate")).otherwise(F.lit("none"))


def drift_totals(parts: DataFrame, keys: Sequence[str], min_batch: int = MIN_BATCH) -> DataFrame:
    """Mean of the parts for batches that are large enough, null for smaller ones."""
    means = parts.groupBy(*keys).agg(F.max("batch_size").alias("batch_size"), F.avg("score").alias("_mean"))
    score = F.when(F.col("batch_size") >= min_batch, F.coalesce("_mean", F.lit(0.0)))
    return means.select(*keys, "batch_size", score.alias("drift_score")).withColumn(
        "level", F.when(F.col("drift_score").isNotNull(), drift_level(F.col("drift_score")))
    )


def two_sample_distance(baseline: DataFrame, current: DataFrame, column: str) -> DataFrame:
    """Largest distance of the two distribution functions. Equal values are counted before they are ordered."""
    clean = lambda df, side: df.where(
        F.col(column).isNotNull() & ~F.isnan(column)
    ).select(F.col(column).alias("_v"), F.lit(side).alias("_side"))
    per_value = clean(baseline, 0).unionByName(clean(current, 1)).groupBy("_v").agg(
        F.count_if(F.col("_side") == 0).alias("_a"), F.count_if(F.col("_side") == 1).alias("_b")
    )
    sizes = per_value.agg(F.struct(F.sum("_a").alias("a"), F.sum("_b").alias("b")).alias("sizes"))
    step = F.col("_a") / F.col("_n.a") - F.col("_b") / F.col("_n.b")
    walked = running(
        per_value.withColumn("_n", sizes.scalar()), [], ["_v"], step, "_gap", how="sum",
        block=F.struct(value_block(F.col("_v")).alias("block"), value_slot(F.col("_v")).alias("slot")),
    )
    return walked.agg(F.max(F.abs("_gap")).alias("statistic")).select(
        F.lit(column).alias("column"), F.lit("ks").alias("method"), "statistic"
    )


def two_sample_divergence(baseline: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Jensen-Shannon divergence of two whole tables, per column over the values of either side."""
    stacked = lambda df, side: _category_values(df, [], columns).withColumn("_side", F.lit(side))
    counts = stacked(baseline, 0).unionByName(stacked(current, 1)).groupBy("column", "value").agg(
        F.sum(F.when(F.col("_side") == 0, F.col("events"))).alias("_a"),
        F.sum(F.when(F.col("_side") == 1, F.col("events"))).alias("_b"),
    )
    sides = ("_a", "_b")
    sums = counts.groupBy("column").agg(
        *[F.sum(c).alias(f"{c}_rows") for c in sides],
        *[(1.0 + F.count_if(F.col(c).isNull()) * MISSING_SHARE).alias(f"{c}_sum") for c in sides],
    )
    p, q = (F.coalesce(F.col(c) / F.col(f"{c}_rows"), F.lit(MISSING_SHARE)) / F.col(f"{c}_sum") for c in sides)
    return counts.join(sums, "column").groupBy("column").agg(
        clamp(F.sum(_divergence(p, q)) / 2.0).alias("statistic")
    ).select("column", F.lit("jensen_shannon").alias("method"), "statistic")


def drift_report(
    baseline: DataFrame, current: DataFrame, numeric: Sequence[str] = ("price",),
    categorical: Sequence[str] = CATEGORICAL, threshold: float = MODERATE, gate: DataFrame | None = None,
) -> DataFrame:
    """Statistic per column and whether it drifted; whole tables, no samples.

    ``gate`` is a row with drift_score and batch_size; the report is empty unless ``report_wanted`` holds for it.
    """
    report = two_sample_divergence(baseline, current, categorical)
    for column in numeric:
        report = report.unionByName(two_sample_distance(baseline, current, column))
    report = report.withColumn("drifted", F.col("statistic") > threshold)
    if gate is None:
        return report
    wanted = gate.agg(F.max(report_wanted(F.col("drift_score"), F.col("batch_size"))).alias("wanted"))
    return report.where(F.coalesce(wanted.scalar(), F.lit(False)))


def report_wanted(drift_score: Column, rows: Column) -> Column:
    """Whether a batch drifted enough and is large enough for the detailed report."""
    return (drift_score > MODERATE) & (rows >= MIN_REPORT_ROWS)


def dataset_drift(report: DataFrame, share: float = 0.5) -> DataFrame:
    """Share of drifted columns and the flag for the data set."""
    return report.agg(
        F.count("*").alias("columns"), F.count_if(F.col("drifted")).alias("drifted_columns")
    ).withColumn("drifted_share", F.col("drifted_columns") / F.col("columns")).withColumn(
        "dataset_drift", F.col("drifted_share") >= share
    )


def drift_history(totals: DataFrame, order: str, kept: int = HISTORY, block: int = 10_000) -> DataFrame:
    """Scores with the running number of processed rows, the last ``kept`` batches."""
    counted = running(
        totals, [], [order], F.col("batch_size"), "processed_total", how="sum",
        block=block_start(F.col(order), block), coarse=block * COARSE_BLOCKS,
    )
    return counted.orderBy(F.desc(order)).limit(kept)
