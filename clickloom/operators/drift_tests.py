"""Two-sample tests per column type (D7): Wasserstein distance, Kolmogorov-Smirnov and chi-square with their p-values.

Columns are stacked to (column, value, side) and equal values are counted first, so all later steps have a row per distinct
value. The distribution functions are running sums over blocks of values; the area between them, and their largest
distance, follow from the same pass.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .drift import two_sample_divergence
from .ordered import running, value_block, value_slot

LEAST_STD = 0.001
# A small reference is tested by p-value, a larger one by distance.
SMALL_REFERENCE = 1000
P_LIMIT, DISTANCE_LIMIT = 0.05, 0.1


def _stacked(baseline: DataFrame, current: DataFrame, columns: Sequence[str], kind: str) -> DataFrame:
    def side(df: DataFrame, number: int) -> DataFrame:
        cells = [F.struct(F.lit(c).alias("column"), F.col(c).cast(kind).alias("_v")) for c in columns]
        return df.select(F.inline(F.array(*cells))).withColumn("_side", F.lit(number))

    return side(baseline, 0).unionByName(side(current, 1))


def _sides(rows: DataFrame) -> DataFrame:
    return rows.groupBy("column", "_v").agg(
        F.count_if(F.col("_side") == 0).alias("_a"), F.count_if(F.col("_side") == 1).alias("_b"))


def kolmogorov_p(statistic: Column, n: Column, m: Column) -> Column:
    """P(K > sqrt(nm / (n + m)) * statistic) of the limit distribution; one of its two series converges fast everywhere."""
    x = F.greatest(statistic * F.sqrt(n.cast("double") * m / (n + m)), F.lit(1e-9))
    upper = sum((2.0 * (-1) ** (k - 1) * F.exp(-2.0 * k * k * x * x) for k in range(1, 6)), F.lit(0.0))
    lower = sum((F.exp(-((2 * k - 1) ** 2) * math.pi**2 / (8 * x * x)) for k in range(1, 4)), F.lit(0.0))
    p = F.when(x < 1.0, 1.0 - math.sqrt(2 * math.pi) / x * lower).otherwise(upper)
    return F.when(statistic.isNotNull(), F.least(F.lit(1.0), F.greatest(F.lit(0.0), p)))


def number_distances(baseline: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, ks, ks_p, wasserstein, baseline_rows, current_rows) of numeric columns.

    ``wasserstein`` is the area between the distribution functions in standard deviations of the baseline, which count as 0.001 at
    least. Nulls and values that are not finite do not count; a column without values on one side has null figures.
    """
    rows = _stacked(baseline, current, columns, "double").where(F.abs("_v") < float("inf"))
    counts = _sides(rows)
    own = F.when(F.col("_side") == 0, F.col("_v"))
    sizes = rows.groupBy("column").agg(
        F.count_if(F.col("_side") == 0).alias("baseline_rows"), F.count_if(F.col("_side") == 1).alias("current_rows"),
        F.greatest(F.coalesce(F.stddev_samp(own), F.lit(0.0)), F.lit(LEAST_STD)).alias("_std"))
    block = F.struct(value_block(F.col("_v")).alias("block"), value_slot(F.col("_v")).alias("slot"))
    # Whole numbers until the end: b rows of the one side weigh as a rows of the other.
    step = F.col("_a") * F.col("current_rows").cast("decimal(19,0)") - F.col("_b") * F.col("baseline_rows").cast("decimal(19,0)")
    walked = counts.join(sizes, "column").where("baseline_rows > 0 and current_rows > 0").withColumn("_step", step)
    walked = running(walked, ["column"], ["_v"], F.col("_step"), "_gap", how="sum", block=block)
    walked = running(walked, ["column"], ["_v"], F.col("_v"), "_last", how="max", block=block, before=True)
    unit = F.col("baseline_rows").cast("double") * F.col("current_rows")
    gap = F.abs(F.col("_gap").cast("double")) / unit
    before = F.abs((F.col("_gap") - F.col("_step")).cast("double")) / unit
    found = walked.groupBy("column").agg(
        F.max(gap).alias("ks"), (F.coalesce(F.sum(before * (F.col("_v") - F.col("_last"))), F.lit(0.0)) / F.first("_std")).alias("wasserstein"))
    return sizes.join(found, "column", "left").select(
        "column", "ks", kolmogorov_p(F.col("ks"), F.col("baseline_rows"), F.col("current_rows")).alias("ks_p"), "wasserstein",
        "baseline_rows", "current_rows")


def upper_gamma(a: float, x: float) -> float:
    """The regularised upper incomplete gamma function: by its series below a + 1, by its continued fraction above."""
    if x <= 0:
        return 1.0
    if math.isinf(x):
        return 0.0
    scale = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:
        term = total = 1 / a
        n = a
        while term > total * 1e-16:
            n += 1
            term *= x / n
            total += term
        return 1 - total * scale
    tiny = 1e-300
    b = x + 1 - a
    c, d = 1 / tiny, 1 / b
    out, i = d, 0
    while True:
        i += 1
        an = i * (a - i)
        b += 2
        d = an * d + b
        d = 1 / (d if abs(d) > tiny else tiny)
        c = b + an / c
        c = c if abs(c) > tiny else tiny
        out *= d * c
        if abs(d * c - 1) < 1e-15:
            return out * scale


def chi_square(baseline: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, chi_square, freedom, chi_square_p) of categorical columns: the current counts against the baseline's shares.

    Null counts as the value ``unknown``. A value that the baseline lacks makes the statistic infinite. A column with one value has
    no degree of freedom and p = 1; one without rows on a side has null figures.
    """
    rows = _stacked(baseline, current, columns, "string").withColumn("_v", F.coalesce("_v", F.lit("unknown")))
    counts = _sides(rows)
    sizes = counts.groupBy("column").agg(F.sum("_a").alias("_n"), F.sum("_b").alias("_m"), F.count("*").alias("_kinds"))
    expected = F.col("_a") * F.col("_m") / F.col("_n")
    part = F.when(F.col("_a") > 0, (F.col("_b") - expected) ** 2 / expected).otherwise(F.lit(float("inf")))
    found = counts.join(sizes, "column").where("_n > 0 and _m > 0").groupBy("column").agg(
        F.sum(part).alias("chi_square"), (F.first("_kinds") - 1).alias("freedom"))

    @F.pandas_udf("double")
    def p_value(statistic: pd.Series, freedom: pd.Series) -> pd.Series:
        return pd.Series([1.0 if k < 1 else upper_gamma(k / 2, x / 2) for x, k in zip(statistic, freedom)], dtype=float)

    tested = found.withColumn("chi_square_p", p_value("chi_square", "freedom"))  # one row per column
    return sizes.select("column").join(tested, "column", "left")


def column_tests(
    baseline: DataFrame, current: DataFrame, numeric: Sequence[str], categorical: Sequence[str], small: int = SMALL_REFERENCE,
) -> DataFrame:
    """(column, test, score, drifted): the test that fits each column's type and the number of baseline rows.

    Up to ``small`` rows: Kolmogorov-Smirnov and chi-square, drifted below a p-value of 0.05. Beyond: normalised Wasserstein
    distance and Jensen-Shannon divergence, drifted from 0.1 on. A column without figures has not drifted.
    """
    few = baseline.agg(F.count("*") <= small).scalar()
    numbers = number_distances(baseline, current, numeric).select(
        "column", F.when(few, F.lit("ks_p")).otherwise(F.lit("wasserstein")).alias("test"),
        F.when(few, F.col("ks_p")).otherwise(F.col("wasserstein")).alias("score"))
    classes = chi_square(baseline, current, categorical).join(
        two_sample_divergence(baseline, current, categorical).select("column", "statistic"), "column", "left").select(
        "column", F.when(few, F.lit("chi_square_p")).otherwise(F.lit("jensen_shannon")).alias("test"),
        F.when(few, F.col("chi_square_p")).otherwise(F.col("statistic")).alias("score"))
    drifted = F.when(few, F.col("score") < P_LIMIT).otherwise(F.col("score") >= DISTANCE_LIMIT)
    return numbers.unionByName(classes).withColumn("drifted", F.coalesce(drifted, F.lit(False)))
