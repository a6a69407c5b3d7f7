"""Validation, quarantine and projections of incoming rows (2.2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import is_number, to_number
from ..sources.tables import EVENT_COLUMNS


def _quoted(text: Column) -> Column:
    """The text in quotes, the way the parse error names it."""
    plain = F.concat(F.lit("'"), text, F.lit("'"))
    return F.when(
        text.contains("'") & ~text.contains('"'), F.concat(F.lit('"'), text, F.lit('"'))
    ).otherwise(plain)


def with_error(rows: DataFrame, field_limit: int | None = None) -> DataFrame:
    """Add ``error``, the first rule a raw row breaks, or null. Fields may have any length unless a limit is given."""
    price = F.col("price")
    blank = lambda name: F.col(name).isNull() | (F.col(name) == "")
    too_long = F.lit(False)
    if field_limit is not None:
        too_long = F.greatest(*[F.coalesce(F.length(c), F.lit(0)) for c in EVENT_COLUMNS]) > field_limit
    filled = price.isNotNull() & (price != "")
    return rows.withColumn(
        "error",
        F.when(too_long, F.lit(f"csv_parse_error: field larger than field limit ({field_limit})"))
        .when(blank("event_time"), F.lit("missing event_time"))
        .when(
            filled & ~is_number(price),
            F.concat(F.lit("parse error: could not convert string to float: "), _quoted(price)),
        )
        .when(filled & (to_number(price) < 0), F.lit("negative price"))
        .when(blank("user_id"), F.lit("missing user_id")),
    )


def valid_rows(checked: DataFrame) -> DataFrame:
    """The clean side, price as a double."""
    return checked.where(F.col("error").isNull()).withColumn("price", to_number(F.col("price"))).drop("error")


def dead_letters(checked: DataFrame) -> DataFrame:
    """The rejected side, original text plus the error."""
    return checked.where(F.col("error").isNotNull())


def intake_counts(checked: DataFrame) -> DataFrame:
    """Processed, valid and rejected rows in one pass."""
    return checked.agg(
        F.count("*").alias("processed"),
        F.count_if(F.col("error").isNull()).alias("valid"),
        F.count_if(F.col("error").isNotNull()).alias("rejected"),
    )


def unknown_if_null(column: str) -> Column:
    """P5"""
    return F.coalesce(F.col(column), F.lit("unknown"))


def late_by_clock(event_time: str, now: Column, hours: int = 1) -> Column:
    """Older than ``hours`` before ``now``."""
    return F.col(event_time) < now - F.expr(f"interval {hours} hours")


def moderate_metadata(delay_seconds: Column, ts_ms: Column, processed_ms: Column) -> Column:
    """What late handling adds to an event that still counts."""
    return F.create_map(
        F.lit("late_processed"), F.lit("true"),
        F.lit("delay_seconds"), delay_seconds.cast("string"),
        F.lit("original_timestamp"), ts_ms.cast("string"),
        F.lit("processed_timestamp"), processed_ms.cast("string"),
    )


def very_late_metadata(delay_seconds: Column) -> Column:
    """What it adds to an event that no window takes any more."""
    return F.create_map(
        F.lit("very_late"), F.lit("true"),
        F.lit("discarded_from_windows"), F.lit("true"),
        F.lit("delay_seconds"), delay_seconds.cast("string"),
    )
