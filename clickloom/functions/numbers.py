"""Number columns: text to double by the rules of the source data, divisions that never raise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What the source data may hold as a number. Digits may be grouped with single underscores.
DECIMAL = r"^[+-]?([0-9](_?[0-9])*(\.([0-9](_?[0-9])*)?)?|\.[0-9](_?[0-9])*)([eE][+-]?[0-9](_?[0-9])*)?$"
SPECIAL = r"^[+-]?(?i:inf|infinity|nan)$"


def _stripped(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def is_number(text: Column) -> Column:
    """Whether the text reads as a floating point number."""
    core = _stripped(text)
    return core.rlike(DECIMAL) | core.rlike(SPECIAL)


def to_number(text: Column) -> Column:
    """The text as a double, null where it is no number; takes nan, inf and grouped digits."""
    core = _stripped(text)
    special = F.when(F.lower(core).contains("nan"), F.lit(float("nan"))).when(
        core.startswith("-"), F.lit(float("-inf"))
    ).otherwise(F.lit(float("inf")))
    plain = F.regexp_replace(core, "_", "").try_cast("double")
    return F.when(core.rlike(DECIMAL), plain).when(core.rlike(SPECIAL), special)


def ratio(numerator: Column, denominator: Column, default: float = 0.0) -> Column:
    """numerator / denominator, ``default`` where the denominator is zero or null."""
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(default))


def clamp(value: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.greatest(F.least(value, F.lit(high)), F.lit(low))
