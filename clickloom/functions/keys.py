"""Key columns and the deterministic score of a user-product pair."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pair_key(user: Column, product: Column, sep: str = ":") -> Column:
    return F.concat_ws(sep, user, product)


def pair_score(user: Column, product: Column) -> Column:
    """A repeatable number in [0, 1) from the pair; null where a part is null."""
    digest = F.substring(F.md5(F.concat(user, F.lit("_"), product)), 1, 8)
    return F.pmod(F.conv(digest, 16, 10).cast("bigint"), F.lit(1000)) / F.lit(1000.0)
