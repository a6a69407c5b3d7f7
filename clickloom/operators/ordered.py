"""Order-dependent building blocks that never put a whole key into one task.

Each of them cuts a key's timeline into blocks, works inside the blocks in parallel and joins the blocks
with a table that holds one row per block. A key that owns a third of all rows is spread over as many
tasks as it has blocks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOUR_MS = 3_600_000
DAY_MS = 24 * HOUR_MS
# Blocks in a coarse block, where there are two levels.
COARSE_BLOCKS = 1000
# Frames in a block of trailing sums: one row in so many is repeated in the next block.
BLOCK_FRAMES = 8

# Value blocks for exact quantiles: a factor of about 1.6 percent between block edges.
VALUE_BLOCKS_PER_LOG_UNIT = 64
SLOTS_PER_VALUE_BLOCK = 1024


def block_start(position: Column, width: int) -> Column:
    return position - F.pmod(position, F.lit(width))


def _reducers(how: str, order: Sequence[str]):
    """(partial value of a block, aggregate of several values, merge of two values) for a running ``how``."""
    if how == "max":
        return F.max, F.max, F.greatest
    if how == "sum":
        return F.sum, F.sum, lambda a, b: F.when(a.isNull(), b).when(b.isNull(), a).otherwise(a + b)
    if how == "last":
        rank = F.col(order[0]) if len(order) == 1 else F.struct(*order)
        return (
            lambda v: F.max_by(v, F.when(v.isNotNull(), rank)),
            lambda v: F.last(v, ignorenulls=True),
            lambda earlier, own: F.coalesce(own, earlier),
        )
    raise ValueError(f"unknown running aggregate: {how}")


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: Column,
    name: str,
    *,
    how: str,
    block: Column,
    before: bool = False,
    coarse: int | None = None,
) -> DataFrame:
    """Running ``max``, ``sum`` or ``last`` (non-null) of ``value`` per key.

    ``block`` must grow with ``order``. With ``before`` the current row does not count. ``coarse`` is the width of a second
    level of blocks, a multiple of the first one's; without keys one task then takes a row per coarse block, not per block.
    """
    partial, over_blocks, merge = _reducers(how, order)
    rows = df.withColumn("_block", block).withColumn("_value", value)
    all_keys = [*keys, "_block"]
    per_block = rows.groupBy(*all_keys).agg(partial(F.col("_value")).alias("_part"))
    carried = _carried(per_block, list(keys), over_blocks, merge, how, coarse)
    inside = (
        Window.partitionBy(*all_keys).orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1 if before else Window.currentRow)
    )
    return (
        null_safe_left(rows, carried, all_keys)
        .withColumn("_own", over_blocks(F.col("_value")).over(inside))
        .withColumn(name, merge(F.col("_carry"), F.col("_own")))
        .drop("_block", "_value", "_carry", "_own")
    )


def _carried(per_block: DataFrame, keys: list[str], over_blocks, merge, how: str, coarse: int | None) -> DataFrame:
    """keys, ``_block`` and ``_carry``: what the blocks before each one add up to."""

    def ahead(within: list[str], order: str) -> Column:
        earlier = Window.partitionBy(*within).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return over_blocks(F.col("_part")).over(earlier).alias("_carry")

    if coarse is None:
        return per_block.select(*keys, "_block", ahead(keys, "_block"))
    within = [*keys, "_coarse"]
    placed = per_block.withColumn("_coarse", block_start(F.col("_block"), coarse))
    whole = F.max_by("_part", F.when(F.col("_part").isNotNull(), F.col("_block"))) if how == "last" else over_blocks(F.col("_part"))
    far = placed.groupBy(*within).agg(whole.alias("_part")).select(*within, ahead(keys, "_coarse")).withColumnRenamed("_carry", "_far")
    near = placed.select(*within, "_block", ahead(within, "_block"))
    return null_safe_left(near, far, within).select(*keys, "_block", merge(F.col("_far"), F.col("_carry")).alias("_carry"))


def null_safe_left(rows: DataFrame, found: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A left join in which a null key meets a null key."""
    other = found.select(*[F.col(k).alias(f"_key_{k}") for k in keys], *[c for c in found.columns if c not in keys])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_key_{k}"))
    return rows.join(other, same, "left").drop(*[f"_key_{k}" for k in keys])


def finite_parts(name: str, value: Column) -> dict[str, Column]:
    """Measures that keep what is not finite apart from the sum of ``value``."""
    odd = F.isnan(value) | (F.abs(value) == float("inf"))
    flag = lambda c: F.when(c, 1).otherwise(0).cast("long")
    return {
        name: F.when(odd, 0.0).otherwise(value), f"{name}_nan": flag(F.isnan(value)),
        f"{name}_up": flag(value == float("inf")), f"{name}_down": flag(value == float("-inf")),
    }


def finite_total(name: str) -> Column:
    """The sum that the measures of ``finite_parts`` stand for."""
    some = lambda part: F.coalesce(F.col(f"{name}_{part}"), F.lit(0)) > 0
    return (
        F.when(some("nan") | (some("up") & some("down")), float("nan"))
        .when(some("up"), float("inf")).when(some("down"), float("-inf")).otherwise(F.col(name))
    )


def trailing_sums(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    measures: dict[str, Column],
    width: int,
    *,
    block_width: int | None = None,
    include_lower: bool = True,
) -> DataFrame:
    """Sums of ``measures`` over the rows of a key with position in [p - width, p], for every row.

    Each row enters at its position and leaves again just behind the frame, so one running sum over both
    kinds of marks gives the trailing sum: the work is linear however many rows share a frame. Rows close
    to the end of a block are repeated as marks in the next one. ``include_lower=False`` leaves out the
    rows at exactly p - width. Blocks are a few frames wide unless a width is given, so that a hot key has many.
    Measures must be finite, or a sum that left the frame would leave a trace (``finite_parts``).
    """
    block_width = block_width or BLOCK_FRAMES * (width + 1)
    if width >= block_width:
        raise ValueError("the frame must be shorter than a block")
    payload = list(df.columns)
    lifetime = width + 1 if include_lower else width
    at = F.col(position)
    own = block_start(at, block_width)
    nxt = own + F.lit(block_width)

    def mark(block, when, sign, keep):
        return F.struct(
            block.cast("long").alias("_block"), when.cast("long").alias("_at"),
            F.lit(sign).alias("_sign"), F.lit(keep).alias("_keep"),
        )

    leaves = at + F.lit(lifetime)
    marks = F.when(
        leaves < nxt, F.array(mark(own, at, 1, True), mark(own, leaves, -1, False))
    ).otherwise(
        F.array(mark(own, at, 1, True), mark(nxt, at, 1, False), mark(nxt, leaves, -1, False))
    )
    marked = df.select(
        *payload, *[m.alias(f"_m_{n}") for n, m in measures.items()], F.inline(marks)
    )
    marked = marked.select(
        *[F.col(c) if c in keys else F.when(F.col("_keep"), F.col(c)).alias(c) for c in payload],
        *[(F.col(f"_m_{n}") * F.col("_sign")).alias(f"_m_{n}") for n in measures],
        "_block", "_at", "_keep",
    )
    frame = (
        Window.partitionBy(*keys, "_block").orderBy("_at")
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    summed = marked.select(
        *payload, "_keep", *[F.sum(f"_m_{n}").over(frame).alias(n) for n in measures]
    )
    return summed.where("_keep").drop("_keep")


def value_block(value: Column) -> Column:
    """A block number that grows with the value, with a bounded number of blocks over all doubles."""
    return F.floor(F.signum(value) * F.log1p(F.abs(value)) * VALUE_BLOCKS_PER_LOG_UNIT)


def value_slot(value: Column) -> Column:
    """A finer number that grows with the value within its block."""
    place = F.signum(value) * F.log1p(F.abs(value)) * VALUE_BLOCKS_PER_LOG_UNIT
    return F.floor((place - F.floor(place)) * SLOTS_PER_VALUE_BLOCK)


def exact_percentiles(
    df: DataFrame, keys: Sequence[str], value: Column, probabilities: Sequence[float]
) -> DataFrame:
    """Exact percentiles per key in long form: keys, ``p``, ``rows``, ``percentile`` and ``at_position``.

    ``percentile`` is linear between ranks, ``at_position`` is the value at position floor(rows * p).
    Nulls and NaN do not count. Equal values are counted first, then the value blocks that hold the wanted
    ranks are cut into slots, and only the rows of the wanted slots are ordered.
    """
    keys = list(keys)
    counts = (
        df.select(*keys, value.cast("double").alias("_v"))
        .where(F.col("_v").isNotNull() & ~F.isnan("_v"))
        .groupBy(*keys, "_v").agg(F.count("*").alias("_c"))
        .withColumn("_block", value_block(F.col("_v")))
    )
    blocks = _with_ranks(
        counts.groupBy(*keys, "_block").agg(
            F.sum("_c").alias("_c"), F.min("_v").alias("_vmin"), F.max("_v").alias("_vmax")
        ),
        keys, "_block",
    )
    exact = F.col("p") * (F.col("_n") - 1)
    position = F.least(F.floor(F.col("_n") * F.col("p")), F.col("_n") - 1)
    targets = (
        blocks.select("*", F.explode(F.array(*[F.lit(float(p)) for p in probabilities])).alias("p"))
        .select(
            *keys, "_block", "p", "_vmin", "_vmax", "_before", "_c", "_n",
            F.floor(exact).alias("_low"), F.ceil(exact).alias("_high"), position.alias("_position"),
        )
        .where(_holds_any())
        .withColumnsRenamed({"_before": "_base", "_c": "_block_rows"})
    )
    span = F.col("_vmax") - F.col("_vmin")
    slot = F.when(span > 0, F.floor((F.col("_v") - F.col("_vmin")) / span * (SLOTS_PER_VALUE_BLOCK - 1)))
    ranks = ["_low", "_high", "_position"]
    place = [*keys, "p", "_block"]
    candidates = counts.join(targets, [*keys, "_block"]).select(
        *place, "_v", "_c", "_n", "_base", *ranks, F.coalesce(slot, F.lit(0)).alias("_slot")
    )
    slots = _with_ranks(
        candidates.groupBy(*place, "_slot", "_base", *ranks).agg(F.sum("_c").alias("_c")),
        place, "_slot", base=F.col("_base"),
    ).where(_holds_any()).select(*place, "_slot", F.col("_before").alias("_slot_base"))
    ranked = _with_ranks(
        candidates.withColumnRenamed("_n", "_rows").join(slots, [*place, "_slot"]),
        [*place, "_slot"], "_v", base=F.col("_slot_base"),
    )
    at = lambda rank: F.max(F.when(_holds(rank), F.col("_v")))
    share = F.first("p") * (F.max("_rows") - 1) - F.max("_low")
    return ranked.groupBy(*keys, "p").agg(
        F.max("_rows").alias("rows"),
        (at("_low") + (at("_high") - at("_low")) * share).alias("percentile"),
        at("_position").alias("at_position"),
    )


def _with_ranks(counts: DataFrame, keys: Sequence[str], order: str, base: Column | None = None) -> DataFrame:
    """Add ``_before``, the rows ahead of each counted row, and ``_n``, the rows of its key."""
    whole = Window.partitionBy(*keys)
    upto = whole.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = F.sum("_c").over(upto) - F.col("_c")
    return counts.withColumn("_before", before if base is None else base + before).withColumn(
        "_n", F.sum("_c").over(whole)
    )


def _holds(rank: str) -> Column:
    return (F.col(rank) >= F.col("_before")) & (F.col(rank) < F.col("_before") + F.col("_c"))


def _holds_any() -> Column:
    return _holds("_low") | _holds("_high") | _holds("_position")


def percentile_columns(
    long: DataFrame, keys: Sequence[str], names: dict[float, str], positions: dict[float, str] | None = None
) -> DataFrame:
    """The long form of ``exact_percentiles`` with one column per name, and ``rows``."""
    pick = lambda column, p, name: F.max(F.when(F.col("p") == F.lit(p), F.col(column))).alias(name)
    return long.groupBy(*keys).agg(
        *[pick("percentile", p, n) for p, n in names.items()],
        *[pick("at_position", p, n) for p, n in (positions or {}).items()],
        F.max("rows").alias("rows"),
    )


def top_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column], limit: int, rank: str = "rank") -> DataFrame:
    """The first ``limit`` rows per key; Spark cuts each map task to ``limit`` rows before the shuffle."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= limit)
