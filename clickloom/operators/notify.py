"""Notifications over time (E6): inhibition as interval algebra, and the schedule of a group's messages.

Alerts are intervals. One sweep over their starts and ends, per receiver and group, keeps two running counts: the alerts that fire
and those that inhibit them. A group is active while the first is above zero and the second is zero, so a critical alert
silences the warnings of its group exactly while both last, and not before or after. Counts run over blocks of time
(``ordered.running``), so a group with a third of all alerts is worked on by many tasks; no alert is joined with another.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .alerts import GROUP_LABELS
from .ordered import DAY_MS, block_start, running

CRITICAL, WARNING, OTHER = "critical-alerts", "warning-alerts", "slack-notifications"
SERIES = ["receiver", *GROUP_LABELS]


@dataclass(frozen=True)
class Timing:
    """Waits of a group's messages in milliseconds, and the receivers that are told when a group is over."""

    group_wait: int = 30_000
    group_interval: int = 300_000
    repeat_interval: int = 14_400_000
    resolved_to: tuple[str, ...] = (OTHER,)

    @property
    def repeat_ticks(self) -> int:
        return -(-self.repeat_interval // self.group_interval)


def receiver_of(severity: Column) -> Column:
    return F.when(severity == "critical", CRITICAL).when(severity == "warning", WARNING).otherwise(OTHER)


def _points(alerts: DataFrame) -> DataFrame:
    """Per receiver, group and time: how the counts of firing and of inhibiting alerts change, and how many alerts start."""
    labels = [F.coalesce(c, F.lit("")).alias(c) for c in GROUP_LABELS]
    receiver = receiver_of(F.col("severity"))
    own = F.struct(receiver.alias("receiver"), F.lit(1).alias("_firing"), F.lit(0).alias("_silent"))
    over = F.struct(F.lit(WARNING).alias("receiver"), F.lit(0).alias("_firing"), F.lit(1).alias("_silent"))
    roles = F.when(receiver == CRITICAL, F.array(own, over)).otherwise(F.array(own))
    edges = F.array(
        F.struct(F.col("start_ms").alias("ts_ms"), F.lit(1).alias("_sign")),
        F.struct(F.col("end_ms").alias("ts_ms"), F.lit(-1).alias("_sign")))
    lasting = alerts.where("start_ms < end_ms").select(*labels, "start_ms", "end_ms", F.explode(roles).alias("_role"))
    rows = lasting.select(*GROUP_LABELS, "_role.*", F.inline(edges))
    return rows.groupBy(*SERIES, "ts_ms").agg(
        F.sum(F.col("_firing") * F.col("_sign")).alias("_d_own"), F.sum(F.col("_silent") * F.col("_sign")).alias("_d_over"),
        F.sum(F.when(F.col("_sign") > 0, F.col("_firing")).otherwise(0)).alias("_new"))


def _swept(alerts: DataFrame, block_ms: int) -> DataFrame:
    """The points with what holds behind them: ``_on``, whether that has just begun or ended, and when it last began."""
    block = block_start(F.col("ts_ms"), block_ms)
    counted = _points(alerts)
    for change, name in (("_d_own", "_firing"), ("_d_over", "_silent")):
        counted = running(counted, SERIES, ["ts_ms"], F.col(change), name, how="sum", block=block)
    after = (F.col("_firing") > 0) & (F.col("_silent") == 0)
    before = (F.col("_firing") - F.col("_d_own") > 0) & (F.col("_silent") - F.col("_d_over") == 0)
    flagged = counted.withColumn("_on", after).withColumn("_was", before)
    begin = F.when(F.col("_on") & ~F.col("_was"), F.col("ts_ms"))
    return running(flagged, SERIES, ["ts_ms"], begin, "active_since_ms", how="max", block=block)


def active_groups(alerts: DataFrame, block_ms: int = DAY_MS) -> DataFrame:
    """(receiver, group, active_since_ms, active_until_ms): when each group has an alert that nothing inhibits.

    ``alerts`` has alertname, cluster, service, severity, start_ms and end_ms (exclusive); an alert that ends when it
    starts never fires. A null label counts as empty.
    """
    return _ended(_swept(alerts, block_ms))


def _ended(swept: DataFrame) -> DataFrame:
    return swept.where(F.col("_was") & ~F.col("_on")).select(
        *SERIES, F.col("active_since_ms"), F.col("ts_ms").alias("active_until_ms"))


def schedule(alerts: DataFrame, timing: Timing = Timing(), block_ms: int = DAY_MS) -> DataFrame:
    """(receiver, group, active_since_ms, sent_ms, kind): the messages of every active time of a group.

    The first goes out after ``group_wait``, and what is due later at steps of ``group_interval``: ``firing`` where alerts have
    joined since, ``repeat`` when the last message is ``repeat_interval`` old, and ``resolved`` at the first step at or after the
    end, to the receivers that want it and only if a message had been sent. Steps are counted from the beginning, so a
    time between two messages of joining alerts has its repeats at fixed distances and needs no walk over steps.
    """
    swept = _swept(alerts, block_ms)
    wait, step, every = timing.group_wait, timing.group_interval, timing.repeat_ticks
    tick_of = lambda at: F.greatest(
        F.lit(0).cast("long"), F.ceil((at - F.col("active_since_ms") - wait) / step))
    time_of = lambda tick: F.col("active_since_ms") + wait + tick * step
    began = F.col("_on") & ((F.col("_new") > 0) | ~F.col("_was"))
    joined = swept.where(began).select(*SERIES, "active_since_ms", tick_of(F.col("ts_ms")).alias("_tick")).distinct()
    ends = _ended(swept).withColumn("_last", tick_of(F.col("active_until_ms")))
    due = joined.join(ends, [*SERIES, "active_since_ms"]).where(time_of(F.col("_tick")) < F.col("active_until_ms"))
    # One row per step at most, so an active time is bounded by how long it lasts, not by its alerts.
    following = F.lead("_tick").over(Window.partitionBy(*SERIES, "active_since_ms").orderBy("_tick"))
    spans = due.withColumn("_next", F.coalesce(following, F.col("_last")))
    ticks = F.sequence(F.col("_tick"), F.greatest(F.col("_tick"), F.col("_next") - 1), F.lit(every).cast("long"))
    sent = spans.select(*SERIES, "active_since_ms", F.col("_tick").alias("_first"), F.explode(ticks).alias("_tick"))
    kind = F.when(F.col("_tick") == F.col("_first"), F.lit("firing")).otherwise(F.lit("repeat"))
    messages = sent.select(*SERIES, "active_since_ms", time_of(F.col("_tick")).alias("sent_ms"), kind.alias("kind"))
    over = due.where((F.col("_tick") == 0) & F.col("receiver").isin(*timing.resolved_to)).select(
        *SERIES, "active_since_ms", time_of(F.col("_last")).alias("sent_ms"), F.lit("resolved").alias("kind"))
    return messages.unionByName(over)
