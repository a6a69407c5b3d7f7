"""Sinks (S4-S9): idempotent batch folders, a retry around the write, and a quarantine for failed batches."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..settings import Settings

log = logging.getLogger(__name__)


def with_retries(
    action: Callable[[], None],
    *,
    attempts: int = 5,
    initial_wait: float = 0.5,
    factor: float = 2.0,
    longest_wait: float = 10.0,
    sleep: Callable[[float], None] = time.sleep,
) -> None:
    """Run ``action``, again after growing waits while it fails; the last failure is raised."""
    wait = initial_wait
    for attempt in range(1, attempts + 1):
        try:
            action()
            return
        except Exception as error:  # noqa: BLE001 - any write failure counts
            log.warning("write failed (%d of %d): %s", attempt, attempts, error)
            if attempt == attempts:
                raise
            sleep(min(wait, longest_wait))
            wait *= factor


def batch_folder(path: str, batch_id: int) -> str:
    return f"{path.rstrip('/')}/batch_id={batch_id}"


def write_batch_csv(df: DataFrame, path: str, batch_id: int) -> None:
    """One folder per batch, overwritten when the batch is replayed."""
    df.write.mode("overwrite").option("header", "true").option("escape", '"').csv(batch_folder(path, batch_id))


def write_batch_parquet(df: DataFrame, path: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(batch_folder(path, batch_id))


def as_json(df: DataFrame, name: str = "value") -> DataFrame:
    """Every row as one JSON string."""
    return df.select(F.to_json(F.struct(*df.columns)).alias(name))


def write_topic(df: DataFrame, settings: Settings, checkpoint: str):
    """A stream of JSON strings to the recommendations topic. Needs the Kafka connector."""
    return (
        as_json(df).writeStream.format("kafka")
        .option("kafka.bootstrap.servers", settings.kafka.bootstrap_servers)
        .option("topic", settings.kafka.topics.recommendations)
        .option("checkpointLocation", checkpoint)
        .start()
    )


# Schemas of the two baseline tables.
NUMERIC_BASELINE = (
    "column string, mean double, std double, min double, max double, p5 double, p25 double, p50 double, "
    "p75 double, p95 double"
)
CATEGORICAL_BASELINE = "column string, value string, share double"


def write_baseline(numeric: DataFrame | None, categorical: DataFrame | None, path: str) -> None:
    """The baseline tables as JSON; they hold a row per column and a row per listed value."""
    for name, df in (("numeric", numeric), ("categorical", categorical)):
        if df is not None:
            df.write.mode("overwrite").json(f"{path}/{name}")


def read_numeric_baseline(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(NUMERIC_BASELINE).json(f"{path}/numeric")


def read_categorical_baseline(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CATEGORICAL_BASELINE).json(f"{path}/categorical")
