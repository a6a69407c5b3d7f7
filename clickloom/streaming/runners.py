"""Streaming jobs: sources, an operator, and a sink that survives replays.

Every runner takes a checkpoint folder; a restarted job goes on from the offsets stored there, and batches
that are repeated overwrite their own folders.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.activity import counts_by, top_by_count
from ..operators.drift import CATEGORICAL, batch_overview, drift_parts, drift_totals
from ..operators.intake import dead_letters, valid_rows, with_error
from ..operators.profiles import PROFILE_LIMIT, window_profiles
from ..operators.recommend import (
    CACHE_LIST_MS, FALLBACK_LIMIT, cold_start, enrich, filter_and_rank, personalized,
)
from ..session import prepare_streaming, stored
from ..settings import Settings
from ..sources.files import stream_raw_csv
from ..sources.sinks import as_json, with_retries, write_batch_csv, write_batch_parquet
from ..sources.tables import EVENT_COLUMNS
from .processors import PROFILE_OUTPUT, MergedProfiles, keyed

def start_batches(
    stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, *,
    mode: str = "append", interval: str | None = None, partitions: int | None = None, conf: dict[str, str] | None = None,
) -> StreamingQuery:
    """Run ``write`` per micro-batch; without ``interval`` the query takes what is there and ends.

    ``partitions`` bounds the shuffle partitions of the query, each of which commits its state in every micro-batch. A session
    sized for the whole table has many more than a micro-batch needs. A checkpoint keeps the number that it began with. ``conf`` has
    further options of the session that only this query gets.
    """
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(write)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    session, name, wanted = stream.sparkSession.conf, "spark.sql.shuffle.partitions", dict(conf or {})
    if partitions is not None and int(session.get(name)) > partitions:
        wanted[name] = str(partitions)
    usual = {k: session.get(k, None) for k in wanted}
    for k, v in wanted.items():
        session.set(k, v)  # a query takes the options over when it starts
    try:
        return writer.start()
    finally:
        for k, v in usual.items():
            session.unset(k) if v is None else session.set(k, v)


def trigger_interval(settings: Settings) -> str:
    """How often a long-running query commits."""
    return f"{settings.recovery.checkpoint_interval} milliseconds"


def run_restarting(start: Callable[[], StreamingQuery], settings: Settings = Settings(), **retry) -> None:
    """Run a query to its end and start it again after a failure, a fixed number of times and waits."""
    recovery = settings.recovery
    with_retries(
        lambda: start().awaitTermination(), attempts=recovery.restart_attempts + 1,
        **{"initial_wait": recovery.restart_delay / 1000.0, "factor": 1.0, **retry},
    )


def start_table(stream: DataFrame, path: str, checkpoint: str, **options) -> StreamingQuery:
    """Append a stream to a folder of Parquet batches."""
    return start_batches(stream, lambda df, batch: write_batch_parquet(df, path, batch), checkpoint, **options)


def start_clean_csv(
    spark: SparkSession, source: str, clean: str, rejected: str, checkpoint: str, *,
    per_trigger: dict | None = None, interval: str | None = None,
    write_clean: Callable[[DataFrame, str, int], None] = write_batch_csv, retry: dict | None = None,
) -> StreamingQuery:
    """CSV files in, clean rows and dead letters out.

    A batch whose clean rows cannot be written after all attempts goes to the dead letters as a whole.
    The progress of the query carries the counts as observed metrics named "intake".
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        checked = batch.persist()
        try:
            rejects = dead_letters(checked).select(*EVENT_COLUMNS, "error")
            good = valid_rows(checked).select(*EVENT_COLUMNS)
            try:
                with_retries(lambda: write_clean(good, clean, batch_id), **(retry or {}))
            except Exception as error:  # noqa: BLE001 - any sink failure
                failed = checked.where(F.col("error").isNull()).select(
                    *EVENT_COLUMNS, F.lit(f"sink_failure: {error}").alias("error")
                )
                rejects = rejects.unionByName(failed)
            write_batch_csv(rejects, rejected, batch_id)
        finally:
            checked.unpersist()

    stream = with_error(stream_raw_csv(prepare_streaming(spark), source, per_trigger=per_trigger)).observe(
        "intake", F.count(F.lit(1)).alias("processed"), F.count_if(F.col("error").isNull()).alias("valid"),
        F.count("error").alias("rejected"),
    )
    return start_batches(stream, write, checkpoint, interval=interval)


def profile_stream(events: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Profiles of closed windows."""
    options = settings.processing
    watermarked = events.withWatermark("event_time", f"{options.watermark_delay_seconds} seconds")
    return window_profiles(watermarked, options.window_size_minutes)


def start_split(
    classified: DataFrame, path: str, checkpoint: str, classes: Sequence[str], column: str = "late_class", **options
) -> StreamingQuery:
    """Each class of a classified stream to its own folder."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for name in classes:
                write_batch_parquet(batch.where(F.col(column) == name), f"{path}/{name}", batch_id)
        finally:
            batch.unpersist()

    return start_batches(classified, write, checkpoint, **options)


# What the monitor looks at; other columns of a micro-batch are not kept.
MONITORED = ("event_time", "price", *CATEGORICAL)


def start_drift_monitor(
    events: DataFrame, numeric: DataFrame, categorical: DataFrame, history: str, checkpoint: str, *,
    now: Column | None = None, **options,
) -> StreamingQuery:
    """Figures of every micro-batch, appended to a history table.

    Drift, prices, late rows, counts by event type and of the most frequent categories, the time, and the rows processed
    so far, which are those of the batches before it in the table; a batch that is repeated gives the same total.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.select(*MONITORED, F.lit(batch_id).cast("long").alias("batch_id")).persist()
        try:
            batch.count()  # the figures come from jobs at one time, each of which would read the files again
            keys = ["batch_id"]
            parts = drift_parts(batch, numeric, categorical, keys)
            overview = batch_overview(batch, keys, now).select(
                "batch_id", "late_events", "mean", "std", "min", "max", "count", "last_event"
            )
            counts = batch.select("batch_id").distinct()
            for name, counted in (
                ("event_types", counts_by(batch, keys, "event_type").withColumnRenamed("event_type", "value")),
                ("categories", top_by_count(batch, "category_code", keys=keys).withColumnRenamed("category_code", "value")),
            ):
                listed = F.sort_array(F.collect_list(F.struct("value", "events")))
                counts = counts.join(counted.groupBy("batch_id").agg(listed.alias(name)), "batch_id", "left")
            before = 0
            if batch_id:
                known = batch.sparkSession.read.option("mergeSchema", "false").parquet(history)
                before = known.where(F.col("batch_id") < batch_id).agg(F.sum("batch_size")).first()[0] or 0
            row = drift_totals(parts, keys).join(overview, "batch_id").join(counts, "batch_id").select(
                "*", F.current_timestamp().alias("timestamp"), (F.col("batch_size") + before).alias("processed_total"))
            write_batch_parquet(row.drop("batch_id"), history, batch_id)
        finally:
            batch.unpersist()

    return start_batches(events, write, checkpoint, **options)


def start_json_files(stream: DataFrame, path: str, checkpoint: str, **options) -> StreamingQuery:
    """Recommendations as lines of JSON."""
    return start_batches(
        stream, lambda df, batch: as_json(df).write.mode("overwrite").text(f"{path.rstrip('/')}/batch_id={batch}"),
        checkpoint, **options,
    )


def lists_for_profiles(
    profiles: DataFrame, products: DataFrame, ranked: DataFrame, generic: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """R1-R3, T1, J1 for profiles that each name their route: the ranked list of every profile.

    ``ranked`` comes from ``ranked_products``, ``generic`` from ``cold_start_products``. A profile for which no list can
    be made gets the fallback list.
    """
    # A user may have several profiles, so the operators work on a key of user and window.
    keyed_profiles = profiles.withColumn("_user", F.col("user_id")).withColumn(
        "user_id", F.concat_ws("|", "_user", F.col("window_start_ms").cast("string"))
    )
    personal = keyed_profiles.where("route = 'personalized'")
    bought = personal.select("user_id", F.explode("purchased_products").alias("product_id"))
    counts = bought.join(products.select("product_id", "category_code"), "product_id").groupBy(
        "user_id", "category_code"
    ).agg(F.count("*").alias("bought_count"))
    interests = (
        personal.select("user_id", F.explode("categories_preferred").alias("category_code"))
        .join(counts, ["user_id", "category_code"], "left").fillna(0, ["bought_count"])
    )
    cold = cold_start(keyed_profiles.where("route = 'cold_start'").select("user_id"), generic)
    made = cold.unionByName(personalized(interests, bought, ranked, PROFILE_LIMIT))
    options = settings.recommendation
    best = filter_and_rank(made, min_score=options.min_score, max_count=options.max_count)
    without = keyed_profiles.select("user_id").join(best.select("user_id").distinct(), "user_id", "left_anti")
    fallback = cold_start(without, generic, "fallback").where(F.col("position") < FALLBACK_LIMIT)
    best = best.unionByName(filter_and_rank(fallback, min_score=0.0, max_count=FALLBACK_LIMIT))
    named = best.join(
        keyed_profiles.select("user_id", "_user", "window_start_ms", "generated_at_ms"), "user_id"
    ).drop("user_id", "position").withColumnRenamed("_user", "user_id")
    return enrich(named, products, F.col("generated_at_ms"))


def start_recommendations(
    events: DataFrame, products: DataFrame, ranked: DataFrame, generic: DataFrame, path: str, checkpoint: str, *,
    settings: Settings = Settings(), list_ms: int = CACHE_LIST_MS, **options,
) -> StreamingQuery:
    """Profiles of closed windows, their merge per user (X6), and a list per profile as JSON.

    A list that is still young is made again from the same stored profile, which gives the same list. The ranked and the
    generic products are stored once when the query starts, so micro-batches read a table and not the history of events.
    A batch that fails ends the query, which then repeats it.
    """
    ranked, generic = stored(ranked, "ranked"), stored(generic, "generic")
    merged = keyed(profile_stream(events, settings), "user_id", MergedProfiles(list_ms), PROFILE_OUTPUT)

    def write_json(df: DataFrame, batch_id: int) -> None:
        as_json(df).write.mode("overwrite").text(f"{path.rstrip('/')}/batch_id={batch_id}")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            write_json(lists_for_profiles(batch, products, ranked, generic, settings), batch_id)
        finally:
            batch.unpersist()

    return start_batches(merged, write, checkpoint, **options)
