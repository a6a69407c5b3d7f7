"""File and topic sources in batch and streaming form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numbers import to_number
from ..session import prepare
from ..settings import Settings
from .tables import BEHAVIOUR_EVENT, RAW_EVENT

# How much a micro-batch takes. The rows of one key in one micro-batch are handled by one task, so this also
# bounds what a hot key can bring to it.
PER_TRIGGER = {"maxBytesPerTrigger": str(4 * 1024**3)}

CSV_OPTIONS = {
    "header": "true",
    "mode": "PERMISSIVE",
    "multiLine": "false",
    "escape": '"',
    "enforceSchema": "true",
}


def read_raw_csv(spark: SparkSession, path: str, schema: T.StructType = RAW_EVENT) -> DataFrame:
    """Every physical line is a record; short lines leave nulls, surplus values are dropped."""
    return prepare(spark).read.schema(schema).options(**CSV_OPTIONS).csv(path)


def stream_raw_csv(
    spark: SparkSession, path: str, schema: T.StructType = RAW_EVENT, per_trigger: dict | None = None
) -> DataFrame:
    options = {**CSV_OPTIONS, **(per_trigger or PER_TRIGGER)}
    return prepare(spark).readStream.schema(schema).options(**options).csv(path)


def parse_csv_lines(lines: DataFrame, line: str = "value", schema: T.StructType = RAW_EVENT) -> DataFrame:
    """S2 for lines that arrive as text, such as a topic of CSV records."""
    fields = F.from_csv(F.col(line), schema.simpleString()[len("struct<"):-1].replace(":", " "),
                        {"mode": "PERMISSIVE", "escape": '"'})
    return lines.withColumn("_row", fields).select(*[c for c in lines.columns if c != line], "_row.*")


def parse_json_events(records: DataFrame, payload: str = "value") -> DataFrame:
    """JSON records as ``event``; null where the record does not parse or is no object."""
    parsed = F.from_json(
        F.col(payload).cast("string"),
        T.StructType([*BEHAVIOUR_EVENT.fields, T.StructField("_bad", T.StringType())]),
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"},
    )
    return records.withColumn("_parsed", parsed).withColumn(
        "event",
        F.when(
            F.col("_parsed").isNotNull() & F.col("_parsed._bad").isNull(),
            F.struct(*[F.col(f"_parsed.{f.name}").alias(f.name) for f in BEHAVIOUR_EVENT.fields]),
        ),
    ).drop("_parsed")


def stream_topic(spark: SparkSession, settings: Settings) -> DataFrame:
    """The behaviour topic. Needs the Kafka connector on the cluster's class path."""
    return (
        prepare(spark).readStream.format("kafka")
        .option("kafka.bootstrap.servers", settings.kafka.bootstrap_servers)
        .option("subscribe", settings.kafka.topics.input)
        .option("maxOffsetsPerTrigger", settings.kafka.max_records_per_trigger)
        .load()
    )


def stream_json_files(spark: SparkSession, path: str, per_trigger: dict | None = None) -> DataFrame:
    """S1 from files: the lines of new files in a folder, in a column named ``value``."""
    return prepare(spark).readStream.options(**(per_trigger or PER_TRIGGER)).text(path)


def stream_events(
    spark: SparkSession, path: str, schema: T.StructType | str, per_trigger: dict | None = None,
) -> DataFrame:
    """The event table at ``path`` as a stream, be it one file or a folder of part files.

    A stream takes a plain path for a folder, so the path is written as a pattern that only it matches.
    """
    path = path.rstrip("/")
    only = f"{path[:-1]}[{path[-1]}]"
    return prepare(spark).readStream.schema(schema).options(**(per_trigger or PER_TRIGGER)).parquet(only)


def age_in_order(spark: SparkSession, path: str) -> None:
    """Give the files of one write modification times in the order of their names, which is that of its partitions.

    A file stream takes files by their age. The times lie a millisecond apart and end at that of the newest file, so none is
    too old to be read. A store that keeps no times of its files is an error, as the stream would be in any order.
    """
    make = spark._jvm.org.apache.hadoop.fs.Path
    folder = make(path)
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    listed = lambda: sorted(
        (status.getPath().toString(), status.getModificationTime()) for status in store.listStatus(folder)
        if status.getPath().getName().startswith("part-"))
    found = listed()
    newest = max((at for _, at in found), default=0)
    wanted = [(name, newest - len(found) + 1 + i) for i, (name, _) in enumerate(found)]
    for name, at in wanted:
        store.setTimes(make(name), at, -1)
    if listed() != wanted:
        raise OSError(f"{path}: modification times of files cannot be set here")


def move_into(spark: SparkSession, source: str, target: str) -> bool:
    """Move a written folder to where a stream looks for it, so that its files appear at once; false where there is none."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    store = make(source).getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(make(source)):
        return False
    store.mkdirs(make(target).getParent())
    if not store.rename(make(source), make(target)):
        raise OSError(f"{source} cannot be moved to {target}")
    return True


def first_rows(df: DataFrame, order: list[Column], count: int, price: str = "price") -> DataFrame:
    """S3: the first ``count`` rows of a source as drift baseline, the price read as a number or null."""
    typed = df if dict(df.dtypes)[price] == "double" else df.withColumn(price, to_number(F.col(price)))
    return typed.orderBy(*order).limit(count)
