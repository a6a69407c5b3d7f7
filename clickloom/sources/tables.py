"""The given tables, and the behaviour-event view that every job starts from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import prepare

# The nine columns of a behaviour event, as they come over the wire or from a file.
EVENT_COLUMNS = [
    "event_time", "event_type", "product_id", "category_id", "category_code",
    "brand", "price", "user_id", "user_session",
]

RAW_EVENT = T.StructType([T.StructField(c, T.StringType()) for c in EVENT_COLUMNS])

BEHAVIOUR_EVENT = T.StructType([
    T.StructField("event_time", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("category_id", T.StringType()),
    T.StructField("category_code", T.StringType()),
    T.StructField("brand", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("user_session", T.StringType()),
])

# Declared schemas of the given tables: no job has to look into the files first.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def as_behaviour(events: DataFrame) -> DataFrame:
    """The event table as behaviour events, without catalog columns; works on a stream too."""
    return events.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("event_time"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ts_ms"),
        "event_type",
        F.get_json_object("props", "$.k").alias("product_id"),
        F.col("value").alias("price"),
        F.col("user_id").cast("string").alias("user_id"),
    )


def catalog(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_type").alias("category_code"),
        F.col("p_brand").alias("brand"),
        F.col("p_name").alias("product_name"),
        F.col("p_retailprice").alias("list_price"),
    )


def behaviour(spark: SparkSession, folder: str, with_catalog: bool = True) -> DataFrame:
    """Behaviour events; category, brand and name are looked up unless ``with_catalog`` is off.

    The catalog join carries no hint: Spark broadcasts the catalog while its size allows that, and beyond
    it the skew join splits the partitions of hot products.
    """
    events = as_behaviour(table(spark, folder, "events"))
    return with_products(events, catalog(spark, folder)) if with_catalog else events


def with_products(events: DataFrame, products: DataFrame) -> DataFrame:
    """Events, or a stream of them, with the catalog columns of their products."""
    return events.join(products.select("product_id", "category_code", "brand", "product_name"), "product_id", "left")
