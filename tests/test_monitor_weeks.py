"""The drift monitor over weeks of which one has no rows: the figures of its SQL, and only what it looks at is stored."""

import duckdb
import pytest
from compare import compare
from pyspark.sql import functions as F

import __spark_entry__ as entry
from clickloom.sources.files import move_into
from clickloom.sources.tables import SCHEMAS

NAME = "d8_stream_monitor"


@pytest.mark.parametrize("days", [(0, 15, 21), (8, 9, 29)])  # without the second week, and without the first and the third
def test_weeks_of_the_monitor(spark, tmp_path, monkeypatch, days):
    from clickloom.plans import runner_queries

    rows = spark.range(360).select(
        F.col("id").alias("event_id"),
        F.expr(f"to_timestamp_ntz('2024-01-01 00:00:00') + make_dt_interval(array{days}[id % 3], id % 24, 0, id)").alias("ts"),
        F.expr("id % 7").alias("user_id"), F.expr("if(id % 5 = 0, 'view', if(id % 2 = 0, 'click', 'purchase'))").alias("event_type"),
        F.expr("id % 13 + id / 100").alias("value"), F.format_string('{"k": %d}', F.expr("id % 9")).alias("props"))
    parts = spark.range(6).select(
        F.col("id").alias("p_partkey"), F.lit("name").alias("p_name"), F.format_string("b%d", F.expr("id % 2")).alias("p_brand"),
        F.format_string("t%d", F.expr("id % 3")).alias("p_type"), F.lit(1).alias("p_size"), F.lit(1.0).alias("p_retailprice"))
    con = duckdb.connect()
    for name, df in (("events", rows), ("part", parts)):
        df.selectExpr(*[f"cast({c.split()[0]} as {c.split()[1]}) {c.split()[0]}" for c in SCHEMAS[name].split(", ")]).coalesce(
            1).write.parquet(f"{tmp_path}/{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    monkeypatch.setattr(runner_queries, "shared_folder", lambda spark, purpose: f"file://{tmp_path}/{purpose}")
    problem, found, _ = compare(con, spark, str(tmp_path), NAME, entry.queries()[NAME], entry.oracle_sql()[NAME])
    assert problem is None and found == len({day // 7 for day in days})
    stored = spark.read.option("recursiveFileLookup", "true").parquet(f"{tmp_path}/drift-monitor/events")
    assert set(stored.columns) == {"event_time", "price", "event_type", "category_code", "brand"}  # before: all eleven
    assert stored.count() == 360


def test_folder_moved_to_a_stream(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/a")
    assert move_into(spark, f"file://{tmp_path}/a", f"file://{tmp_path}/new/b") and spark.read.parquet(f"{tmp_path}/new/b").count() == 3
    assert not move_into(spark, f"file://{tmp_path}/a", f"file://{tmp_path}/new/c")
