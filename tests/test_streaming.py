"""Streams against their batch form, restarts, retries and dead letters."""

import csv
import random

import pytest
from pyspark.sql import functions as F

from clickloom.operators.activity import trailing_activity
from clickloom.operators.late import classify_late
from clickloom.operators.profiles import running_profiles, window_profiles
from clickloom.operators.sessions import session_summary, sessionize
from clickloom.settings import Settings, load_settings, merge_settings
from clickloom.sources.sinks import as_json, with_retries
from clickloom.sources.tables import EVENT_COLUMNS, as_behaviour, table
from clickloom.streaming.processors import (
    ACTIVITY_OUTPUT, LATE_OUTPUT, SESSION_OUTPUT, SESSION_STATE_MS, CappedSessions, LateClasses, TrailingActivity,
    keyed,
)
from clickloom.streaming.runners import (
    profile_stream, run_restarting, start_batches, start_clean_csv, start_drift_monitor, start_json_files, start_table, trigger_interval,
)

SMALL = "/root/testdata/sf0.001"
ONE_FILE = {"maxFilesPerTrigger": "1"}
KEPT = "event_id long, user_id string, event_type string, product_id string, ts_ms long, arrival_ms long, shard long, " \
       "category_id string, category_code string, event_time timestamp"


def events(spark):
    return as_behaviour(table(spark, SMALL, "events")).select(
        "event_id", "user_id", "event_type", "product_id", "ts_ms",
        (F.col("ts_ms") + F.pmod(F.col("event_id") * 7919, F.lit(2_400_000))).alias("arrival_ms"),
        F.pmod(F.col("user_id").cast("long"), F.lit(3)).alias("shard"),
        F.concat(F.lit("c"), F.pmod("event_id", F.lit(7))).alias("category_id"),
        F.lit(None).cast("string").alias("category_code"), "event_time",
    )


def split(df, path, order, files):
    """The rows in order over several files; the stream reads them one by one."""
    rows = df.orderBy(*order).collect()
    cuts = sorted(random.Random(files).sample(range(1, len(rows)), files - 1))
    for i, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(rows)])):
        part = df.sparkSession.createDataFrame(rows[a:b], df.schema).coalesce(1)
        part.write.mode("append").parquet(f"{path}")
    return df.sparkSession.readStream.schema(KEPT).options(**ONE_FILE).parquet(f"{path}")


def finish(stream, tmp_path, spark):
    start_table(stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{tmp_path}/out").select(*stream.columns)


def same(a, b):
    assert sorted(a.columns) == sorted(b.columns)
    rows = lambda d: sorted(map(str, (r.asDict() for r in d.select(*sorted(d.columns)).collect())))
    assert rows(a) == rows(b)


@pytest.mark.parametrize("files", [2, 5])
def test_late_classes(spark, tmp_path, files):
    stream = split(events(spark), f"{tmp_path}/in", ["arrival_ms", "event_id"], files)
    got = finish(keyed(stream, "shard", LateClasses(), LATE_OUTPUT), tmp_path, spark).drop("delay_seconds")
    want = classify_late(events(spark)).select(*got.columns)
    same(got, want)


def test_sessions(spark, tmp_path):
    stream = split(events(spark), f"{tmp_path}/in", ["ts_ms", "event_id"], 4)
    got = finish(keyed(stream, "user_id", CappedSessions(), SESSION_OUTPUT), tmp_path, spark)
    same(got, session_summary(sessionize(events(spark))).where("closed").select(*got.columns))


def test_trailing_activity(spark, tmp_path):
    width = 3_600_000 // 2
    stream = split(events(spark), f"{tmp_path}/in", ["ts_ms", "event_id"], 3)
    got = finish(keyed(stream, "user_id", TrailingActivity(width), ACTIVITY_OUTPUT), tmp_path, spark)
    kinds = ["click", "error", "purchase", "signup", "view"]
    want = trailing_activity(events(spark), kinds, width).select(*got.columns)
    plain = lambda d: d.withColumn("event_type_counts", F.to_json(F.array_sort(F.map_entries("event_type_counts"))))
    same(plain(got), plain(want))


def test_windows_and_restart(spark, tmp_path):
    """A stopped job goes on where it was: no window is lost and none is written twice."""
    source, out, checkpoint = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/checkpoint"
    rows = events(spark).orderBy("ts_ms").collect()
    schema = events(spark).schema
    for part in (rows[:400], rows[400:650]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(source)
    stream = lambda: profile_stream(spark.readStream.schema(KEPT).options(**ONE_FILE).parquet(source))
    start_table(stream(), out, checkpoint).awaitTermination()
    first = spark.read.parquet(out).count()
    spark.createDataFrame(rows[650:], schema).coalesce(1).write.mode("append").parquet(source)
    start_table(stream(), out, checkpoint).awaitTermination()
    got = spark.read.parquet(out).drop("batch_id")
    last = events(spark).agg(F.max("ts_ms")).first()[0]
    want = window_profiles(events(spark)).where(F.col("window_start_ms") + 600_000 <= last - 5000)
    assert 0 < first < got.count()
    same(got, want.select(*got.columns))


HEADER = ",".join(EVENT_COLUMNS)


def csv_file(path, start, count):
    with open(path, "w", encoding="utf-8") as out:
        out.write(HEADER + "\n")
        for i in range(start, start + count):
            price = {3: "abc", 5: "-1", 7: ""}.get(i % 10, f"{i}.5")
            user = "" if i % 10 == 9 else f"u{i}"
            out.write(f'2024-01-01T00:00:{i % 60:02d}Z,view,p{i},1,"a,b",brand,{price},{user},s\n')


def test_clean_csv(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    csv_file(source / "a.csv", 0, 50)
    run = lambda **k: start_clean_csv(
        spark, str(source), f"{tmp_path}/clean", f"{tmp_path}/dead", f"{tmp_path}/checkpoint", per_trigger=ONE_FILE, **k
    ).awaitTermination()
    first = start_clean_csv(spark, str(source), f"{tmp_path}/clean", f"{tmp_path}/dead", f"{tmp_path}/checkpoint")
    first.awaitTermination()
    seen = [p["observedMetrics"]["intake"] for p in first.recentProgress if p["observedMetrics"]]
    assert [(m["processed"], m["valid"], m["rejected"]) for m in seen if m["processed"]] == [(50, 35, 15)]
    csv_file(source / "b.csv", 50, 30)
    run()
    run()
    read = lambda name: spark.read.option("header", True).option("escape", '"').csv(f"{tmp_path}/{name}")
    clean, dead = read("clean"), read("dead")
    assert clean.count() == 56 and dead.count() == 24
    assert clean.select("product_id").distinct().count() == 56
    assert clean.where("product_id = 'p7'").first()["price"] is None
    assert clean.first()["category_code"] == "a,b"
    assert {r["error"] for r in dead.collect()} == {
        "parse error: could not convert string to float: 'abc'", "negative price", "missing user_id"
    }
    assert [c for c in dead.columns if c != "batch_id"] == [*EVENT_COLUMNS, "error"]


def test_failed_batches_are_quarantined(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    csv_file(source / "a.csv", 0, 10)
    calls, waits = [], []

    def broken(df, path, batch_id):
        calls.append(batch_id)
        raise OSError("disk full")

    start_clean_csv(
        spark, str(source), f"{tmp_path}/clean", f"{tmp_path}/dead", f"{tmp_path}/checkpoint",
        write_clean=broken, retry={"sleep": waits.append},
    ).awaitTermination()
    assert len(calls) == 5 and waits == [0.5, 1.0, 2.0, 4.0]
    with_errors = spark.read.option("header", True).csv(f"{tmp_path}/dead")
    assert with_errors.count() == 10 and with_errors.where("error = 'sink_failure: disk full'").count() == 7


def test_retry_waits():
    waits, tries = [], []

    def third_time():
        tries.append(1)
        if len(tries) < 7:
            raise ValueError("not yet")

    with_retries(third_time, attempts=8, sleep=waits.append)
    assert waits == [0.5, 1.0, 2.0, 4.0, 8.0, 10.0]
    with pytest.raises(ValueError):
        with_retries(lambda: (_ for _ in ()).throw(ValueError("x")), attempts=2, sleep=waits.append)


def test_restarts(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    csv_file(source / "a.csv", 0, 10)
    stream = lambda: spark.readStream.text(str(source))
    calls, waits = [], []

    def fails_twice(df, batch_id):
        calls.append(df.count())
        if len(calls) < 3:
            raise OSError("no space")

    run_restarting(lambda: start_batches(stream(), fails_twice, f"{tmp_path}/checkpoint"), sleep=waits.append)
    assert calls == [11, 11, 11] and waits == [10.0, 10.0]
    assert trigger_interval(Settings()) == "1000 milliseconds"


def test_session_lifetime(spark, tmp_path):
    hour = 3_600_000
    rows = [(i, "u", "view", "p", t, t, 0, "c", None) for i, t in enumerate([0, 60_000, 3 * hour, 3 * hour + 1, 4 * hour])]
    df = spark.createDataFrame(rows, KEPT.replace(", event_time timestamp", "")).withColumn(
        "event_time", F.timestamp_millis("ts_ms"))
    stream = split(df, f"{tmp_path}/in", ["ts_ms"], 2)
    got = finish(keyed(stream, "user_id", CappedSessions(lifetime_ms=SESSION_STATE_MS), SESSION_OUTPUT), tmp_path, spark)
    assert [(r["start_time"], r["last_update"], r["event_count"]) for r in got.collect()] == [(3 * hour, 4 * hour, 3)]


def test_drift_monitor(spark, tmp_path):
    from clickloom.operators.drift import categorical_baseline, numeric_baseline
    from clickloom.sources.sinks import read_categorical_baseline, read_numeric_baseline, write_baseline

    whole = as_behaviour(table(spark, SMALL, "events")).withColumn("category_code", F.lit("c")).withColumn("brand", F.lit("b"))
    write_baseline(numeric_baseline(whole), categorical_baseline(whole), f"{tmp_path}/base")
    for a, b in ((0, 500), (500, 980), (980, 1000)):
        whole.where(F.col("event_id").between(a, b - 1)).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(whole.schema).options(**ONE_FILE).parquet(f"{tmp_path}/in")
    now = F.lit("2024-02-01").cast("timestamp")
    start_drift_monitor(
        stream, read_numeric_baseline(spark, f"{tmp_path}/base"), read_categorical_baseline(spark, f"{tmp_path}/base"),
        f"{tmp_path}/history", f"{tmp_path}/checkpoint", now=now,
    ).awaitTermination()
    rows = {r["batch_size"]: r for r in spark.read.parquet(f"{tmp_path}/history").collect()}
    assert set(rows) == {500, 480, 20}
    assert rows[20]["drift_score"] is None and 0 < rows[500]["drift_score"] < 0.5
    assert rows[500]["late_events"] == 500 and rows[480]["count"] == 480
    assert {n: r["processed_total"] for n, r in rows.items()} == {500: 500, 480: 980, 20: 1000}
    assert sum(t["events"] for t in rows[500]["event_types"]) == 500
    assert [tuple(c) for c in rows[20]["categories"]] == [("c", 20)] and rows[20]["timestamp"] is not None


def test_json_sink(spark, tmp_path):
    df = spark.createDataFrame([("u", 0.5)], "user_id string, score double")
    df.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in")
    start_json_files(stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint").awaitTermination()
    assert spark.read.text(f"{tmp_path}/out").first()["value"] == '{"user_id":"u","score":0.5}'
    assert as_json(df).first()["value"] == '{"user_id":"u","score":0.5}'


@pytest.mark.parametrize("broken", [False, True])
def test_recommendation_stream(spark, tmp_path, broken):
    from clickloom.operators.activity import product_scores
    from clickloom.operators.recommend import cold_start_list, ranked_products
    from clickloom.sources.tables import behaviour, catalog
    from clickloom.streaming.runners import start_recommendations

    whole = behaviour(spark, SMALL)
    products = catalog(spark, SMALL)
    ranked = ranked_products(product_scores(whole), products)
    generic = cold_start_list(whole, F.lit(1_706_000_000_000), 20)
    parts = whole.select("event_id", "user_id", "event_type", "product_id", "ts_ms", "category_code", "event_time")
    for low, high in ((0, 600), (600, 1000)):
        parts.where(F.col("event_id").between(low, high - 1)).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(parts.schema).options(**ONE_FILE).parquet(f"{tmp_path}/in")
    if broken:
        products = products.withColumn("list_price", F.raise_error(F.lit("no catalog")).cast("double"))
    started = start_recommendations(stream, products, ranked, generic, f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    if broken:  # the batch is not replaced by something else; it is repeated when the query starts again
        with pytest.raises(Exception, match="no catalog"):
            started.awaitTermination()
        return
    started.awaitTermination()
    schema = "user_id string, product_id string, score double, reason string, rank int, window_start_ms long, " \
             "product_name string, generated_at_ms long"
    out = spark.read.text(f"{tmp_path}/out").select(F.from_json("value", schema).alias("r")).select("r.*").persist()
    profiles = window_profiles(parts).where("window_start_ms + 600000 <= (1706657176220 - 5000)")
    # A returning user who viewed and bought nothing so far has no category to choose from.
    empty = running_profiles(profiles).where("session_count > 1 and category_items = 0").count()
    assert out.select("user_id", "window_start_ms").distinct().count() == profiles.count()
    assert out.where("reason = 'fallback'").select("user_id", "window_start_ms").distinct().count() == empty
    first = profiles.groupBy("user_id").agg(F.min("window_start_ms").alias("window_start_ms"))
    cold = out.where("reason = 'cold_start'")
    assert cold.join(first, ["user_id", "window_start_ms"], "left_anti").count() == 0
    assert cold.where("score != 0.7").count() == 0 and out.where("rank > 10 or score < 0.3").count() == 0
    bought = parts.where("event_type = 'purchase'").select("user_id", "product_id", F.col("ts_ms").alias("bought_ms"))
    again = out.where("reason = 'personalized'").join(bought, ["user_id", "product_id"])
    assert again.where("bought_ms < window_start_ms").count() == 0


def test_settings(tmp_path):
    assert load_settings(str(tmp_path / "none.yaml")) == Settings()
    path = tmp_path / "config.yaml"
    path.write_text('{"processing": {"window_size_minutes": 5}, "kafka": {"topics": {"input": "x"}}, "other": 1}')
    loaded = load_settings(str(path))
    assert loaded.processing.window_size_minutes == 5 and loaded.processing.watermark_delay_seconds == 5
    assert loaded.kafka.topics.input == "x" and loaded.recommendation.min_score == 0.3
    assert merge_settings(Settings(), {"environment": "prod"}).environment == "prod"


def test_csv_reading_matches_plain_parsing(spark, tmp_path):
    from clickloom.sources.files import read_raw_csv

    lines = [HEADER, "t,view,p,1,c,b,1.5,u,s", "t,view", "t,view,p,1,c,b,1.5,u,s,extra", 't,view,p,1,"x ""y"", z",b,,u,s',
             " t ,view,p,1,c,b, 1 ,u,s"]
    path = tmp_path / "raw.csv"
    path.write_text("\n".join(lines) + "\n")
    got = [tuple(r) for r in read_raw_csv(spark, str(path)).collect()]
    want = []
    for values in csv.reader(lines[1:]):
        row = dict(zip(EVENT_COLUMNS, values))
        want.append(tuple(row.get(c) or None for c in EVENT_COLUMNS))
    assert got == want


def test_state_with_a_lifetime(spark, tmp_path):
    """Sessions whose state leaves by the clock: it is there for the next batch, and gone after its lifetime."""
    import time

    rows = spark.createDataFrame(
        [(i, "u", 1_000_000 * i, "p", None) for i in range(3)],
        "event_id long, user_id string, ts_ms long, product_id string, category_id string")
    for state_ms, wait, sessions in ((3_600_000, 0, 1), (1, 2, 0)):
        base = f"{tmp_path}/{state_ms}"
        for part in ("event_id < 2", "event_id = 2"):  # 2,000 s after the start the session is closed, if it is known
            rows.where(part).coalesce(1).write.mode("append").parquet(f"{base}/in")
            stream = spark.readStream.schema(rows.schema).parquet(f"{base}/in")
            closed = keyed(stream, "user_id", CappedSessions(state_ms=state_ms), SESSION_OUTPUT)
            writer = closed.writeStream.option("checkpointLocation", f"{base}/checkpoint").trigger(once=True)
            writer.format("parquet").start(f"{base}/rows").awaitTermination()
            time.sleep(wait)
        assert spark.read.schema(closed.schema).parquet(f"{base}/rows").count() == sessions


def test_event_stream_of_one_file_and_of_a_folder(spark, tmp_path):
    from clickloom.sources.files import stream_events
    from clickloom.sources.tables import SCHEMAS
    from clickloom.streaming.runners import start_table

    events = table(spark, SMALL, "events")
    events.repartition(7).write.parquet(f"{tmp_path}/events.parquet")
    for i, path in enumerate((f"{SMALL}/events.parquet", f"{tmp_path}/events.parquet")):
        stream = stream_events(spark, path, SCHEMAS["events"], ONE_FILE)
        start_table(stream, f"{tmp_path}/{i}/rows", f"{tmp_path}/{i}/checkpoint").awaitTermination()
        assert spark.read.parquet(f"{tmp_path}/{i}/rows").count() == events.count()


def test_stream_files_are_bounded_and_lose_no_row(spark, monkeypatch):
    """A third of the rows at one time, a tenth without one, and one row far off: files stay small, in order and whole."""
    from clickloom.plans import stream_queries

    monkeypatch.setattr(stream_queries, "FILE_BYTES", 8_000, raising=False)
    rows = spark.range(4000).select(
        F.col("id").alias("event_id"),
        F.expr("CASE WHEN id % 10 = 0 THEN null WHEN id % 3 = 0 THEN 5 WHEN id = 1 THEN 1000000000 ELSE id END").alias("ms"))
    path = stream_queries._in_files(spark, rows, "ms", "bounded-files")
    found = spark.read.schema(rows.schema).parquet(path).select("*", "_metadata.file_path", "_metadata.file_modification_time")
    files = {}
    for r in found.orderBy("file_modification_time").collect():
        files.setdefault(r.file_path, []).append((r.ms is not None, r.ms or 0, r.event_id))
    assert sum(map(len, files.values())) == 4000
    assert len(files) == 8 and max(map(len, files.values())) < 800
    parts = list(files.values())
    assert all(max(a) < min(b) for a, b in zip(parts, parts[1:]))
    empty = stream_queries._in_files(spark, rows.limit(0), "ms", "no-files")
    assert spark.read.schema(rows.schema).parquet(empty).count() == 0
