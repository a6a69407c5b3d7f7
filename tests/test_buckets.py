"""Keyed state by buckets: many keys give the results of one by one, and no call or entry of state for each of them."""

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from clickloom.operators.bitmaps import (
    in_words, item_numbers, merged_words, profile_events, window_words, word_members, word_sizes,
)
from clickloom.session import stored
from clickloom.streaming.blocks import SIZE_OUTPUT, WordProfiles
from clickloom.streaming import buckets
from clickloom.streaming.buckets import BUCKETS
from clickloom.streaming.processors import (
    ACTIVITY_OUTPUT, SCORE_OUTPUT, SESSION_OUTPUT, CachedScores, CappedSessions, TrailingActivity, keyed,
)
from clickloom.streaming.runners import start_table
from clickloom.streaming.timed import CLOSED_OUTPUT, SilentSessions, corrected_windows, each_once, timed

KEYS = 3 * BUCKETS
ONE_FILE = {"maxFilesPerTrigger": "1"}


def run(spark, tmp_path, rows, streamed):
    """The rows of the stream over two micro-batches, by ``batch``, and the entries of state that it ended with."""
    for batch in (0, 1):
        rows.where(F.col("batch") == batch).drop("batch").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    schema = rows.drop("batch").schema
    stream = streamed(spark.readStream.schema(schema).options(**ONE_FILE).parquet(f"{tmp_path}/in"))
    query = start_table(stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    query.awaitTermination()
    entries = query.lastProgress["stateOperators"][0]["numRowsTotal"]
    return spark.read.schema(stream.schema).parquet(f"{tmp_path}/out").select(*stream.columns), entries


def test_scores_of_many_pairs(spark, tmp_path):
    """Three requests for each pair: one stores its score, if it has one, the next finds it, the last comes after its lifetime."""
    rows = spark.range(3 * KEYS).select(
        F.col("id").alias("event_id"), F.expr(f"if((id % {KEYS}) % 5 = 0, null, concat('u', id % {KEYS}))").alias("user_id"),
        F.format_string("p%d", F.expr(f"id % {KEYS}")).alias("product_id"),
        F.expr(f"array(0, 5, 100)[cast(id div {KEYS} as int)]").cast("long").alias("ts_ms"),
        F.expr("if(id % 11 = 0, null, cast(id as double))").alias("score"), F.expr(f"cast(id >= {KEYS} as int)").alias("batch"))
    found, entries = run(
        spark, tmp_path, rows, lambda s: keyed(s, ["user_id", "product_id"], CachedScores(50), SCORE_OUTPUT))
    assert entries <= BUCKETS
    got = {r.event_id: (r.cached, r.cached_at_ms, r.score) for r in found.collect()}
    want = {}
    for pair in range(KEYS):
        stored = None
        for event_id, ts in zip((pair, pair + KEYS, pair + 2 * KEYS), (0, 5, 100)):
            if stored and ts - stored[0] < 50:
                want[event_id] = (True, *stored)
            elif event_id % 11:
                stored = (ts, float(event_id))
                want[event_id] = (False, *stored)
            else:
                want[event_id] = (False, None, None)
    assert got == want


def test_partitions_of_a_stream(spark, tmp_path):
    """A stream keeps its state in fewer partitions than the session has, which are left as they were."""
    usual = spark.conf.get("spark.sql.shuffle.partitions")
    rows = spark.range(10).select(F.col("id").alias("event_id"), F.lit("u").alias("user_id"))
    rows.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in").dropDuplicates(["event_id"])
    query = start_table(stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint", partitions=3)
    query.awaitTermination()
    assert query.lastProgress["stateOperators"][0]["numShufflePartitions"] == 3
    assert spark.conf.get("spark.sql.shuffle.partitions") == usual


def test_sets_of_many_users(spark, tmp_path):
    """Users with a handful of items, one with hundreds, over two micro-batches: sizes as from plain sets."""
    rows = [(f"u{i}", 600_000 * (2 * batch + i % 2), "view" if (i + k) % 3 else "purchase", f"p{(i * 7 + k * batch) % 900}", f"c{i % 4}")
            for batch in (0, 1) for i in range(KEYS) for k in (0, 1)]
    rows += [("hot", 600_000 * (i // 300), "view", f"p{i}", "") for i in range(900)]
    events = spark.createDataFrame(rows, "user_id string, ts_ms long, event_type string, product_id string, category_code string")
    numbers = stored(item_numbers(profile_events(events)), "numbers")
    assert numbers.where("domain = 'product'").count() == 900
    words = window_words(events, numbers).withColumn("batch", F.expr("cast(window_start_ms >= 1200000 as int)"))
    found, entries = run(spark, tmp_path, words, lambda s: keyed(s, "user_id", WordProfiles(), SIZE_OUTPUT))
    assert entries <= 2 * BUCKETS
    want, sets = {}, {}
    for user, ts, kind, product, category in sorted(rows, key=lambda r: r[1]):
        mine = sets.setdefault(user, (set(), set(), set()))
        mine[0 if kind == "view" else 1].add(product)
        mine[2].update({category} - {""})
        want[user, ts] = tuple(map(len, mine))
    assert {(r.user_id, r.window_start_ms): (r.viewed_items, r.purchased_items, r.category_items) for r in found.collect()} == want


def test_words_of_few_items(spark):
    """Sets of many users by words, merged from two periods: sizes and members as from plain sets, and no more words than members."""
    rows = [(f"u{i}", 600_000 * k, "view" if k else "purchase", f"p{i * i % 700}", f"c{k}") for i in range(2000) for k in (0, 1, 2)]
    entries = profile_events(spark.createDataFrame(
        rows, "user_id string, ts_ms long, event_type string, product_id string, category_code string"))
    numbers = item_numbers(entries).cache()
    words = [in_words(entries.where(part), numbers, ["user_id"]) for part in ("window_start_ms = 0", "window_start_ms > 0")]
    words = merged_words(words[0].unionByName(words[1]), ["user_id"]).cache()
    want = {(u, "viewed" if kind == "view" else "purchased", p) for u, _, kind, p, _ in rows} | {(r[0], "category", r[4]) for r in rows}
    got = [tuple(r) for r in word_members(words, numbers).collect()]
    assert set(got) == want and len(got) == len(want) and words.count() <= len(want)
    assert {tuple(r)[1:] for r in word_sizes(words).collect()} == {(1, 1, 3)}
    # The last bit of a word, and the first of the next one.
    ends = spark.createDataFrame([("product", "x", 64), ("product", "y", 65)], numbers.schema)
    both = in_words(spark.createDataFrame(
        [("u", "viewed", "product", i) for i in "xy"], "user_id string, kind string, domain string, item string"), ends, ["user_id"])
    assert sorted(r.word for r in both.collect()) == [0, 1] and word_sizes(both).first().viewed_items == 2
    assert sorted(r.item for r in word_members(both, ends).collect()) == ["x", "y"]


@pytest.mark.parametrize(("name", "processor", "columns"), [
    ("sessions", lambda s: keyed(s, "user_id", CappedSessions(), SESSION_OUTPUT), 0),
    ("activity", lambda s: keyed(s, "user_id", TrailingActivity(), ACTIVITY_OUTPUT), 2),
    ("silent", lambda s: timed(s, "user_id", SilentSessions(50, 100), CLOSED_OUTPUT, 0), 1),
    ("windows", lambda s: corrected_windows(s, out_of_orderness_ms=0, allowed_ms=0), 1)])
def test_state_of_many_users(spark, tmp_path, name, processor, columns):
    """Two micro-batches of an event for each user: results per user, entries of state per bucket."""
    rows = spark.range(2 * KEYS).select(
        F.col("id").alias("event_id"), F.format_string("u%d", F.expr(f"id % {KEYS}")).alias("user_id"),
        F.expr(f"cast(id div {KEYS} as int)").alias("batch"), F.lit("view").alias("event_type"), F.lit("p").alias("product_id"),
        F.lit("c").alias("category_id")).withColumn("ts_ms", (F.col("batch") + 1) * F.lit(1_000_000).cast("long"))
    found, entries = run(spark, tmp_path, rows.withColumn("event_time", F.timestamp_millis("ts_ms")), processor)
    assert found.count() == columns * KEYS and found.select("user_id").distinct().count() == (KEYS if columns else 0)
    # Before: an entry for each user, and two more for each timer.
    assert entries <= (4 * BUCKETS if name in ("silent", "windows") else BUCKETS)


def test_rows_of_a_task_are_packed(monkeypatch):
    """A row for each bucket and share of the rows held, with all rows in the order they came; nulls and lists stay."""
    rows = [{"user_id": None if i % 5 == 0 else f"u{i % 9}", "n": None if i % 4 == 0 else i, "items": [f"p{i}"] * (i % 3),
             buckets.BUCKET: i * 7 % 10} for i in range(1000)]
    batches = pa.RecordBatch.from_pylist(rows[:700]), pa.RecordBatch.from_pylist(rows[700:])
    monkeypatch.setattr(buckets, "PACK_BYTES", batches[0].nbytes)
    packs = list(buckets._packs(iter(batches)))
    assert [p.num_rows for p in packs] == [10, 10]
    frames = [p.to_pandas() for p in packs]
    for bucket in range(10):
        mine = [f[f[buckets.BUCKET] == bucket] for f in frames]
        got = buckets.unpacked(mine)
        want = [r for r in rows if r[buckets.BUCKET] == bucket]
        assert [x if x == x else None for x in got["n"]] == [r["n"] for r in want]
        assert got["user_id"].tolist() == [r["user_id"] for r in want] and [list(x) for x in got["items"]] == [r["items"] for r in want]
    plain = pd.DataFrame({"user_id": ["a"], "n": [1]})
    assert buckets.unpacked([plain, plain]).to_dict("list") == {"user_id": ["a", "a"], "n": [1, 1]}


def test_keys_come_packed(spark):
    """Rows are packed before the exchange to the processor, but for one with timers, whose late rows Spark drops."""
    rows = spark.readStream.format("rate").load().select(
        F.col("value").alias("event_id"), F.col("value").cast("string").alias("user_id"), F.col("value").alias("ts_ms"),
        F.lit("view").alias("event_type"), F.lit("p").alias("product_id"), F.lit("c").alias("category_id"),
        F.col("timestamp").alias("event_time"))
    plan = lambda df: df._jdf.queryExecution().analyzed().toString()
    assert "MapInArrow" in plan(keyed(rows, "user_id", TrailingActivity(), ACTIVITY_OUTPUT))
    assert "MapInArrow" not in plan(timed(rows, "user_id", SilentSessions(50, 100), CLOSED_OUTPUT, 0))


def test_files_of_a_stream_can_be_split(spark, monkeypatch):
    """Several tasks can read a file of a micro-batch: it has several row groups."""
    from pathlib import Path

    import pyarrow.parquet as pq

    from clickloom.plans import stream_queries

    monkeypatch.setattr(stream_queries, "SPLIT_BYTES", 10_000, raising=False)
    rows = spark.range(40_000).select(F.col("id").alias("event_id"), F.rand(1).alias("value"))
    path = stream_queries._in_files(spark, rows, "event_id", "split-files").removeprefix("file://")
    files = list(Path(path).glob("part-*"))
    assert len(files) == 4 and all(pq.ParquetFile(f).num_row_groups > 1 for f in files)


def test_silent_sessions_have_few_buckets(spark, tmp_path):
    """What a bucket costs in a micro-batch whatever its rows is paid a quarter as often as with the usual number."""
    rows = spark.range(KEYS).select(
        F.col("id").alias("event_id"), F.format_string("u%d", "id").alias("user_id"), F.lit("p").alias("product_id"),
        F.lit("c").alias("category_id"), F.expr("cast(1000000 + id as long)").alias("ts_ms"), F.expr("cast(id % 2 as int)").alias("batch"))
    found, entries = run(
        spark, tmp_path, rows.withColumn("event_time", F.timestamp_millis("ts_ms")),
        lambda s: timed(s, "user_id", SilentSessions(10**6, 10**5), CLOSED_OUTPUT, 0))
    assert found.count() == 0 and entries <= BUCKETS  # four for each bucket


def test_a_session_that_is_due_closes_with_the_rows_of_its_micro_batch():
    """The state is written once, and no timer has to read it again in that micro-batch."""
    class Value:
        held, writes = None, 0

        def get(self):
            return self.held

        def update(self, value):
            self.held, self.writes = value, self.writes + 1

        def clear(self):
            self.held = None

    class Handle:
        def __init__(self):
            self.values, self.timers = {}, set()

        def getValueState(self, name, *options):
            return self.values.setdefault(name, Value())

        def registerTimer(self, at):
            self.timers.add(at)

        def deleteTimer(self, at):
            self.timers.remove(at)

    class Times:
        def getCurrentWatermarkInMs(self):
            return 5000

    processor, handle = SilentSessions(1000, 100), Handle()
    processor.init(handle)
    rows = pd.DataFrame([
        (1, "u", 4000, "a", "x"), (2, "u", 4050, "b", "x"), (3, "v", 4950, None, "x"), (4, "w", 1000, "a", None), (5, "w", 9000, "a", None),
    ], columns=["event_id", "user_id", "ts_ms", "product_id", "category_id"])
    sent = pd.concat(processor.handleInputRows((0,), iter([rows]), Times()))
    assert sorted(sent.itertuples(index=False, name=None)) == [
        ("u", 4000, 4050, 50, 2, 2, 1, "silent"), ("w", 1000, 1000, 0, 1, 1, 0, "silent")]
    assert sorted(processor.open.read()) == [("v",), ("w",)] and handle.timers == {5051} and handle.values["open"].writes == 1


def test_options_of_one_stream(spark, tmp_path):
    """Options that a query starts with, such as no micro-batch without rows, are not left in the session."""
    name, count = "spark.sql.streaming.noDataMicroBatches.enabled", "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"
    usual = [spark.conf.get(k, None) for k in (name, count)]
    for k in (0, 1):
        spark.range(10 * k, 10 * k + 10).select(F.col("id").alias("event_id"), F.timestamp_millis((k + 1) * F.lit(10**8)).alias(
            "event_time")).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = each_once(spark.readStream.schema("event_id long, event_time timestamp").options(**ONE_FILE).parquet(
        f"{tmp_path}/in"), ["event_id"], "1 hour")
    query = start_table(stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint", conf={name: "false", count: "false"})
    query.awaitTermination()
    assert [p["numInputRows"] for p in query.recentProgress] == [10, 10]
    assert [spark.conf.get(k, None) for k in (name, count)] == usual
    assert spark.read.parquet(f"{tmp_path}/out").count() == 20


def test_no_micro_batch_joins_the_catalog(spark, monkeypatch):
    """It grows with the events, and so does the number of micro-batches."""
    from clickloom.plans import timed_queries

    monkeypatch.setattr(timed_queries, "_finished", lambda spark, stream, name, **options: stream)
    stream = timed_queries.x7_stream_silent_sessions(spark, "/root/testdata/sf0.001")
    assert "Join" not in stream._jdf.queryExecution().analyzed().toString()
