"""Edge cases of the operators on hand-made rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.operators import activity, alerts, anchored, drift, features, intake, late, latency_stats, ordered, recommend, scoring, sessions
from clickloom.operators.activity import trailing_activity
from clickloom.operators.profiles import merged_profiles, running_profiles, window_profiles
from clickloom.sources.files import parse_csv_lines, parse_json_events
from clickloom.sources.tables import EVENT_COLUMNS, RAW_EVENT

MINUTE = 60_000


def raw(spark, *rows):
    base = {"event_time": "2024-01-01T00:00:00Z", "event_type": "view", "price": "1.5", "user_id": "u"}
    return spark.createDataFrame([tuple({**base, **r}.get(c) for c in EVENT_COLUMNS) for r in rows], RAW_EVENT)


@pytest.mark.parametrize("row,error", [
    ({}, None),
    ({"event_time": ""}, "missing event_time"),
    ({"event_time": None}, "missing event_time"),
    ({"price": ""}, None),
    ({"price": None}, None),
    ({"price": "abc"}, "parse error: could not convert string to float: 'abc'"),
    ({"price": "it's"}, "parse error: could not convert string to float: \"it's\""),
    ({"price": "1.5f"}, "parse error: could not convert string to float: '1.5f'"),
    ({"price": "-1"}, "negative price"),
    ({"price": "-0"}, None),
    ({"price": "-inf"}, "negative price"),
    ({"price": "nan"}, None),
    ({"price": "1_0"}, None),
    ({"price": "1__0"}, "parse error: could not convert string to float: '1__0'"),
    ({"price": " 2.5\t"}, None),
    ({"price": "1e3"}, None),
    ({"price": "."}, "parse error: could not convert string to float: '.'"),
    ({"user_id": ""}, "missing user_id"),
    ({"event_time": "", "price": "abc", "user_id": ""}, "missing event_time"),
    ({"price": "-3", "user_id": ""}, "negative price"),
    ({"brand": "x" * 131_073}, None),
])
def test_validation(spark, row, error):
    assert intake.with_error(raw(spark, row)).first()["error"] == error


def test_field_limit_is_an_option(spark):
    checked = intake.with_error(raw(spark, {"brand": "x" * 30}, {"brand": "x"}), field_limit=25)
    assert [r["error"] for r in checked.orderBy("brand").collect()] == [
        None, "csv_parse_error: field larger than field limit (25)"]


@pytest.mark.parametrize("text", [
    "1", "+1.", ".5", "1e-3", "1_000.5_0", "INF", "-Infinity", "NaN", "+nan", " 7 ", "1E5", "abc", "1_", "_1", "1.e", "0x10",
    "1d", "--1", "", "1 2", "infinit", "1_.5", "1._5",
])
def test_numbers_read_like_python(spark, text):
    from clickloom.functions.numbers import to_number

    got = spark.createDataFrame([(text,)], "t string").select(to_number(F.col("t")).alias("n")).first()["n"]
    try:
        want = float(text)
    except ValueError:
        want = None
    assert got == want or (want is not None and math.isnan(want) and math.isnan(got))


def test_clean_side_has_typed_price(spark):
    checked = intake.with_error(raw(spark, {"price": "1_0"}, {"price": ""}, {"price": "x"}))
    assert [r["price"] for r in intake.valid_rows(checked).collect()] == [10.0, None]
    assert intake.dead_letters(checked).first()["price"] == "x"
    assert tuple(intake.intake_counts(checked).first()) == (3, 2, 1)


def test_csv_lines(spark):
    lines = spark.createDataFrame(
        [("t,view,p,c,cc,b,1,u,s",), ("t,view,p",), ("t,view,p,c,cc,b,1,u,s,more,x",), ('t,view,p,c,"a,""q""",b,1,u,s',),
         ("",)],
        "value string",
    )
    rows = parse_csv_lines(lines).collect()
    assert rows[0]["user_session"] == "s" and rows[1]["user_id"] is None and rows[1]["product_id"] == "p"
    assert rows[2]["user_session"] == "s" and rows[3]["category_code"] == 'a,"q"'
    assert rows[4]["event_time"] is None


def test_json_records(spark):
    records = spark.createDataFrame(
        [('{"event_time":"t","user_id":"u","price":2.5}',), ('{"user_id":',), ("[1]",), (None,), ("",)], "value string"
    )
    rows = parse_json_events(records).collect()
    assert rows[0]["event"]["price"] == 2.5
    assert [r["event"] for r in rows[1:]] == [None] * 4


def test_late_boundaries(spark):
    # Watermark after the first event: 10,000,000 - 5,000.
    mark = 9_995_000
    delays = [-1, 0, 300_000, 300_001, 1_800_000, 1_800_001]
    rows = [(1, 0, 10_000_000, 0)] + [(1, i + 1, mark - d, i + 1) for i, d in enumerate(delays)]
    df = spark.createDataFrame(rows, "shard long, event_id long, ts_ms long, arrival_ms long")
    out = late.classify_late(df).orderBy("event_id").collect()
    assert [r["late_class"] for r in out] == [
        "on_time", "on_time", "moderate", "moderate", "very_late", "very_late", "discarded"
    ]
    assert out[0]["watermark_ms"] is None and out[2]["delay_seconds"] == 0.0
    assert out[2]["window_start_ms"] == mark - mark % MINUTE and out[6]["window_start_ms"] is None
    main = late.main_stream(late.classify_late(df), F.col("arrival_ms"))
    assert main.count() == 4
    assert main.where("event_id = 2").first()["metadata"]["original_timestamp"] == str(mark)
    assert late.very_late_stream(late.classify_late(df), F.col("arrival_ms")).first()["metadata"]["discarded_from_windows"] == "true"


def session_rows(spark, times, user="u"):
    return spark.createDataFrame(
        [(user, t, i, f"p{i % 5}", "c" if i % 2 else None) for i, t in enumerate(times)],
        "user_id string, ts_ms long, event_id long, product_id string, category_id string",
    )


def test_session_cap(spark):
    half = 30 * MINUTE
    exact = sessions.session_summary(sessions.sessionize(session_rows(spark, [0, half]))).collect()
    assert len(exact) == 1 and not exact[0]["closed"] and exact[0]["duration_ms"] == half
    over = sessions.session_summary(
        sessions.sessionize(session_rows(spark, [0, half + 1, half + 2]))
    ).orderBy("start_time").collect()
    assert [(r["start_time"], r["closed"], r["event_count"]) for r in over] == [(0, True, 2), (half + 2, False, 1)]


def test_session_limits(spark):
    many = sessions.session_summary(sessions.sessionize(session_rows(spark, range(101)))).first()
    assert (many["events_seen"], many["event_count"], many["unique_products"], many["unique_categories"]) == (101, 100, 5, 1)
    eleven = [t for s in range(11) for t in (s * 40 * MINUTE, s * 40 * MINUTE + 31 * MINUTE)]
    history = sessions.session_history(sessions.session_summary(sessions.sessionize(session_rows(spark, eleven))))
    assert sorted(r["start_time"] for r in history.collect()) == [s * 40 * MINUTE for s in range(1, 11)]


def test_session_snapshot(spark):
    rows = sessions.sessionize(session_rows(spark, [0, 1000, 10 * MINUTE]))
    shot = sessions.session_snapshot(rows, sessions.session_summary(rows), F.lit(5 * MINUTE + 1000)).first()
    assert (shot["total_events"], shot["recent_events"], shot["event_frequency"]) == (3, 1, pytest.approx(3 / 600))


def test_trailing_minute_includes_its_lower_edge(spark):
    df = spark.createDataFrame(
        [(0, "u", 0, "view"), (1, "u", 60_000, "cart"), (2, "u", 120_001, "view"), (3, "u", 120_001, "view")],
        "event_id long, user_id string, ts_ms long, event_type string",
    )
    out = {r["event_id"]: r for r in trailing_activity(df, ["view", "cart"]).collect()}
    assert [out[i]["total_events"] for i in range(4)] == [1, 2, 2, 2]
    assert out[1]["event_type_counts"] == {"view": 1, "cart": 1} and out[2]["event_type_counts"] == {"view": 2}


def profile_events(spark, rows):
    return spark.createDataFrame(rows, "user_id string, ts_ms long, event_type string, product_id string, category_code string"
                                 ).withColumn("event_time", F.timestamp_millis("ts_ms"))


def test_profiles(spark):
    events = profile_events(spark, [
        ("u", 0, "view", "a", "x"), ("u", 1000, "purchase", "a", ""), ("u", 2000, "cart", "b", "y"),
        ("u", 10 * MINUTE, "view", "c", None), ("u", 10 * MINUTE + 500, "view", "a", "z"), ("v", 5, "cart", "q", "x"),
    ])
    profiles = window_profiles(events)
    first = profiles.where("user_id = 'u' and window_start_ms = 0").first()
    assert (first["viewed_products"], first["purchased_products"], first["categories_preferred"]) == (["a"], ["a"], ["x"])
    assert first["avg_session_duration"] == 2000.0
    merged = {r["user_id"]: r for r in merged_profiles(profiles).collect()}
    assert merged["u"]["viewed_products"] == ["a", "c"] and merged["u"]["session_count"] == 2
    assert merged["u"]["avg_session_duration"] == 1250.0 and merged["v"]["viewed_products"] == []
    running = running_profiles(profiles).where("user_id = 'u'").orderBy("window_start_ms").collect()
    assert [(r["viewed_items"], r["category_items"]) for r in running] == [(1, 1), (2, 2)]


def test_filter_and_rank(spark):
    rows = [("u", "low", 0, 0.2999), ("u", "edge", 1, 0.3), ("u", "low", 2, 0.9), ("u", "edge", 3, 1.0)]
    rows += [("u", f"t{i}", 10 + i, 0.5) for i in range(11)]
    best = recommend.filter_and_rank(
        spark.createDataFrame(rows, "user_id string, product_id string, position long, score double")
    ).orderBy("rank").collect()
    assert best[0]["product_id"] == "low"  # its first occurrence that passes has 0.9
    assert [r["product_id"] for r in best[1:]] == [f"t{i}" for i in range(9)]


def test_cold_start_has_exactly_the_limit(spark):
    popular = spark.createDataFrame([(f"p{i}", 100 - i) for i in range(3)], "product_id string, score long")
    trending = spark.createDataFrame([("p1", 9), ("t1", 8), ("t2", 7)], "product_id string, score long")
    made = recommend.cold_start_products(popular, trending, 3).first()["products"]
    assert made == ["p0", "p1", "p2"]
    assert recommend.cold_start_products(popular, trending, 5).first()["products"] == ["p0", "p1", "p2", "t1", "t2"]


def test_personal_lists_reach_past_what_was_bought(spark):
    scores = spark.createDataFrame([(f"p{i:03d}", 500 - i) for i in range(100)], "product_id string, score long")
    products = spark.createDataFrame(
        [(f"p{i:03d}", "x" if i < 90 else "y") for i in range(100)], "product_id string, category_code string"
    )
    events = spark.createDataFrame(
        [("heavy", f"p{i:03d}", "purchase") for i in range(70)]
        + [("light", "p000", "purchase"), ("light", "p000", "view"), ("light", "p095", "view"), ("none", "p001", "cart")],
        "user_id string, product_id string, event_type string",
    )
    touched = recommend.touched_products(events, products)
    out = recommend.personalized(
        recommend.interests_of(touched), recommend.bought_of(touched), recommend.ranked_products(scores, products), 7
    )
    lists = {}
    for r in out.orderBy("user_id", "position").collect():
        lists.setdefault(r["user_id"], []).append((r["product_id"], r["score"]))
    assert [p for p, _ in lists["heavy"]] == [f"p{i:03d}" for i in range(70, 77)]
    assert lists["light"][0] == ("p090", 1.0) and len(lists["light"]) == 7
    assert ("p000", 1.0) not in lists["light"] and "none" not in lists


def test_enrichment_keeps_unknown_products(spark):
    recs = spark.createDataFrame([("u", "a"), ("u", "b"), ("u", "c")], "user_id string, product_id string")
    products = spark.createDataFrame(
        [("a", "name", "cat", 2.0), ("b", "name", "cat", None)],
        "product_id string, product_name string, category_code string, list_price double",
    )
    out = {r["product_id"]: r for r in recommend.enrich(recs, products, F.lit(7).cast("long")).collect()}
    assert out["b"]["price"] == 0.0 and out["c"]["price"] is None and out["c"]["generated_at_ms"] == 7


def transactions(spark, rows):
    return spark.createDataFrame(
        rows, "user_id string, ts_ms long, event_id long, amount double, category string, product_id string"
    )


def test_user_features(spark):
    now = 10 * 86_400_000
    rows = [("many", now - 10_000 - i, i, float(i), "c" if i < 3 else "d", "p") for i in range(101)]
    rows += [("tie", now - 5, 1, 1.0, "new", "p"), ("tie", now - 9, 2, 1.0, "old", "p")]
    rows += [("edge", now - 3_600_000, 3, 1.0, None, "p"), ("edge", now - 3_599_999, 4, 3.0, None, "p")]
    out = {r["user_id"]: r for r in features.user_features(transactions(spark, rows), F.lit(now)).collect()}
    assert out["many"]["total_transactions"] == 100 and out["many"]["avg_transaction_amount"] == pytest.approx(49.5)
    assert out["tie"]["preferred_category"] == "new" and out["edge"]["preferred_category"] == "unknown"
    assert out["edge"]["recent_transaction_count"] == 1
    assert out["edge"]["transaction_velocity"] == pytest.approx(1 / 3600)


def test_feature_lookup(spark):
    now = 1_000_000
    bought = transactions(spark, [("fresh", now - 5, 1, 4.0, "c", "p"), ("old", now - 5, 2, 6.0, "c", "p")])
    stored = features.user_features(bought, F.lit(now)).where("user_id = 'fresh'").withColumn(
        "avg_transaction_amount", F.lit(99.0)
    ).withColumn("computed_at_ms", F.lit(now - 299_999))
    expired = features.user_features(bought, F.lit(now)).where("user_id = 'old'").withColumn(
        "computed_at_ms", F.lit(now - 300_000)
    )
    users = spark.createDataFrame([("fresh",), ("old",), ("none",)], "user_id string")
    out = {r["user_id"]: r for r in features.lookup_user_features(
        users, stored.unionByName(expired), bought, F.lit(now)).collect()}
    assert (out["fresh"]["hit"], out["fresh"]["avg_transaction_amount"]) == (True, 99.0)
    assert (out["old"]["hit"], out["old"]["avg_transaction_amount"]) == (False, 6.0)
    assert out["none"]["preferred_category"] == "unknown" and out["none"]["days_since_last_purchase"] == 999.0
    assert out["none"]["session_duration_avg"] == 0


def test_cache_age(spark):
    requests = spark.createDataFrame(
        [("u", "p", 299_999, 1), ("u", "p", 300_000, 2), ("u", "q", 1, 3)],
        "user_id string, product_id string, ts_ms long, event_id long",
    )
    known = spark.createDataFrame([("u", "p", 0, 0.25)], "user_id string, product_id string, cached_at_ms long, score double")
    out = {r["event_id"]: (r["cached"], r["cached_score"]) for r in scoring.cached_predictions(requests, known).collect()}
    assert out == {1: (True, 0.25), 2: (False, None), 3: (False, None)}
    chained = scoring.score_with_cache(
        spark.createDataFrame([("u", "p", t, i) for i, t in enumerate([0, 299_999, 300_000, 599_999, 600_000])],
                              "user_id string, product_id string, ts_ms long, event_id long"),
        F.lit(0.5), F.lit(20.0),
    ).orderBy("event_id").collect()
    assert [r["cached"] for r in chained] == [False, True, False, True, False]
    assert [r["latency_ms"] for r in chained] == [20.0, 0.1, 20.0, 0.1, 20.0]


def test_request_batches(spark):
    requests = spark.range(100).repartition(5).select(
        F.col("id").alias("event_id"), F.when(F.col("id") != 33, F.col("id") / 100.0).alias("score"))
    batched = scoring.request_batches(requests)
    rows = {r["event_id"]: r for r in scoring.failed_batches(batched).collect()}
    assert len(rows) == 100 and rows[99]["batch_rows"] == 4 and rows[0]["batch_rows"] == 32
    assert all(rows[i]["batch_id"] == i // 32 for i in rows)
    assert (rows[99]["score"], rows[99]["failed"]) == (0.99, False)
    assert all((rows[i]["score"], rows[i]["failed"]) == (0.5, True) for i in range(32, 64))


def test_linear_model(spark):
    weights = spark.createDataFrame([(2, 0.5), (0, 1.0), (1, -2.0)], "i int, w double")
    vectors = spark.createDataFrame(
        [(1, [1.0, 1.0, 2.0]), (2, [0.0, 3.0, 0.0]), (3, None), (4, [1.0])], "vec_id long, v array<float>")
    out = scoring.score_with_weights(vectors, weights, "v")
    assert {r["vec_id"]: r["prediction"] for r in out.collect()} == {1: 0.0, 2: -6.0, 3: None, 4: None}


def test_cache_keeps_the_first_score_and_no_failure(spark):
    rows = [("u", "p", 0, 1, None), ("u", "p", 1000, 2, 0.1), ("u", "p", 2000, 3, 0.9), ("u", "p", 302_000, 4, None),
            ("u", "p", 303_000, 5, 0.7), ("u", None, 5, 6, 0.3), ("u", None, 6, 7, 0.4), (None, "p", 7, 8, 0.2)]
    frame = spark.createDataFrame(rows, "user_id string, product_id string, ts_ms long, event_id long, own double")
    out = scoring.score_with_cache(frame, F.col("own"), F.lit(20.0)).orderBy("event_id").collect()
    assert [(r["cached"], r["score"], r["cached_at_ms"]) for r in out] == [
        (False, None, None), (False, 0.1, 1000), (True, 0.1, 1000), (False, None, None), (False, 0.7, 303_000),
        (False, 0.3, 5), (True, 0.3, 5), (False, 0.2, 7)]


def test_null_users_are_a_key(spark):
    rows = [(None, 0, 1, "a"), (None, 10, 2, "b"), ("u", 5, 3, "a"), (None, 2_000_000, 4, "a"), (None, 2_000_001, 5, "c")]
    frame = spark.createDataFrame(rows, "user_id string, ts_ms long, event_id long, product_id string")
    out = anchored.with_segment(frame, ["user_id"], "ts_ms", "event_id", 1_800_000, closes=True).orderBy("event_id")
    assert [r["segment_start"] for r in out.collect()] == [0, 0, 5, 0, 2_000_001]
    walked = ordered.running(frame, ["user_id"], ["ts_ms"], F.lit(1).cast("long"), "n", how="sum",
                             block=ordered.block_start(F.col("ts_ms"), 1000)).orderBy("event_id")
    assert [r["n"] for r in walked.collect()] == [1, 2, 1, 3, 4]


def test_infinite_sample_leaves_no_trace(spark):
    rows = [("i", t * 60_000, float("inf") if t == 3 else float("nan") if t == 20 else 10.0 * t) for t in range(40)]
    frame = spark.createDataFrame(rows, "instance string, ts_ms long, value double")
    out = alerts.mean_deviation(frame, ["instance"], 300_000).orderBy("ts_ms").collect()
    means = [r["mean"] for r in out]
    assert all(means[t] == float("inf") for t in range(3, 8)) and all(math.isnan(means[t]) for t in range(20, 25))
    assert means[8] == 60.0 and means[25] == 230.0 and means[39] == 370.0


def test_long_frames(spark):
    events = spark.createDataFrame(
        [("u", i * 1_000_000, i, "view") for i in range(30)], "user_id string, ts_ms long, event_id long, event_type string")
    out = activity.trailing_activity(events, ["view"], 7_200_000).orderBy("ts_ms").collect()
    assert [r["total_events"] for r in out] == [min(i + 1, 8) for i in range(30)]


# Baseline figures of a real day of shop events, rounded as they were published.
PUBLISHED = ("price", 294.079982, 365.5100008222344, 0.0, 2574.07, 17.25, 62.94, 159.33, 362.94, 1016.73)
PUBLISHED_TYPES = {"view": 0.9785, "purchase": 0.0118, "cart": 0.0097}


def drift_batches(spark, rows):
    return spark.createDataFrame(
        rows, "batch_id long, price double, event_type string, category_code string, brand string, hour int"
    ).withColumn("event_time", F.timestamp_seconds(F.col("hour") * 3600))


def divergence(p, q):
    keys = sorted(set(p) | set(q))
    a, b = (np.array([d.get(k, 1e-10) for k in keys]) for d in (p, q))
    a, b = a / a.sum(), b / b.sum()
    m, e = (a + b) / 2, 1e-10
    js = 0.5 * (np.sum(a * np.log((a + e) / (m + e))) + np.sum(b * np.log((b + e) / (m + e))))
    return min(max(js, 0), 1)


def test_drift_scores(spark):
    from clickloom.sources.sinks import CATEGORICAL_BASELINE, NUMERIC_BASELINE

    rng = np.random.default_rng(5)
    prices = rng.gamma(2, 200, 60)
    kinds = rng.choice(["view", "cart", "return"], 60).tolist()
    rows = [(1, float(prices[i]), kinds[i], None, "b", i % 5) for i in range(60)]
    rows += [(2, float(i), "view", "c", "b", 3) for i in range(49)]
    rows += [(3, 1.0 if i < 9 else None, "view", "c", "b", 3) for i in range(50)]
    numeric = spark.createDataFrame([PUBLISHED], NUMERIC_BASELINE)
    categorical = spark.createDataFrame(
        [("event_type", k, v) for k, v in PUBLISHED_TYPES.items()]
        + [("category_code", "unknown", 1.0), ("brand", "b", 0.5), ("brand", "other", 0.5)], CATEGORICAL_BASELINE
    )
    batches = drift_batches(spark, rows)
    parts = drift.drift_parts(batches, numeric, categorical, ["batch_id"])
    got = {(r["batch_id"], r["part"]): r["score"] for r in parts.collect() if r["score"] is not None}
    mean, std = PUBLISHED[1], PUBLISHED[2]
    assert got[1, "price_mean"] == pytest.approx(min(abs(prices.mean() - mean) / (std / np.sqrt(60)) / 5, 1))
    gaps = np.abs(np.percentile(prices, [5, 25, 50, 75, 95]) - np.array(PUBLISHED[5:]))
    assert got[1, "price_quantiles"] == pytest.approx(min(gaps.max() / 2574.07, 1))
    share = {k: kinds.count(k) / 60 for k in set(kinds)}
    assert got[1, "event_type"] == pytest.approx(divergence(PUBLISHED_TYPES, share), rel=1e-9)
    assert got[1, "category_code"] == pytest.approx(0.0, abs=1e-8)
    assert got[1, "brand"] == pytest.approx(divergence({"b": 0.5, "other": 0.5}, {"b": 1.0}), rel=1e-9)
    assert got[1, "hour"] == pytest.approx(min(abs(0.2 - 1 / 24) * 10, 1))
    assert (3, "price_mean") not in got and (3, "price_quantiles") not in got and (2, "price_mean") in got
    totals = {r["batch_id"]: r for r in drift.drift_totals(parts, ["batch_id"]).collect()}
    scores = [v for (b, _), v in got.items() if b == 1]
    assert totals[1]["drift_score"] == pytest.approx(np.mean(scores)) and totals[1]["batch_size"] == 60
    assert totals[2]["drift_score"] is None and totals[2]["level"] is None  # 49 rows
    assert totals[3]["drift_score"] is not None


def test_drift_levels_are_strict(spark):
    df = spark.createDataFrame([(0.1,), (0.1001,), (0.2,), (0.2001,)], "s double")
    assert [r[0] for r in df.select(drift.drift_level(F.col("s"))).collect()] == ["none", "moderate", "moderate", "high"]


def test_two_sample_distance(spark):
    rng = np.random.default_rng(8)
    a, b = rng.normal(0, 1, 300), rng.normal(0.7, 1.5, 200)
    one, two = (spark.createDataFrame([(float(x),) for x in v], "price double") for v in (a, b))
    every = np.concatenate([a, b])
    want = max(abs((a <= x).mean() - (b <= x).mean()) for x in every)
    assert drift.two_sample_distance(one, two, "price").first()["statistic"] == pytest.approx(want)


def test_history_keeps_the_last_batches(spark):
    totals = spark.range(1500).select(
        F.col("id").alias("batch_id"), F.lit(10).cast("long").alias("batch_size"), F.lit(0.1).alias("drift_score")
    )
    out = drift.drift_history(totals, "batch_id", kept=1000, block=100).orderBy("batch_id").collect()
    assert len(out) == 1000 and out[0]["batch_id"] == 500 and out[-1]["processed_total"] == 15_000


def latencies(spark, values, **columns):
    rows = [(i, float(v) if v is not None else None, v is not None, i % 2 == 0) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "event_id long, latency_ms double, ok boolean, cache_hit boolean")


@pytest.mark.parametrize("values", [[5.0], [7.0] * 20, [1.0] * 50 + [1000.0], [*range(1, 200), None, None]])
def test_latency_summaries(spark, values):
    df = latencies(spark, values)
    good = np.array([v for v in values if v is not None], float)
    kept = good[good < good.mean() + 3 * good.std()]
    kept = kept if len(kept) else good
    service = latency_stats.service_stats(df, [F.desc("event_id")], F.lit(10.0)).first()
    assert service["p95"] == pytest.approx(np.percentile(kept, 95)) and service["mean"] == pytest.approx(kept.mean())
    assert service["std"] == pytest.approx(good.std(), abs=1e-9) and service["throughput"] == len(good) / 10
    assert service["error_rate"] == pytest.approx((len(values) - len(good)) / len(good))
    load = latency_stats.load_stats(df).first()
    assert load["p999_ms"] == pytest.approx(np.percentile(kept, 99.9)) and load["std_ms"] == pytest.approx(kept.std(), abs=1e-9)
    assert load["throughput_rps"] == pytest.approx(len(good) / (good.sum() / 1000))
    sla = latency_stats.sla_stats(df.where("ok")).first()
    ordered = sorted(good)
    assert sla["p95"] == ordered[int(len(good) * 0.95)] and sla["median"] == pytest.approx(np.median(good))
    assert sla["sla_passed"] == (sla["p95"] < 75)
    assert sla["std_dev"] == pytest.approx(good.std(ddof=1) if len(good) > 1 else 0.0, abs=1e-9)


def test_empty_latencies(spark):
    empty = latencies(spark, [1.0]).where("false")
    assert set(latency_stats.service_stats(empty, [F.desc("event_id")], F.lit(0.0)).first()) == {0, 0.0}
    assert latency_stats.sla_stats(empty).count() == 0


def test_service_window_is_the_last_ten_thousand(spark):
    df = spark.range(10_500).select(
        F.col("id").alias("event_id"), F.when(F.col("id") < 500, 1e6).otherwise(2.0).alias("latency_ms"),
        F.lit(True).alias("ok"), F.lit(True).alias("cache_hit"),
    )
    out = latency_stats.service_stats(df, [F.desc("event_id")], F.lit(100.0)).first()
    assert out["mean"] == 2.0 and out["total_predictions"] == 10_000


def test_histogram(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (3.0,), (99.0,), (None,)], "s double")
    out = latency_stats.histogram(df, F.col("s"), latency_stats.PROCESSING_BUCKETS)
    assert [r["events"] for r in out.orderBy("le").collect()] == [1, 2, 2, 2, 3, 3, 4]


def series(spark, points, name="m"):
    return spark.createDataFrame([(name, t * 1000, float(v)) for t, v in points], "series string, ts_ms long, value double")


def test_hold_time(spark):
    just = alerts.holding_runs(series(spark, [(0, 9), (30, 9), (60, 9), (70, 0), (80, 9), (139, 9)]), ["series"],
                               F.col("value") > 5, 60_000, block_ms=25_000).orderBy("active_since_ms").collect()
    assert [(r["active_since_ms"], r["firing"], r["fires_at_ms"], r["samples"]) for r in just] == [
        (0, True, 60_000, 3), (80_000, False, None, 2)
    ]


def test_counter_restart(spark):
    out = alerts.increases(series(spark, [(0, 100), (60, 160), (120, 10), (180, 40)]), ["series"], 120_000, block_ms=50_000)
    rows = out.orderBy("ts_ms").collect()
    assert [r["increase"] for r in rows] == [0, 60, 70, 40]
    assert rows[1]["rate"] == pytest.approx(0.5)


def test_absence(spark):
    out = alerts.absences(series(spark, [(0, 1), (120, 1), (241, 1)]), ["series"], F.lit(300_000).cast("long"), 120_000)
    assert [(r["absent_since_ms"], r["absent_until_ms"]) for r in out.collect()] == [(120_000, 241_000)]


def test_notifications(spark):
    rows = [("A", "c1", "s", "critical", 5), ("A", "c1", "s", "warning", 1), ("A", "c2", "s", "warning", 2),
            ("B", None, None, "warning", 3), ("C", "c1", "s", "info", 4)]
    df = spark.createDataFrame(rows, "alertname string, cluster string, service string, severity string, active_since_ms long")
    out = {(r["receiver"], r["alertname"], r["cluster"]) for r in alerts.notifications(df).collect()}
    assert out == {("critical-alerts", "A", "c1"), ("warning-alerts", "A", "c2"), ("warning-alerts", "B", ""),
                   ("slack-notifications", "C", "c1")}


def test_standard_rules(spark):
    samples = spark.createDataFrame(
        [("data_drift_score", "n", i * 60_000, 0.3) for i in range(11)] + [("up", "n", i * 60_000, 0.0) for i in range(2)],
        "metric string, instance string, ts_ms long, value double",
    )
    rules = alerts.rules_frame(spark, alerts.STANDARD_RULES)
    fired = {r["alertname"]: r["firing"] for r in alerts.evaluate_rules(samples, rules, ["instance"]).collect()}
    assert fired == {"HighDataDrift": True, "ServiceDown": True}


def test_lag(spark):
    ends = spark.createDataFrame([("t", 0, 5000), ("t", 1, 10)], "topic string, partition int, end_offset long")
    taken = spark.createDataFrame([("g", "t", 0, 3000), ("g", "t", 1, 10)],
                                  "consumer_group string, topic string, partition int, committed_offset long")
    lags = alerts.consumer_lag(ends, taken)
    assert {r["partition"]: r["lag"] for r in lags.collect()} == {0: 2000, 1: 0}
    assert alerts.lag_over(lags).first()["lag"] == 2000


def test_routes_agree_with_profiles(spark):
    from clickloom.operators.profiles import route

    events = profile_events(spark, [
        ("one", 0, "view", "a", "x"), ("one", 5, "view", "b", "x"), ("three", 0, "view", "a", "x"),
        ("three", 1, "view", "b", "x"), ("three", 2, "view", "c", "x"), ("again", 0, "cart", "a", "x"),
        ("again", 10 * MINUTE, "cart", "a", "x"), ("buys", 1, "purchase", "a", "x"), ("buys", 2, "purchase", "b", "x"),
        ("buys", 3, "purchase", "c", "x"),
    ])
    merged = merged_profiles(window_profiles(events)).select(
        "user_id", route(F.col("session_count"), F.size("viewed_products")).alias("route")
    )
    got = {tuple(r) for r in recommend.user_routes(events).collect()}
    assert got == {tuple(r) for r in merged.collect()}
    assert dict(got) == {"one": "cold_start", "three": "personalized", "again": "personalized", "buys": "cold_start"}


def test_upsert_and_request_pairs(spark):
    schema = "user_id string, x int"
    stored = spark.createDataFrame([("a", 1), ("b", 2)], schema)
    fresh = spark.createDataFrame([("b", 3), ("c", 4)], schema)
    assert {tuple(r) for r in features.upsert_features(stored, fresh).collect()} == {("a", 1), ("b", 3), ("c", 4)}
    requests = spark.createDataFrame([(1, ["u", "v", "w"], ["p", "q"])], "id int, user_ids array<string>, product_ids array<string>")
    assert [tuple(r) for r in scoring.request_pairs(requests).collect()] == [(1, 0, "u", "p"), (1, 1, "v", "q")]
