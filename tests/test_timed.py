"""Timers, corrected windows, state from batch, co-occurrence and notifications, against plain versions."""

import random
from collections import Counter, defaultdict
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from clickloom.operators.cooccurrence import baskets_of, cooccurring, from_similar_items, item_pairs, similar_items
from clickloom.operators.notify import Timing, active_groups, schedule
from clickloom.streaming.runners import start_table
from clickloom.streaming.timed import CLOSED_OUTPUT, SilentSessions, corrected_windows, each_once, timed

EVENT = "event_id long, user_id string, event_type string, product_id string, category_id string, ts_ms long, event_time timestamp"


def batches(spark, path, parts):
    """A stream whose micro-batches are the given (event_id, user, type, product, ts_ms) rows."""
    for part in parts:
        rows = spark.createDataFrame(
            [(i, u, k, p, f"c{p}" if p else None, t) for i, u, k, p, t in part],
            EVENT.rsplit(",", 1)[0]).withColumn("event_time", F.timestamp_millis("ts_ms"))
        rows.coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).parquet(path)


def finish(spark, stream, base):
    start_table(stream, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return [r.asDict() for r in spark.read.schema(stream.schema).parquet(f"{base}/out").collect()]


def test_a_late_event_corrects_a_window_that_was_sent(spark, tmp_path):
    minute = 60_000
    parts = [
        [(1, "u", "view", "a", 1 * minute), (2, "u", "purchase", "b", 2 * minute), (3, "v", "view", None, 3 * minute)],
        [(4, "v", "click", "z", 11 * minute)],  # completes the windows of the first ten minutes
        [(5, "w", "click", "z", 12 * minute)],
        [(6, "u", "view", "c", 9 * minute), (7, "u", "view", "a", 9 * minute)],  # late, but allowed
        [(8, "w", "click", "z", 16 * minute)],  # by now the first windows are gone
        [(9, "w", "click", "z", 17 * minute)],
        [(10, "u", "view", "d", 8 * minute)],  # too late
        [(11, "w", "click", "z", 40 * minute)],
    ]
    stream = corrected_windows(batches(spark, f"{tmp_path}/in", parts))
    rows = finish(spark, stream, tmp_path)
    mine = sorted((r["revision"], r["events"], r["viewed_products"], r["purchased_products"], r["first_activity_ms"],
                   r["last_activity_ms"]) for r in rows if r["user_id"] == "u")
    assert mine == [(0, 2, ["a"], ["b"], minute, 2 * minute), (1, 4, ["a", "c"], ["b"], minute, 9 * minute)]
    others = {(r["user_id"], r["window_start_ms"]): (r["revision"], r["events"]) for r in rows if r["user_id"] != "u"}
    assert others == {("v", 0): (0, 1), ("v", 10 * minute): (0, 1), ("w", 10 * minute): (0, 3)}


def plain_sessions(rows, cap, silence, end):
    """(user, start, last, events, products, reason) of (event_id, user, kind, product, ts) rows"""
    out = []
    for user in {r[1] for r in rows}:
        current = None
        for _, _, _, product, ts in sorted((r for r in rows if r[1] == user), key=lambda r: (r[4], r[0])):
            if current and ts - current[1] > silence:
                out.append((user, *current, "silent"))
                current = None
            current = current or [ts, ts, 0, set()]
            current[1], current[2] = ts, current[2] + 1
            current[3] |= {product} - {None}
            if ts - current[0] > cap:
                out.append((user, *current, "cap"))
                current = None
        if current and current[1] + silence + 1 <= end - 5000:
            out.append((user, *current, "silent"))
    return sorted((u, s, t, min(n, 100), len(p), why) for u, s, t, n, p, why in out)


@pytest.mark.parametrize("cuts", [1, 4])
def test_silent_sessions(spark, tmp_path, cuts):
    rng = random.Random(cuts)
    rows, ts = [], 0
    for i in range(700):
        ts += rng.choice([1, 5, 40, 1, 400, 2]) * 1000
        user = "hot" if i % 3 else f"u{rng.randrange(4)}"
        rows.append((i, user, "view", rng.choice(["a", "b", None, "c"]), ts))
    at = [0, *sorted(rng.sample(range(1, 700), cuts - 1)), 700]
    stream = batches(spark, f"{tmp_path}/in", [rows[a:b] for a, b in zip(at, at[1:])])
    found = finish(spark, timed(stream, "user_id", SilentSessions(120_000, 300_000), CLOSED_OUTPUT, 5000), tmp_path)
    got = sorted((r["user_id"], r["start_time"], r["last_update"], r["event_count"], r["unique_products"], r["reason"])
                 for r in found)
    assert got == plain_sessions(rows, 120_000, 300_000, ts)
    assert {r[-1] for r in got} == {"cap", "silent"}
    assert all(r["duration_ms"] == r["last_update"] - r["start_time"] for r in found)


def test_each_event_once_and_old_keys_leave_the_state(spark, tmp_path):
    hour = 3_600_000
    parts = [[(i, "u", "view", "a", (k + 1) * hour) for i in range(10 * k, 10 * k + 10) for _ in range(2)] for k in range(6)]
    parts[3] += parts[3][:4]
    stream = each_once(batches(spark, f"{tmp_path}/in", parts), ["event_id"], "1 hour")
    query = start_table(stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    query.awaitTermination()
    got = [r.event_id for r in spark.read.schema(stream.schema).parquet(f"{tmp_path}/out").collect()]
    assert sorted(got) == list(range(60))
    assert query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] <= 20


# Co-occurrence


def baskets(spark, found):
    rows = [(u, p, (len(p) + int(u)) % 3 == 0) for u, items in found.items() for p in items]
    return spark.createDataFrame(rows, "user_id string, product_id string, bought boolean")


def test_item_pairs_of_a_skewed_table(spark):
    """One user has most rows, one item nearly all users, and users lie on both sides of the limit."""
    rng = random.Random(1)
    found = {str(u): {f"p{rng.randrange(60)}" for _ in range(rng.randrange(1, 30))} | {"hot"} for u in range(80)}
    found["900"] = {f"p{i}" for i in range(400)} | {"é", "p 1"}
    found["901"] = {"alone"}
    want = Counter(pair for items in found.values() for pair in combinations(sorted(items), 2))
    for light, block, slab in ((10, 7, 3), (10, 100_000, 100_000), (1000, 512, 5)):
        got = item_pairs(baskets(spark, found), light_items=light, block_items=block, slab_users=slab).collect()
        assert {(r.item_a, r.item_b): r.users for r in got} == want and len(got) == len(want)
    none = spark.createDataFrame([], "user_id string, product_id string, bought boolean")
    assert item_pairs(none).count() == 0 and from_similar_items(none, similar_items(item_pairs(none), none), 5).count() == 0


def test_lists_from_similar_items(spark):
    rows = [("u", "view", "a"), ("u", "purchase", "b"), ("v", "view", "a"), ("v", "view", "b"), ("v", "view", "c"), ("w", "view", "c"),
            ("w", "click", "a"), (None, "view", "a"), ("x", "view", None), ("u", "view", "b")]
    events = spark.createDataFrame(rows, "user_id string, event_type string, product_id string")
    assert baskets_of(events).count() == 6
    got = {(r.user_id, r.product_id): (r.position, round(r.score, 6)) for r in cooccurring(events, 5).collect()}
    # a and b share both of their users, c shares one of two with each
    assert got == {
        ("u", "a"): (0, 0.5), ("u", "c"): (1, 0.5), ("v", "a"): (0, 0.5), ("v", "b"): (1, 0.5), ("v", "c"): (2, round(1 / 3, 6)),
        ("w", "a"): (0, 0.5), ("w", "b"): (1, 0.5)}


# Notifications

ALERT = "alertname string, cluster string, service string, severity string, start_ms long, end_ms long"


def plain_active(alerts):
    """{(receiver, name): active times} on a grid of ten milliseconds"""
    names = {a[0] for a in alerts}
    role = {"critical": "critical-alerts", "warning": "warning-alerts"}
    out = defaultdict(list)
    for name in names:
        for receiver in ("critical-alerts", "warning-alerts", "slack-notifications"):
            on = set()
            for t in range(0, 4000, 10):
                live = [a[3] for a in alerts if a[0] == name and a[4] <= t < a[5]]
                own = any(role.get(s, "slack-notifications") == receiver for s in live)
                if own and not (receiver == "warning-alerts" and "critical" in live):
                    on.add(t)
            for t in sorted(on):
                if t - 10 not in on:
                    out[receiver, name].append([t, t])
                out[receiver, name][-1][1] = t + 10
    return dict(out)


def test_inhibition_over_time(spark):
    rng = random.Random(9)
    alerts = [("cut", "c", "s", "warning", 0, 1000), ("cut", "c", "s", "critical", 300, 500), ("cut", "c", "s", "critical", 400, 600),
              ("apart", "c", "s", "warning", 0, 100), ("apart", "c", "s", "critical", 100, 200), ("none", "c", None, "critical", 50, 50),
              ("over", "c", "s", "warning", 100, 200), ("over", "c", "s", "critical", 0, 900), ("odd", None, None, None, 10, 30)]
    for i in range(120):
        start = rng.randrange(0, 300) * 10
        alerts.append((f"n{i % 3}", "c", "s", rng.choice(["warning", "critical", "info", "warning"]), start, start + rng.randrange(0, 40) * 10))
    frame = spark.createDataFrame(alerts, ALERT)
    got = defaultdict(list)
    for r in active_groups(frame, block_ms=500).collect():
        got[r.receiver, r.alertname].append([r.active_since_ms, r.active_until_ms])
    assert {k: sorted(v) for k, v in got.items()} == plain_active(alerts)
    assert got["warning-alerts", "cut"] and len(got["warning-alerts", "cut"]) == 2


def test_schedule(spark):
    timing = Timing(group_wait=30, group_interval=100, repeat_interval=250)  # repeats after three steps
    alerts = [("a", "c", "s", "info", 1000, 2000), ("a", "c", "s", "info", 1300, 1400), ("b", "c", "s", "critical", 0, 20),
              ("d", "c", "s", "warning", 0, 900), ("d", "c", "s", "critical", 100, 500)]
    rows = schedule(spark.createDataFrame(alerts, ALERT), timing, block_ms=300).collect()
    got = defaultdict(list)
    for r in sorted(rows, key=lambda r: r.sent_ms):
        got[r.receiver, r.alertname, r.active_since_ms].append((r.sent_ms, r.kind))
    assert got == {
        ("slack-notifications", "a", 1000): [(1030, "firing"), (1330, "firing"), (1630, "repeat"), (1930, "repeat"), (2030, "resolved")],
        ("critical-alerts", "d", 100): [(130, "firing"), (430, "repeat")],
        ("warning-alerts", "d", 0): [(30, "firing")],
        ("warning-alerts", "d", 500): [(530, "firing"), (830, "repeat")],
    }  # b was over before its first message
