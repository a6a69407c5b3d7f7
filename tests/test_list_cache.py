"""Versions of the cold-start list and the lists that users keep, against plain loops."""

import random
from collections import Counter

from clickloom.operators.list_cache import list_versions, stored_lists

EVENTS = "event_id long, user_id string, event_type string, product_id string, ts_ms long"


def draw(seed, rows=600, span=1000):
    """A third of the rows belongs to one user, some to none; times repeat."""
    rng = random.Random(seed)
    return [(
        i, rng.choice(["hot", "hot", "u1", "u2", "u3", None]), rng.choice(["view", "purchase", "click"]),
        rng.choice([None, "p1", "p1", "p2", "p3", "p4", "p5"]), rng.randrange(200, 200 + span) // 2 * 2) for i in range(rows)]


def best(rows, limit):
    found = Counter(r[3] for r in rows if r[2] in ("view", "purchase") and r[3] is not None)
    return [p for p, _ in sorted(found.items(), key=lambda x: (x[1], x[0]), reverse=True)[:limit]]


def plain_versions(rows, limit, period):
    first, last = (edge(r[4] for r in rows) // period * period for edge in (min, max))
    out = {}
    for at in range(first, last + 1, period):
        popular = best([r for r in rows if r[4] < at], limit)
        trending = best([r for r in rows if at - period <= r[4] < at], limit)
        out[at] = (popular + [p for p in trending if p not in popular])[:limit]
    return out


def test_versions(spark):
    rows = draw(1) + [(9999, "u1", "view", "late", 3050)]  # periods without events lie between
    for limit in (1, 3, 20):
        found = list_versions(spark.createDataFrame(rows, EVENTS), limit, 100).collect()
        assert {r.period_ms: r.products for r in found} == plain_versions(rows, limit, 100) and len(found) == 29
    assert list_versions(spark.createDataFrame([], EVENTS), 3, 100).collect() == []
    nothing = list_versions(spark.createDataFrame([(1, "u", "click", None, 5)], EVENTS), 3, 100).collect()
    assert [tuple(r) for r in nothing] == [(0, [])]


def test_stored_lists(spark):
    rows = draw(2)
    versions = plain_versions(rows, 3, 100)
    events = spark.createDataFrame(rows, EVENTS)
    found = stored_lists(
        events.select("user_id", "ts_ms", "event_id"), list_versions(events, 3, 100), list_ms=40, period_ms=100).collect()
    want = {}
    for user in {r[1] for r in rows}:
        made = None
        for r in sorted((r for r in rows if r[1] == user), key=lambda r: (r[4], r[0])):
            reused = made is not None and r[4] - made < 40
            made = made if reused else r[4]
            want[r[0]] = (user, made, reused, versions[made // 100 * 100])
    assert {r.event_id: (r.user_id, r.made_at_ms, r.reused, r.products) for r in found} == want and len(found) == len(rows)
    assert any(v[2] for v in want.values()) and any(want[r[0]][3] != versions[r[4] // 100 * 100] for r in rows)
