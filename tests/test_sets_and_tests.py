"""Bitmap blocks of profile sets, and two-sample tests, against plain versions and known values."""

import math
import random

import pytest
from pyspark.sql import functions as F

from clickloom.operators.bitmaps import blocks_of, item_numbers, members, merged_blocks, numbered, profile_events, set_sizes
from clickloom.operators.drift_tests import chi_square, column_tests, kolmogorov_p, number_distances, upper_gamma

EVENT = "user_id string, event_type string, product_id string, category_code string, ts_ms long"


def test_sets_over_many_blocks(spark):
    """A user with items in several blocks, rare and frequent items, items without a name, empty tables."""
    rng = random.Random(1)
    rows = [("hot", rng.choice(["view", "purchase"]), f"p{i}", f"c{i % 5}", i) for i in range(70_000)]
    rows += [(f"u{i % 9}", rng.choice(["view", "purchase", "click"]), rng.choice([None, "p1", "p2", f"p{rng.randrange(70_000)}"]),
              rng.choice([None, "", "c1", "c9"]), i) for i in range(500)]
    entries = profile_events(spark.createDataFrame(rows, EVENT))
    numbers = item_numbers(entries, part_items=1000).cache()
    for domain, count in numbers.groupBy("domain").agg(F.count("*")).collect():
        got = sorted(r.number for r in numbers.where(F.col("domain") == domain).collect())
        assert got == list(range(1, count + 1))
    found = numbered(entries, numbers)
    halves = [blocks_of(found.where(F.pmod("window_start_ms", F.lit(1_200_000)) == p)) for p in (0, 600_000)]
    blocks = merged_blocks(*halves).cache()
    assert blocks.where("user_id = 'hot'").count() > 4 and blocks.where("octet_length(bitmap) <> 4096").count() == 0
    want = {(u, "viewed" if k == "view" else "purchased", p) for u, k, p, _, _ in rows if k != "click" and p}
    want |= {(u, "category", c) for u, k, _, c, _ in rows if k != "click" and c}
    got = [tuple(r) for r in members(blocks, numbers).collect()]
    assert set(got) == want and len(got) == len(want)
    for r in set_sizes(blocks).collect():
        assert [r.viewed_items, r.purchased_items, r.category_items] == [
            sum(w[:2] == (r.user_id, kind) for w in want) for kind in ("viewed", "purchased", "category")]
    none = profile_events(spark.createDataFrame([], EVENT))
    empty = item_numbers(none)
    assert empty.count() == 0 and members(blocks_of(numbered(none, empty)), empty).count() == 0


@pytest.mark.parametrize(("x", "k", "p"), [
    (3.841458820694124, 1, 0.05), (5.991464547107979, 2, 0.05), (18.307038053275146, 10, 0.05), (0, 3, 1.0), (float("inf"), 3, 0.0),
    (124.3421134, 100, 0.05), (1000, 1000, 0.4940522), (2, 1, 0.1572992070502851), (0.1, 7, 0.99999777)])
def test_chi_square_tail(x, k, p):
    assert upper_gamma(k / 2, x / 2) == pytest.approx(p, abs=2e-6)


def test_kolmogorov_tail(spark):
    for x, p in ((1.3580986393225507, 0.05), (1.0, 0.26999967), (0.5, 0.9639452), (0.2, 1.0), (0.0, 1.0), (3.0, 3.05e-8)):
        got = spark.range(1).select(kolmogorov_p(F.lit(x / math.sqrt(5000.0)), F.lit(10_000), F.lit(10_000)).alias("p")).first().p
        assert got == pytest.approx(p, abs=1e-6)


def test_odd_columns(spark):
    frame = lambda rows: spark.createDataFrame(rows, "x double, flat double, k string, one string")
    nan, inf = float("nan"), float("inf")
    a = frame([(1.0, 2.0, "a", "z"), (2.0, 2.0, "b", "z"), (nan, None, None, "z"), (inf, 2.0, "a", "z")])
    b = frame([(1.0, 2.0, "a", "z"), (3.0, 2.0, "new", "z"), (None, 2.0, "a", "z")])
    found = {r["column"]: r for r in number_distances(a, b, ["x", "flat"]).collect()}
    assert found["x"].ks == 0.5 and found["x"].wasserstein == pytest.approx(0.5 / math.sqrt(0.5)) and found["x"].baseline_rows == 2
    assert found["flat"].ks == 0 and found["flat"].wasserstein == 0 and found["flat"].ks_p == 1
    tested = {r["column"]: r for r in chi_square(a, b, ["k", "one"]).collect()}
    assert tested["k"].chi_square == inf and tested["k"].chi_square_p == 0
    assert tested["one"].freedom == 0 and tested["one"].chi_square_p == 1
    for small, names in ((1000, {"ks_p", "chi_square_p"}), (0, {"wasserstein", "jensen_shannon"})):
        rows = column_tests(a, b, ["x", "flat"], ["k", "one"], small=small).collect()
        assert {r.test for r in rows} == names and {r["column"]: r.drifted for r in rows}["k"]
    empty = a.limit(0)
    rows = {r["column"]: r for r in column_tests(a, empty, ["x"], ["k"]).collect()}
    assert set(rows) == {"x", "k"} and rows["x"].score is None and not rows["x"].drifted and not rows["k"].drifted
