"""Order-dependent building blocks against brute force on small frames."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.operators.anchored import with_segment
from clickloom.operators.ordered import block_start, exact_percentiles, running, top_rows, trailing_sums


def frame(spark, seed, users=3, rows=200, span=5000):
    rng = random.Random(seed)
    data = [(f"u{rng.randrange(users)}", rng.randrange(span), i, rng.choice([None, rng.randrange(100)]))
            for i in range(rows)]
    return data, spark.createDataFrame(data, "user string, ts long, id long, v long")


@pytest.mark.parametrize("how", ["max", "sum", "last"])
@pytest.mark.parametrize("before", [False, True])
def test_running(spark, how, before):
    data, df = frame(spark, 1)
    got = {
        r["id"]: r["out"]
        for r in running(df, ["user"], ["ts", "id"], F.col("v"), "out", how=how,
                         block=block_start(F.col("ts"), 300), before=before).collect()
    }
    for user, ts, i, v in data:
        seen = sorted((t, j, x) for u, t, j, x in data if u == user and ((t, j) < (ts, i) or (not before and j == i)))
        values = [x for _, _, x in seen if x is not None]
        want = None if not values else {"max": max, "sum": sum, "last": lambda x: x[-1]}[how](values)
        assert got[i] == want


def test_running_without_keys(spark):
    data, df = frame(spark, 2)
    out = running(df, [], ["ts", "id"], F.lit(1), "n", how="sum", block=block_start(F.col("ts"), 500))
    assert [r["n"] for r in out.orderBy("ts", "id").collect()] == list(range(1, len(data) + 1))


@pytest.mark.parametrize("how", ["max", "sum", "last"])
@pytest.mark.parametrize("keys", [[], ["user"]])
def test_two_levels_of_blocks_give_what_one_gives(spark, how, keys):
    _, df = frame(spark, 4, rows=400)
    rows = df.withColumn("user", F.when(F.col("user") != "u1", F.col("user")))
    one, two = (
        {r["id"]: r["out"] for r in running(
            rows, keys, ["ts", "id"], F.col("v"), "out", how=how, block=block_start(F.col("ts"), 100), coarse=coarse).collect()}
        for coarse in (None, 700))
    assert one == two and len(one) == 400


@pytest.mark.parametrize("include", [True, False])
def test_trailing_sums(spark, include):
    data, df = frame(spark, 3, span=3000)
    out = trailing_sums(df, ["user"], "ts", {"n": F.lit(1), "s": F.coalesce("v", F.lit(0))}, 60,
                        block_width=200, include_lower=include)
    for r in out.collect():
        low = r["ts"] - 60
        rows = [x for u, t, _, x in data if u == r["user"] and (low <= t if include else low < t) and t <= r["ts"]]
        assert (r["n"], r["s"]) == (len(rows), sum(x or 0 for x in rows))
    assert out.count() == len(data)


def brute_segments(times, span, closes):
    """Start per event of one key, events in order."""
    out, start, done = [], None, True
    for t in times:
        if closes:
            if done:
                start, done = t, False
            out.append(start)
            done = t - start > span
        else:
            if start is None or t - start >= span:
                start = t
            out.append(start)
    return out


@pytest.mark.parametrize("closes", [True, False])
@pytest.mark.parametrize("seed,span,rows,cap", [(4, 5000, 300, 100), (5, 900, 400, 100), (6, 60000, 200, 100),
                                                (7, 4000, 300, 37), (8, 200, 500, 7)])
def test_segments(spark, closes, seed, span, rows, cap):
    data, df = frame(spark, seed, users=4, rows=rows, span=span)
    out = with_segment(df, ["user"], "ts", "id", cap, closes=closes, start="s", chunk=cap * 3)
    got = {r["id"]: r["s"] for r in out.collect()}
    for user in {d[0] for d in data}:
        events = sorted((t, i) for u, t, i, _ in data if u == user)
        for (_, i), want in zip(events, brute_segments([t for t, _ in events], cap, closes)):
            assert got[i] == want


def test_segments_of_hot_key_with_equal_times(spark):
    data = [("hot", (i // 7) * 10, i, 0) for i in range(700)] + [("cold", 5, 10_000, 0)]
    df = spark.createDataFrame(data, "user string, ts long, id long, v long")
    out = {r["id"]: r["s"] for r in with_segment(df, ["user"], "ts", "id", 50, closes=True, start="s", chunk=100).collect()}
    times = [d[1] for d in data[:700]]
    assert [out[i] for i in range(700)] == brute_segments(times, 50, True)
    assert out[10_000] == 5


@pytest.mark.parametrize("values", [
    [5.0], [1.0, 2.0], [3.0] * 50, list(range(100)),
    [1.7e12 + i / 10 for i in range(301)],            # a narrow range far from zero
    [-5.0, -4.5, 0.0, 0.0, 1e-9, 1e9, 1e300, -1e300],
    [1.0] * 1000 + [2.0, 3.0, 1000.0],                # one value holds nearly all rows
])
def test_percentiles(spark, values):
    probabilities = [0.0, 0.05, 0.25, 0.5, 0.95, 0.999, 1.0]
    df = spark.createDataFrame([("a", float(v)) for v in values] + [("a", None), ("a", float("nan")), ("b", 7.0)],
                               "g string, v double")
    rows = {(r["g"], r["p"]): r for r in exact_percentiles(df, ["g"], F.col("v"), probabilities).collect()}
    ordered = sorted(values)
    for p in probabilities:
        row = rows["a", p]
        assert row["percentile"] == pytest.approx(np.percentile(values, p * 100), rel=1e-12)
        assert row["at_position"] == ordered[min(int(len(values) * p), len(values) - 1)]
        assert row["rows"] == len(values)
        assert rows["b", p]["percentile"] == 7.0


def test_random_percentiles(spark):
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.lognormal(3, 1, 500), -rng.random(300), np.repeat(12.5, 200)])
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    probabilities = [0.01, 0.1, 0.333, 0.5, 0.9, 0.99]
    for r in exact_percentiles(df, [], F.col("v"), probabilities).collect():
        assert r["percentile"] == pytest.approx(np.percentile(values, r["p"] * 100), rel=1e-12)


def test_row_order_does_not_matter(spark):
    _, df = frame(spark, 9)
    one = with_segment(df.orderBy("id"), ["user"], "ts", "id", 100, closes=True, chunk=300)
    two = with_segment(df.repartition(5, F.rand(1)), ["user"], "ts", "id", 100, closes=True, chunk=300)
    assert sorted(map(tuple, one.collect()), key=str) == sorted(map(tuple, two.collect()), key=str)


def test_top_rows_cuts_before_the_shuffle(spark):
    _, df = frame(spark, 10)
    plan = top_rows(df, ["user"], [F.desc("ts")], 3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_python_workers_need_no_copy_of_the_package(tmp_path):
    """A pickled worker function loads in an interpreter that cannot import the package."""
    import subprocess
    import sys

    from pyspark import cloudpickle

    from clickloom.operators import anchored
    from clickloom.streaming.processors import LateClasses

    path = tmp_path / "f.pkl"
    path.write_bytes(cloudpickle.dumps((anchored._whole_groups, LateClasses())))
    code = f"import pickle; f, p = pickle.load(open({str(path)!r}, 'rb')); print(list(f([], ['a'])), p.slack)"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert out.stdout.strip() == "[] 5000", out.stderr
