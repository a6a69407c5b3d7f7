"""Figures of the last answers, kept block by block, against numpy over the plain window."""

import numpy as np
import pytest

from clickloom.streaming.processors import keyed
from clickloom.streaming.runners import start_table
from clickloom.streaming.service import SERVICE_OUTPUT, ServiceFigures, SortedBlocks


def plain(values):
    x = np.array(values, float)
    if not len(x):
        return [0.0] * 5
    kept = x[x < x.mean() + 3 * x.std()]
    kept = kept if len(kept) else x
    return [*np.percentile(kept, [50, 95, 99]), kept.mean(), x.std()]


@pytest.mark.parametrize("kind", ["spread", "ties", "outliers", "one value"])
def test_sorted_blocks_through_a_moving_window(kind):
    draw = np.random.default_rng(5)
    make = {
        "spread": lambda n: draw.normal(50, 10, n), "ties": lambda n: draw.integers(0, 9, n).astype(float),
        "outliers": lambda n: np.where(draw.random(n) < 0.02, 5000.0, draw.random(n)), "one value": lambda n: np.full(n, 7.0),
    }[kind]
    stored, index, window = {}, [], []
    for n in (3, 0, 400, 1, 90, 5000, 2, 700):
        blocks = SortedBlocks(index, lambda name: stored[name], size=16)
        come = make(n)
        both = [*window, *come]
        go, window = both[:max(0, len(both) - 1000)], both[-1000:]
        blocks.change(come, np.array(go, float))
        for name in blocks.changed:
            stored[name] = blocks.at_hand[name].tolist()
        for name in blocks.dropped:
            stored.pop(name, None)
        index = blocks.index
        *figures, count = blocks.figures()
        assert count == len(window) and figures == pytest.approx(plain(window), abs=1e-9)
        assert sorted(stored) == sorted(row[0] for row in index)
        assert sorted(window) == [x for row in index for x in stored[row[0]]]
    if kind == "spread":
        few = SortedBlocks(index, lambda name: stored[name], size=16)
        few.change(np.array([50.0]), np.array([window[0]]))
        few.figures()
        assert len(few.changed) <= 2 and len(few.at_hand) < len(index) / 3


def test_periods_over_micro_batches(spark, tmp_path):
    draw = np.random.default_rng(9)
    rows = []
    for i in range(3000):
        ok = [True, True, True, False, None][draw.integers(0, 5)]
        latency = None if draw.random() < 0.05 else float(round(draw.exponential(40), 3))
        rows.append((i, int(i % 7 == 0), 1000 + i * 10, latency, ok, [True, False, None][draw.integers(0, 3)]))
    schema = "event_id long, service long, ts_ms long, latency_ms double, ok boolean, cache_hit boolean"
    for at in range(0, 3000, 701):
        spark.createDataFrame(rows[at:at + 701], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    sent = keyed(stream, "service", ServiceFigures(2000, 600), SERVICE_OUTPUT)
    start_table(sent, f"{tmp_path}/out", f"{tmp_path}/checkpoint").awaitTermination()
    got = {(r.service, r.period_ms): r for r in spark.read.schema(sent.schema).parquet(f"{tmp_path}/out").collect()}
    want = 0
    for service in (0, 1):
        mine = [r for r in rows if r[1] == service]
        periods = sorted({r[2] // 2000 for r in mine})
        for period in periods[:-1]:
            want += 1
            seen = [r for r in mine if r[2] // 2000 <= period]
            answers = [r[3] for r in seen if r[4] and r[3] is not None][-600:]
            r = got[service, period * 2000]
            assert [r.p50, r.p95, r.p99, r["mean"], r.std] == pytest.approx(plain(answers), abs=1e-9)
            assert r.total_predictions == len(answers)
            assert r.error_rate == pytest.approx(min(600, sum(not x[4] for x in seen)) / len(answers))
            hits, misses = (sum(x[5] is kind for x in seen) for kind in (True, False))
            assert r.cache_hit_rate == pytest.approx(hits / (hits + misses))
            assert r.throughput == pytest.approx(len(answers) / ((seen[-1][2] - seen[0][2]) / 1000))
    assert want == len(got)


def test_no_rows(spark, tmp_path):
    schema = "event_id long, service long, ts_ms long, latency_ms double, ok boolean, cache_hit boolean"
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
    sent = keyed(stream, "service", ServiceFigures(), SERVICE_OUTPUT)
    start_table(sent, f"{tmp_path}/out", f"{tmp_path}/checkpoint").awaitTermination()
    assert not [r for f in tmp_path.glob("out/*") for r in spark.read.schema(sent.schema).parquet(str(f)).collect()]
