"""Lines of growing files by byte ranges."""

import random

from clickloom.sources.ranges import LineReader, stream_lines
from clickloom.streaming.runners import start_table


def test_every_line_belongs_to_one_range(tmp_path):
    rng = random.Random(1)
    for trial in range(60):
        data = "".join(rng.choice(["\n", "a", "é", "long line ", "\r\n"]) for _ in range(rng.randrange(200))).encode()
        (tmp_path / f"f{trial}.txt").write_bytes(data)
        (tmp_path / "_ignored.txt").write_bytes(b"x\n")
        size = rng.choice([1, 2, 7, 50, 1000])
        reader = LineReader({"path": str(tmp_path), "suffix": f"f{trial}.txt", "rangebytes": str(size)})
        end = reader.latestOffset()
        stop = rng.choice([None, *[i + 1 for i, b in enumerate(data) if b == 10]])  # an earlier run ended behind some line
        start = {} if stop is None else {p: stop for p in end}
        rows = [r for part in reader.partitions(start, end) for b in reader.read(part) for r in b.to_pylist()]
        begin, whole = stop or 0, data.rfind(b"\n") + 1
        want, at = [], begin
        for line in data[begin:whole].split(b"\n")[:-1]:
            want.append((at, line.decode()))
            at += len(line) + 1
        assert sorted((r["position"], r["line"]) for r in rows) == want


def test_a_stream_goes_on_inside_a_file_that_grew(spark, tmp_path):
    source, got = tmp_path / "in", []
    source.mkdir()
    for text in ("a\nb\nhalf", "a\nb\nhalf of it\nc\n", None, "a\nb\nhalf of it\nc\nd\n"):
        if text is not None:
            (source / "one.log").write_text(text)
        (source / "two.log").write_text("x\n")
        stream = stream_lines(spark, str(source), suffix=".log", range_bytes=3)
        start_table(stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint").awaitTermination()
        rows = spark.read.schema(stream.schema).parquet(f"{tmp_path}/out").collect()
        got.append(sorted(r.line for r in rows))
    assert got == [["a", "b", "x"], ["a", "b", "c", "half of it", "x"], ["a", "b", "c", "half of it", "x"],
                   ["a", "b", "c", "d", "half of it", "x"]]
