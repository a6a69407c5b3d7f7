"""Lines of growing files as a stream whose offsets are positions inside the files.

Spark's own file source knows a file as read or not read. This one goes on where the last committed micro-batch ended, be it in the
middle of a file: an offset is the position behind the last whole line of each file, a micro-batch is what was added since then, and its
tasks are byte ranges of bounded size, so one large file is read by many tasks. A line belongs to the range it begins in.
Files may grow at their end, but must not be changed otherwise. They are opened by ``pyarrow.fs``, on any file system it knows, such as
``file:``, ``hdfs:`` and ``s3:``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from ..session import prepare

RANGE_BYTES = 32 * 1024 * 1024
READ_BYTES = 1024 * 1024
SCHEMA = "file string, position long, line string"
ARROW = pa.schema([("file", pa.string()), ("position", pa.int64()), ("line", pa.string())])


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class ByteRange(InputPartition):
    def __init__(self, path: str, begin: int, end: int):
        self.path, self.begin, self.end = path, begin, end


def _lines(source: pa.NativeFile, begin: int, end: int) -> Iterator[tuple[int, bytes]]:
    """(position, line) of the lines that begin in [begin, end)."""
    at, rest = begin, b""
    if begin:  # the line that covers the byte before belongs to the range before
        source.seek(begin - 1)
        at, skipping = begin - 1, True
    else:
        source.seek(0)
        skipping = False
    while at < end:
        data = source.read(READ_BYTES)
        if not data:
            return
        rest += data
        pieces = rest.split(b"\n")
        rest = pieces.pop()
        for piece in pieces:
            if skipping:
                skipping = False
            elif at < end:
                yield at, piece
            at += len(piece) + 1


class LineReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.suffix = options.get("suffix", "")
        self.range_bytes = int(options.get("rangebytes", RANGE_BYTES))
        self.until = int(options["until"]) if options.get("until") else None

    def initialOffset(self) -> dict:
        return {}

    def _whole_lines(self, system: fs.FileSystem, info: fs.FileInfo) -> int:
        """The position behind the last line that is complete."""
        size = info.size if self.until is None else min(info.size, self.until)
        with system.open_input_file(info.path) as source:
            while size:
                begin = max(0, size - READ_BYTES)
                source.seek(begin)
                found = source.read(size - begin).rfind(b"\n")
                if found >= 0:
                    return begin + found + 1
                size = begin
        return 0

    def latestOffset(self) -> dict:
        system, path = _opened(self.path)
        infos = system.get_file_info(fs.FileSelector(path, recursive=True, allow_not_found=True))
        files = [i for i in infos if i.type == fs.FileType.File and i.path.endswith(self.suffix)
                 and not i.base_name.startswith(("_", "."))]
        return {i.path: end for i in sorted(files, key=lambda i: i.path) if (end := self._whole_lines(system, i))}

    def partitions(self, start: dict, end: dict) -> list[ByteRange]:
        return [
            ByteRange(path, begin, min(begin + self.range_bytes, stop))
            for path, stop in end.items() for begin in range(start.get(path, 0), stop, self.range_bytes)]

    def read(self, partition: ByteRange) -> Iterator[pa.RecordBatch]:
        system, _ = _opened(self.path)
        with system.open_input_file(partition.path) as source:
            held: list[tuple[int, bytes]] = []

            def batch() -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays([
                    pa.repeat(pa.scalar(partition.path), len(held)), pa.array([at for at, _ in held], pa.int64()),
                    pa.array([line.decode("utf-8", "replace") for _, line in held], pa.string())], schema=ARROW)

            for found in _lines(source, partition.begin, partition.end):
                held.append(found)
                if len(held) == 8192:
                    yield batch()
                    held = []
            yield batch()


class LineRanges(DataSource):
    @classmethod
    def name(cls) -> str:
        return "line_ranges"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> LineReader:
        return LineReader(self.options)


def stream_lines(
    spark: SparkSession, path: str, *, suffix: str = "", range_bytes: int = RANGE_BYTES, until: int | None = None,
) -> DataFrame:
    """(file, position, line) of the files in a folder; with ``until`` no file is read beyond that position for now."""
    prepare(spark).dataSource.register(LineRanges)
    reader = spark.readStream.format("line_ranges").option("suffix", suffix).option("rangebytes", range_bytes)
    return (reader if until is None else reader.option("until", until)).load(path)
