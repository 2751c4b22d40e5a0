"""Lines of append-only text files with their place, for logs that number nothing themselves.

``spark.read.format("lines")`` cuts files at byte ranges and gives ``(file, at, line)``; ``at`` is the byte at which a line starts,
so ``(file, at)`` orders all lines however the files are cut. Files count in the order of their names. As a stream the source
reads what was appended since, whole lines only; its offset is the length read of each file.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

#: Bytes of a range, of one read, and of the lines in one batch.
RANGE_BYTES, CHUNK_BYTES, BATCH_BYTES = 128 << 20, 1 << 20, 4 << 20
SCHEMA = pa.schema([("file", pa.string()), ("at", pa.int64()), ("line", pa.string())])


class Range(InputPartition):
    """The lines of ``file`` that start in the bytes from ``lo`` up to ``hi``."""

    def __init__(self, file: str, lo: int, hi: int):
        self.file, self.lo, self.hi = file, lo, hi


def lines_in(f, lo: int, hi: int, chunk: int = CHUNK_BYTES) -> Iterator[tuple[int, bytes]]:
    """``(start, line)`` of the lines of an open file that start in ``[lo, hi)``; what follows the last newline is a line too."""
    at = pos = max(lo - 1, 0)  # a line starts at lo if the byte before it ends one
    f.seek(pos)
    inside, parts = lo > 0, []
    while at < hi and (data := f.read(chunk)):
        start = 0
        while (end := data.find(b"\n", start)) >= 0:
            if not inside:
                yield at, b"".join([*parts, data[start:end]])
            inside, parts, start = False, [], end + 1
            at = pos + start
            if at >= hi:
                return
        if not inside:
            parts.append(data[start:])
        pos += len(data)
    last = b"".join(parts)
    if last and not inside and at < hi:
        yield at, last


def whole_lines(f, lo: int, size: int, chunk: int = CHUNK_BYTES) -> int:
    """The end of the last line that a newline ends in the bytes ``[lo, size)``, or ``lo``."""
    hi = size
    while hi > lo:
        start = max(lo, hi - chunk)
        f.seek(start)
        if (found := f.read(hi - start).rfind(b"\n")) >= 0:
            return start + found + 1
        hi = start
    return lo


class _Lines:
    def __init__(self, options: dict):
        if "path" not in options:
            raise ValueError("the lines source needs a path")
        self.path, self.most = options["path"], int(options.get("rangeBytes", RANGE_BYTES))

    def files(self) -> dict[str, int]:
        """Lengths of all files under the path, by name; hidden ones do not count."""
        store, root = fs.FileSystem.from_uri(self.path)
        info = store.get_file_info(root)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        found = [info] if info.is_file else store.get_file_info(fs.FileSelector(root, recursive=True))
        return {x.path: x.size for x in sorted(found, key=lambda x: x.path) if x.is_file and x.base_name[0] not in "._"}

    def ranges(self, file: str, lo: int, hi: int) -> list[Range]:
        return [Range(file, at, min(at + self.most, hi)) for at in range(lo, hi, self.most)]

    def read(self, part: Range | None) -> Iterator[pa.RecordBatch]:
        if part is None:  # what Spark asks for where there are no ranges
            return
        store, _ = fs.FileSystem.from_uri(self.path)
        starts, lines, held = [], [], 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([part.file] * len(starts), pa.string()), pa.array(starts, pa.int64()), pa.array(lines, pa.string())], schema=SCHEMA)

        with store.open_input_file(part.file) as f:
            for at, line in lines_in(f, part.lo, part.hi):
                text = line.removesuffix(b"\r").decode("utf-8", "replace")
                starts.append(at)
                lines.append(text.removeprefix("﻿") if at == 0 else text)
                held += len(line) + 8
                if held >= BATCH_BYTES:
                    yield batch()
                    starts, lines, held = [], [], 0
        if starts:
            yield batch()


class LineReader(_Lines, DataSourceReader):
    def partitions(self) -> list[Range]:
        return [r for file, size in self.files().items() for r in self.ranges(file, 0, size)]


class LineStream(_Lines, DataSourceStreamReader):
    """Offsets are lengths by file, so they grow with the number of files, as any listing does."""

    def __init__(self, options: dict):
        super().__init__(options)
        self.ends: dict[str, int] = {}

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        store, _ = fs.FileSystem.from_uri(self.path)
        for file, size in self.files().items():
            done = self.ends.get(file, 0)
            if size > done:
                with store.open_input_file(file) as f:
                    self.ends[file] = whole_lines(f, done, size)
        return {k: v for k, v in self.ends.items() if v}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        short = sorted(k for k, v in end.items() if v < start.get(k, 0))
        if short:
            raise ValueError(f"files of an append-only log became shorter: {short}")
        return [r for file in sorted(end) for r in self.ranges(file, start.get(file, 0), end[file])]


class LineSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "lines"

    def schema(self) -> str:
        return "file string, at long, line string"

    def reader(self, schema) -> LineReader:
        return LineReader(self.options)

    def streamReader(self, schema) -> LineStream:
        return LineStream(self.options)


def read_lines(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``(file, at, line)`` of all lines under ``path``, blank ones included."""
    spark.dataSource.register(LineSource)
    return spark.read.format("lines").option("rangeBytes", range_bytes).load(path)


def stream_lines(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``(file, at, line)`` of what is appended under ``path``; a line is read once its newline is there."""
    spark.dataSource.register(LineSource)
    return spark.readStream.format("lines").option("rangeBytes", range_bytes).load(path)
