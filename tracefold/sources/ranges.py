"""Large capture files in ranges: an index of where frames begin, and readers that start there.

Frames carry their lengths, so where one begins is only known from the one before.
One pass over a file looks at lengths alone, a window at a time, and writes a row
for about every `range_bytes`: where a frame begins, its number and time, and where
the range ends. After that any number of tasks decode the ranges side by side, and
a reader of a time span passes over the ranges outside it. No task holds more than
a range, so files may be of any size. A file that is still written to is read on
from the last whole frame.
"""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator
from dataclasses import dataclass, replace
from datetime import timezone

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual

from .captures import BATCH, EPOCH, STAMPED, batch_of, frames_of, header_of, listed, register

#: Bytes of a range, about; of the window that lengths are read through; of what holds a header and its optional data.
RANGE_BYTES, WINDOW, HEAD = 64 << 20, 4 << 20, 1 << 16
INDEX = "path string, file_bytes long, range int, start long, stop long, number long, frames long, first_ts timestamp, last_ts timestamp"
INDEX_ARROW = pa.schema([("path", pa.string()), ("file_bytes", pa.int64()), ("range", pa.int32()), ("start", pa.int64()), ("stop", pa.int64()), ("number", pa.int64()), ("frames", pa.int64()), ("first_ts", pa.timestamp("us", tz="UTC")), ("last_ts", pa.timestamp("us", tz="UTC"))])


def system_of(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path in it."""
    return fs.FileSystem.from_uri(path if "://" in path else path.replace(":/", ":///", 1)) if ":/" in path else (fs.LocalFileSystem(), os.path.abspath(path))


def name_of(path: str) -> str:
    return path.rsplit("/", 1)[-1]


class File:
    """A capture file: its header, and frames from any place where one begins."""

    def __init__(self, path: str):
        system, at = system_of(path)
        self.name, self.file = name_of(path), system.open_input_file(at)
        self.size = self.file.size()
        self.header = header_of(self.read(0, min(self.size, HEAD)), self.name)
        if self.header.at > HEAD:
            self.header = header_of(self.read(0, min(self.size, self.header.at)), self.name)

    def read(self, start: int, stop: int) -> bytes:
        return self.file.read_at(stop - start, start)

    def marks(self, start: int) -> Iterator[tuple[int, int, int]]:
        """(start, stop, time in microseconds) of each whole frame from start on; only windows with frames' beginnings are read."""
        h, end = self.header, self.size
        prefix, place, shift = {"2.1": (13, 9, 0), "2.2": (13, 9, 0), "3.0": (20, 16, 12), "3.1": (20, 16, 12), "bin": (13, 4, 0), "plain": (15, 2, 0)}[h.layout]
        started = round((h.start - EPOCH).total_seconds() * 1e6) if h.start else 0
        window, base, at = b"", 0, start
        while at + prefix <= end:
            if not base <= at or min(at + prefix + 8, end) > base + len(window):
                window, base = self.read(at, min(end, at + WINDOW)), at
            k = at - base
            n = struct.unpack_from("<i", window, k + place)[0]
            extra = struct.unpack_from("<i", window, k + shift)[0] if shift else 0
            stop = at + prefix + n + extra
            if n < 0 or extra < 0 or stop > end:
                return  # cut off, or not yet written
            if not shift:
                layout, own = {"bin": ("<i", 8), "plain": ("<q", 7)}.get(h.layout, ("<i", 1))
                time = struct.unpack_from(layout, window, k + own)[0] * 1_000_000
            elif h.sniffer in STAMPED and extra >= 8:
                time = round(struct.unpack_from("<d", window, k + 20)[0] * 1000)
            else:
                second, tick = struct.unpack_from("<iI", window, k + 4)
                time = started + ((tick - h.ticks) & 0xFFFFFFFF) * 1000 if h.layout == "3.1" or h.ticks else second * 1_000_000
            yield at, stop, time
            at = stop

    def frames(self, start: int, stop: int, number: int) -> Iterator[tuple]:
        """The rows of SCHEMA of the frames between two places where frames begin."""
        h, own = self.header, frames_of(self.read(start, stop), replace(self.header, at=0))
        for k, (ts, direction, opcode, conn, body, endpoint, comment, overrides) in enumerate(own, number):
            yield self.name.rsplit(".", 1)[0], self.name, k, ts, direction, opcode, conn, len(body), body, h.layout, h.sniffer, h.build, h.locale, h.start, endpoint, comment, overrides, h.utc_offset


def ranges_of(path: str, range_bytes: int, start: int = 0, number: int = 0) -> Iterator[tuple]:
    """The rows of INDEX of a file, from a place where the frame of that number begins."""
    file, k, first, frames, low, high, stop = File(path), 0, None, 0, 0, 0, 0
    for at, stop, time in file.marks(max(start, file.header.at)):
        first, low, high = (at, time, time) if first is None else (first, min(low, time), max(high, time))
        frames += 1
        if stop - first >= range_bytes:
            yield path, file.size, k, first, stop, number, frames, low, high
            number, first, frames, k = number + frames, None, 0, k + 1
    if first is not None:
        yield path, file.size, k, first, stop, number, frames, low, high


def frame_index(paths: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The ranges (INDEX) of the files of paths (path), one pass over the lengths of each file's frames; unreadable files have none.

    range is the place of a range in its file, number that of its first frame,
    first_ts and last_ts its earliest and latest time (clocks may go back).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows: list[tuple] = []
                try:
                    rows = list(ranges_of(path, range_bytes))
                except (struct.error, IndexError, OSError):
                    continue
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), INDEX_ARROW, strict=True)], schema=INDEX_ARROW)

    return paths.select("path").repartition(max(1, min(paths.count(), 10_000)), "path").mapInArrow(run, INDEX)


def files_of(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path) of the capture files that files, folders or patterns name; listed by Spark, contents unread."""
    files = listed(spark, paths)
    if not files:
        return spark.createDataFrame([], "path string")
    return spark.read.format("binaryFile").load(files).select("path")


def write_index(spark: SparkSession, paths: list[str], to: str, range_bytes: int = RANGE_BYTES) -> None:
    """The frame index of capture files as a table at to."""
    frame_index(files_of(spark, paths), range_bytes).write.mode("overwrite").parquet(to)


@dataclass
class Range(InputPartition):
    path: str
    start: int
    stop: int
    number: int

    def __init__(self, path: str, start: int, stop: int, number: int):
        super().__init__(None)
        self.path, self.start, self.stop, self.number = path, start, stop, number


def decoded_range(x: Range) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []
    for row in File(x.path).frames(x.start, x.stop, x.number):
        rows.append(row)
        if len(rows) == BATCH:
            yield batch_of(rows)
            rows = []
    if rows:
        yield batch_of(rows)


class RangeReader(DataSourceReader):
    """One task for each range of the index; those outside the wanted times, files or numbers are passed over."""

    def __init__(self, options: dict):
        self.index, self.filters = options["index"], []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if isinstance(f, EqualTo | GreaterThan | GreaterThanOrEqual | LessThan | LessThanOrEqual) and f.attribute in (("ts",), ("file_name",)):
                self.filters.append(f)
            yield f  # ranges are coarser than rows, so Spark tests all of them again

    def wanted(self, row: dict) -> bool:
        for f in self.filters:
            if f.attribute == ("file_name",):
                if isinstance(f, EqualTo) and name_of(row["path"]) != f.value:
                    return False
                continue
            at = f.value if f.value.tzinfo else f.value.replace(tzinfo=timezone.utc)
            first, last = row["first_ts"], row["last_ts"]
            if isinstance(f, EqualTo | GreaterThan | GreaterThanOrEqual) and last < at or isinstance(f, EqualTo | LessThan | LessThanOrEqual) and first > at:
                return False
        return True

    def partitions(self) -> list[Range]:
        import pyarrow.dataset as ds

        system, at = system_of(self.index)
        table = ds.dataset(at, filesystem=system, format="parquet", schema=INDEX_ARROW).to_table()
        return [Range(r["path"], r["start"], r["stop"], r["number"]) for r in table.to_pylist() if self.wanted(r)] or [Range("", 0, 0, 0)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        if partition.path:
            yield from decoded_range(partition)


class GrowingReader(DataSourceStreamReader):
    """The frames of a folder's capture files as they are written: the offset has, for each file, the place and number of the next frame.

    A trigger takes up to trigger_bytes; a frame counts once it is whole. Options:
    path (a folder), range_bytes, trigger_bytes.
    """

    def __init__(self, options: dict):
        self.folder, self.range_bytes, self.trigger_bytes = options["path"], int(options.get("range_bytes", RANGE_BYTES)), int(options.get("trigger_bytes", 1 << 30))
        self.reached: dict[str, list[int]] = {}

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        system, at = system_of(self.folder)
        head, left = self.folder[: len(self.folder) - len(at)] if self.folder.endswith(at) else "", self.trigger_bytes
        for info in sorted(system.get_file_info(fs.FileSelector(at, allow_not_found=True)), key=lambda x: x.path):
            if left <= 0 or info.type != fs.FileType.File or not info.path.endswith((".pkt", ".bin")):
                continue
            path = f"{head}{info.path}"
            start, number = self.reached.get(path, (0, 0))
            if info.size <= start:
                continue
            try:
                for x in ranges_of(path, self.range_bytes, start, number):
                    self.reached[path], left = [x[4], x[5] + x[6]], left - (x[4] - x[3])
                    if left <= 0:
                        break
            except (struct.error, IndexError):  # the header isn't whole yet
                continue
        return dict(self.reached)

    def partitions(self, start: dict, end: dict) -> list[Range]:
        out = []
        for path, (stop, _) in end.items():
            self.reached[path] = max(self.reached.get(path, [0, 0]), end[path])
            at, number = start.get(path, (0, 0))
            for x in ranges_of(path, self.range_bytes, at, number):
                if x[3] >= stop:
                    break
                out.append(Range(path, x[3], min(x[4], stop), x[5]))
        return out

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        yield from decoded_range(partition)


def read_ranges(spark: SparkSession, index: str) -> DataFrame:
    """The frames of the indexed files (a folder that write_index() wrote), one task for each range. Rows are those of read_captures()."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    register(spark)
    return spark.read.format("capture").option("index", index).load()


def stream_frames(spark: SparkSession, folder: str, range_bytes: int = RANGE_BYTES, trigger_bytes: int = 1 << 30) -> DataFrame:
    """The frames of a folder's capture files as a stream; files may grow while they are read, and each frame comes once."""
    register(spark)
    return spark.readStream.format("capture").option("path", folder).option("range_bytes", str(range_bytes)).option("trigger_bytes", str(trigger_bytes)).load()
