"""Capture files, one row per frame.

Files are listed and read by Spark, from any file system that it knows, many at
a time; a frame carries its length, so each file is decoded from its start by one
task. Layouts: version 2.1, 2.2, 3.0 and 3.1 headers, files without a header, and
.bin files. Written files are a Spark data source of their own.
"""

from __future__ import annotations

import ipaddress
import os
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamReader, WriterCommitMessage
from pyspark.sql.types import StructType

SCHEMA = "capture_id string, file_name string, number int, ts timestamp, direction string, opcode int, conn_idx int, length int, payload binary, layout string, sniffer_id int, client_build int, client_locale string, header_start timestamp, endpoint string, comment string, overrides array<struct<guid_low:bigint,guid_high:bigint,phase:int>>, utc_offset_seconds int"
EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
#: Directions by their mark in a frame (fixed values).
MARKS = {0x47534D53: "ServerToClient", 0x47534D43: "ClientToServer", 0x4E425F53: "BNServerToClient"}
MARK_OF = {v: k for k, v in MARKS.items()} | {"BNClientToServer": 0x4E425F43}
OTHER_MARK = "BNClientToServer"
BY_CODE = ("ClientToServer", "ServerToClient", "BNClientToServer", "BNServerToClient")
VERSIONS = {0x201: "2.1", 0x202: "2.2", 0x300: "3.0", 0x301: "3.1"}
#: Recorder ids with their own optional data (fixed values).
TICKED, STAMPED, SOCKETED = 10, (0x15, 0x16), ord("T")
#: Build of files whose recorder (version 0x0102) lost it, and the mark of a phase override in a frame's optional data (fixed values).
LOST_BUILD, OVERRIDE = 65560, 0x50
BATCH = 4096


@dataclass
class Header:
    layout: str
    at: int = 0
    sniffer: int = 0
    sniffer_version: int = 0
    build: int = 0
    locale: str | None = None
    start: datetime | None = None
    ticks: int = 0
    utc_offset: int | None = None


def header_of(data: bytes, name: str) -> Header:
    """What the first bytes of a file say; a file with an unknown version is read as one without a header."""
    if name.endswith(".bin"):
        return Header("bin")
    layout = VERSIONS.get(struct.unpack_from("<H", data, 3)[0]) if data[:3] == b"PKT" and len(data) >= 5 else None
    if layout is None:
        return Header("plain")
    h = Header(layout, 5)
    if layout == "2.1":
        h.build, h.at = struct.unpack_from("<H", data, 5)[0], 5 + 2 + 40
        return h
    h.sniffer = data[5]
    if layout == "2.2":
        h.build, h.at = struct.unpack_from("<H", data, 6)[0], 8 + 4 + 20 + 64
        h.locale = text(data[8:12])
        return h
    h.build, h.locale, at = struct.unpack_from("<I", data, 6)[0], text(data[10:14]), 14 + 40
    if layout == "3.0":
        n = struct.unpack_from("<i", data, at)[0]
        if h.sniffer == TICKED and n >= 8:
            start, h.ticks = struct.unpack_from("<II", data, at + 4)
            h.start = EPOCH + timedelta(seconds=start)
        h.at = at + 4 + n
        return h
    start, h.ticks, n = struct.unpack_from("<IIi", data, at)
    h.start, own = EPOCH + timedelta(seconds=start), data[at + 12 : at + 12 + n]
    if h.sniffer == ord("S"):
        h.sniffer_version = struct.unpack_from("<h", own, 1)[0] if n >= 3 and own[0] == 0xFF else 0x105
        if h.sniffer_version >= 0x107 and n >= 11:
            h.start = datetime(1601, 1, 1, tzinfo=timezone.utc) + timedelta(microseconds=struct.unpack_from("<q", own, 3)[0] // 10)
    elif h.sniffer in STAMPED and n >= 2:
        h.sniffer_version = struct.unpack_from("<h", own, 0)[0]
        if not h.build and h.sniffer_version == 0x102:
            h.build = LOST_BUILD
        if h.sniffer_version >= 0x103 and n >= 6:
            h.utc_offset = struct.unpack_from("<i", own, 2)[0]
    h.at = at + 12 + n
    return h


def text(raw: bytes) -> str | None:
    return raw.rstrip(b"\0").decode("ascii", "replace") or None


def endpoint_of(own: bytes) -> str:
    """address:port of a socket in a frame's optional data: 16 bytes of address (the last twelve zero for IPv4), 4 of port."""
    address, port = own[:16], struct.unpack_from("<i", own, 16)[0]
    if any(address[4:]):
        return f"[{ipaddress.IPv6Address(address)}]:{port}"
    return f"{ipaddress.IPv4Address(address[:4])}:{port}"


def stamped(own: bytes, version: int) -> tuple[datetime, str | None, list[tuple] | None]:
    """Time, comment and phase overrides in a stamped frame's optional data; what an unknown mark is followed by is left out."""
    ts, at, comment, overrides = EPOCH + timedelta(milliseconds=struct.unpack_from("<d", own, 0)[0]), 8, None, None
    if version >= 0x101 and len(own) > at:
        n = own[at]
        comment, at = own[at + 1 : at + 1 + n].decode("utf-8", "replace") if n else None, at + 1 + n
    while version >= 0x102 and at + 21 <= len(own) and own[at] == OVERRIDE:
        overrides = [*(overrides or []), struct.unpack_from("<qqi", own, at + 1)]
        at += 21
    return ts, comment, overrides


def frames_of(data: bytes, h: Header) -> Iterator[tuple]:
    """(ts, direction, opcode, conn_idx, payload, endpoint, comment, overrides) of each whole frame; a cut-off last frame is left out."""
    at, end = h.at, len(data)
    try:
        while at < end:
            begin, conn, endpoint, comment, overrides = at, 0, None, None, None
            if h.layout in ("2.1", "2.2"):
                mark, sec, _, n = struct.unpack_from("<Biii", data, at)
                at, direction = at + 13, "ServerToClient" if mark == 0xFF else "ClientToServer"
                opcode, skip = (struct.unpack_from("<h", data, at)[0], 2) if mark == 0xFF else (struct.unpack_from("<i", data, at)[0], 4)
                ts, body, at = EPOCH + timedelta(seconds=sec), data[at + skip : at + n], at + n
            elif h.layout in ("3.0", "3.1"):
                mark, a, tick, extra, n = struct.unpack_from("<IiIii", data, at)
                at, direction = at + 20, MARKS.get(mark, OTHER_MARK)
                if h.layout == "3.1":
                    conn, ts = a, h.start + timedelta(milliseconds=(tick - h.ticks) & 0xFFFFFFFF)
                else:
                    ts = EPOCH + timedelta(seconds=a) if not h.ticks else h.start + timedelta(milliseconds=(tick - h.ticks) & 0xFFFFFFFF)
                if extra >= 20 and h.sniffer == SOCKETED and h.layout == "3.1":
                    endpoint = endpoint_of(data[at : at + 20])
                elif h.sniffer in STAMPED and extra >= 8:
                    ts, comment, overrides = stamped(data[at : at + extra], h.sniffer_version)
                at += extra
                opcode, body, at = struct.unpack_from("<i", data, at)[0], data[at + 4 : at + n], at + n
            elif h.layout == "bin":
                opcode, n, sec, mark = struct.unpack_from("<iiiB", data, at)
                ts, direction, body, at = EPOCH + timedelta(seconds=sec), BY_CODE[mark & 3], data[at + 13 : at + 13 + n], at + 13 + n
            else:
                opcode, n, mark, sec = struct.unpack_from("<HiBq", data, at)
                ts, direction, body, at = EPOCH + timedelta(seconds=sec), BY_CODE[mark & 3], data[at + 15 : at + 15 + n], at + 15 + n
            if at > end or at <= begin:
                return
            yield ts, direction, opcode, conn, body, endpoint, comment, overrides
    except struct.error:
        return


def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Files (path, content) as frames; those that can't be read are passed over."""
    for batch in batches:
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
            name, data = path.rsplit("/", 1)[-1], content.as_buffer().to_pybytes()
            try:
                h = header_of(data, name)
            except (struct.error, IndexError):
                continue
            rows: list[tuple] = []
            for number, (ts, direction, opcode, conn, body, endpoint, comment, overrides) in enumerate(frames_of(data, h)):
                rows.append((name.rsplit(".", 1)[0], name, number, ts, direction, opcode, conn, len(body), body, h.layout, h.sniffer, h.build, h.locale, h.start, endpoint, comment, overrides, h.utc_offset))
                if len(rows) == BATCH:
                    yield batch_of(rows)
                    rows = []
            if rows:
                yield batch_of(rows)


STAMP = pa.timestamp("us", tz="UTC")
OVERRIDES = pa.list_(pa.struct([("guid_low", pa.int64()), ("guid_high", pa.int64()), ("phase", pa.int32())]))
ARROW = pa.schema([("capture_id", pa.string()), ("file_name", pa.string()), ("number", pa.int32()), ("ts", STAMP), ("direction", pa.string()), ("opcode", pa.int32()), ("conn_idx", pa.int32()), ("length", pa.int32()), ("payload", pa.binary()), ("layout", pa.string()), ("sniffer_id", pa.int32()), ("client_build", pa.int32()), ("client_locale", pa.string()), ("header_start", STAMP), ("endpoint", pa.string()), ("comment", pa.string()), ("overrides", OVERRIDES), ("utc_offset_seconds", pa.int32())])


def batch_of(rows: list[tuple]) -> pa.RecordBatch:
    columns = [list(c) for c in zip(*rows, strict=True)]
    at = ARROW.get_field_index("overrides")
    columns[at] = [own and [dict(zip(("guid_low", "guid_high", "phase"), x, strict=True)) for x in own] for own in columns[at]]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, ARROW, strict=True)], schema=ARROW)


@dataclass
class Written(WriterCommitMessage):
    path: str


class CaptureWriter(DataSourceArrowWriter):
    """One 3.1 file per task, under a name that is final only once all tasks are done."""

    def __init__(self, options: dict, overwrite: bool):
        self.folder, self.build, self.locale = options["path"], int(options.get("build", "0")), options.get("locale", "enUS")

    def target(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.folder) if ":/" in self.folder else (fs.LocalFileSystem(), os.path.abspath(self.folder))

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        from pyspark import TaskContext

        context, (system, folder) = TaskContext.get(), self.target()
        system.create_dir(folder, recursive=True)
        path = f"{folder}/part-{context.partitionId():05d}-{context.taskAttemptId()}.pkt"
        with system.open_output_stream(path + ".tmp") as f:
            f.write(b"PKT" + struct.pack("<HBI", 0x301, STAMPED[0], self.build) + self.locale.encode("ascii")[:4].ljust(4, b"\0") + bytes(40) + struct.pack("<III", 0, 0, 2) + struct.pack("<H", 0x100))
            for batch in batches:
                out = []
                for row in batch.to_pylist():
                    body = row["payload"] or b""
                    ms = float((row["ts"] - EPOCH) // timedelta(milliseconds=1))
                    out.append(struct.pack("<IiIIId", MARK_OF[row["direction"]], row["conn_idx"] or 0, 0, 8, len(body) + 4, ms) + struct.pack("<i", row["opcode"]) + body)
                f.write(b"".join(out))
        return Written(path)

    def commit(self, messages: list) -> None:
        system, _ = self.target()
        for m in messages:
            if m is not None:
                system.move(m.path + ".tmp", m.path)

    def abort(self, messages: list) -> None:
        system, _ = self.target()
        for m in messages:
            if m is not None and system.get_file_info(m.path + ".tmp").type == fs.FileType.File:
                system.delete_file(m.path + ".tmp")


class CaptureSource(DataSource):
    """format('capture'). For writing: options path (a folder that all executors see), build and locale.

    For reading: index (a folder that ranges.write_index() wrote). As a stream: path (a folder), range_bytes, trigger_bytes.
    """

    @classmethod
    def name(cls) -> str:
        return "capture"

    def schema(self) -> str:
        return SCHEMA

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return CaptureWriter(self.options, overwrite)

    def reader(self, schema: StructType) -> DataSourceReader:
        from .ranges import RangeReader

        return RangeReader(self.options)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        from .ranges import GrowingReader

        return GrowingReader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(CaptureSource)


def read_captures(spark: SparkSession, path: str) -> DataFrame:
    """The frames of capture files, with the header's fields on each.

    path: files, folders or patterns, comma separated, on any file system; of
    folders the files that end in .pkt and .bin. What is missing or unreadable is
    passed over. endpoint, comment and overrides come from a frame's optional
    data, null where it has none.
    """
    return read_many(spark, path.split(","))


def listed(spark: SparkSession, paths: list[str]) -> list[str]:
    """The files that files, folders and patterns name, as Spark's readers take them; of folders those that end in .pkt and .bin."""
    hadoop, jvm, found = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._jvm, []
    for path in paths:
        where = jvm.org.apache.hadoop.fs.Path(path)
        for status in where.getFileSystem(hadoop).globStatus(where) or []:
            found += [f"{status.getPath()}/*.{x}" for x in ("pkt", "bin")] if status.isDirectory() else [status.getPath().toString()]
    return [x for x in found if not x.endswith(("*.pkt", "*.bin")) or jvm.org.apache.hadoop.fs.Path(x).getFileSystem(hadoop).globStatus(jvm.org.apache.hadoop.fs.Path(x))]


def read_many(spark: SparkSession, paths: list[str]) -> DataFrame:
    """read_captures() of several paths. A file is one task's; ranges.read_ranges() reads large ones by several."""
    files = listed(spark, paths)
    if not files:
        return spark.createDataFrame([], SCHEMA)
    return spark.read.format("binaryFile").load(files).select("path", "content").mapInArrow(decoded, SCHEMA)


def phase_overrides(frames: DataFrame) -> DataFrame:
    """The phase overrides in frames: capture_id, number, guid (hexadecimal, high half first), phase."""
    one = frames.select("capture_id", "number", F.explode("overrides").alias("x"))
    half = lambda c: F.lpad(F.hex(c), 16, "0")
    return one.select("capture_id", "number", F.concat(half("x.guid_high"), half("x.guid_low")).alias("guid"), F.col("x.phase").alias("phase"))


def with_build(frames: DataFrame, builds: DataFrame) -> DataFrame:
    """frames with client_build where it is 0: that of the last of builds (since timestamp, build) at the capture's first frame."""
    first = frames.where("client_build = 0").groupBy("capture_id").agg(F.min_by("ts", "number").alias("first"))
    fit = first.join(F.broadcast(builds), F.col("since") <= F.col("first")).groupBy("capture_id").agg(F.max_by("build", "since").alias("__build"))  # builds are a short list
    return frames.join(fit, "capture_id", "left").withColumn("client_build", F.when(F.col("client_build") == 0, F.coalesce("__build", F.lit(0))).otherwise(F.col("client_build"))).drop("__build")


def write_captures(df: DataFrame, path: str, build: int = 0, locale: str = "enUS") -> None:
    """Events (ts, direction, opcode, conn_idx, payload) as capture files, one per task, in the order of each partition."""
    register(df.sparkSession)
    df.select("ts", "direction", "opcode", F.coalesce("conn_idx", F.lit(0)).alias("conn_idx"), "payload").write.format("capture").option("path", path).option("build", str(build)).option("locale", locale).mode("append").save()


def read_packet_table(spark: SparkSession, packets: DataFrame, header: DataFrame) -> DataFrame:
    """Events from a table packets(id, opcode, timestamp, direction, data) and a key/value header; null blobs go, the start is the header's, else the first timestamp."""
    start = header.where("key = 'start_time'").select(F.col("value").try_cast("timestamp").alias("start"))
    rows = packets.where("data is not null").select(F.col("id").alias("number"), "opcode", F.col("timestamp").alias("ts"), "direction", F.col("data").alias("payload"), F.octet_length("data").alias("length"))
    first = rows.agg(F.min("ts").alias("first")).join(start, F.lit(True), "left").select(F.coalesce("start", "first").alias("header_start"))
    return rows.crossJoin(F.broadcast(first))  # one row


def read_packet_jdbc(spark: SparkSession, url: str, partitions: int = 16, **options: str) -> DataFrame:
    """The table packets of a relational capture, read in ranges of id."""
    low, high = spark.read.format("jdbc").options(url=url, query="select min(id) a, max(id) b from packets", **options).load().first()
    table = spark.read.format("jdbc").options(url=url, dbtable="packets", partitionColumn="id", lowerBound=str(low or 0), upperBound=str((high or 0) + 1), numPartitions=str(partitions), **options).load()
    header = spark.read.format("jdbc").options(url=url, dbtable="header", **options).load()
    return read_packet_table(spark, table, header)
