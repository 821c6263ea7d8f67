"""The frame index, reading in ranges and growing files, against the reader of whole files."""

import datetime as dt
import os
import random
import struct

import pytest
from pyspark.sql import functions as F

from tracefold.sources import captures as S
from tracefold.sources import ranges as R

from .test_sources import plain, v31


def v2(path, frames):
    with open(path, "wb") as f:
        f.write(b"PKT" + struct.pack("<HH", 0x201, 12340) + bytes(40))
        for sec, opcode, body in frames:
            f.write(struct.pack("<Biii", 0xFF, sec, 0, len(body) + 2) + struct.pack("<h", opcode) + body)


@pytest.fixture
def folder(tmp_path):
    rng = random.Random(3)
    body = lambda: rng.randbytes(rng.choice([0, 3, 40, 700]))
    plain(tmp_path / "a.pkt", [(k % 50, k % 4, 100 + k, body()) for k in range(400)])
    v31(tmp_path / "b.pkt", [(0x47534D53, k % 3, 1000 * k, k, body()) for k in range(300)])
    v2(tmp_path / "c.pkt", [(k, k % 90, body()) for k in range(200)])
    with open(tmp_path / "d.bin", "wb") as f:
        for k in range(100):
            x = body()
            f.write(struct.pack("<iiiB", k, len(x), 60 + k, k % 4) + x)
        f.write(struct.pack("<iiiB", 5, 99, 60, 1) + b"cut")
    (tmp_path / "e.pkt").write_bytes(b"PKT\x01\x03")
    plain(tmp_path / "f.pkt", [])
    return tmp_path


def rows(df):
    return sorted(map(tuple, df.select("file_name", "number", "ts", "direction", "opcode", "conn_idx", "length", F.hex("payload"), "layout", "client_build", "header_start").collect()), key=lambda r: r[:2])


@pytest.mark.parametrize(("range_bytes", "window"), [(1, 64), (5_000, 100), (1 << 20, 1 << 16)])
def test_ranges_give_the_rows_of_whole_files(spark, folder, monkeypatch, range_bytes, window):
    index = str(folder / "index")
    R.write_index(spark, [str(folder)], index, range_bytes)
    table = spark.read.parquet(index)
    assert rows(R.read_ranges(spark, index)) == rows(S.read_captures(spark, str(folder)))
    assert table.groupBy("path").agg(F.sum("frames").alias("n")).agg(F.sum("n")).first()[0] == 1000
    assert table.where("stop <= start or frames < 1 or first_ts > last_ts").count() == 0
    monkeypatch.setattr(R, "WINDOW", window)
    own = [x for p in sorted(os.listdir(folder)) if p[1:] in (".pkt", ".bin") and p != "e.pkt" for x in R.ranges_of(str(folder / p), range_bytes)]
    assert sorted(x[3:7] for x in own) == sorted(map(tuple, table.select("start", "stop", "number", "frames").collect()))


def test_time_spans_pass_over_ranges(spark, folder):
    index = str(folder / "index")
    R.write_index(spark, [str(folder / "a.pkt")], index, 2_000)
    reader = R.RangeReader({"index": index})
    whole = len(reader.partitions())
    since = dt.datetime.fromtimestamp(480, dt.timezone.utc)
    assert list(reader.pushFilters([R.GreaterThanOrEqual(("ts",), since)])) and 0 < len(reader.partitions()) < whole / 3
    late = R.read_ranges(spark, index).where(F.col("ts") >= F.lit(since))
    assert late.count() == 20 and late.rdd.getNumPartitions() < whole / 3
    assert R.read_ranges(spark, index).where("file_name = 'other'").count() == 0


def test_a_file_above_two_gigabytes(spark, tmp_path):
    """A sparse file that binaryFile refuses: each range is a task of its own, and the numbers run on."""
    path, size, n = tmp_path / "large.pkt", 48 << 20, 46
    with open(path, "wb") as f:
        for k in range(n):
            f.write(struct.pack("<HiBq", k, size, k % 4, 1000 + k))
            f.seek(size, os.SEEK_CUR)
        f.write(struct.pack("<HiBq", 999, 4, 1, 5000) + b"last")
    assert path.stat().st_size > 1 << 31
    index = str(tmp_path / "index")
    R.write_index(spark, [str(path)], index)
    table = spark.read.parquet(index)
    assert table.count() >= 20 and table.agg(F.sum("frames")).first()[0] == n + 1
    wanted = spark.read.schema(R.INDEX).parquet(index).where("range in (0, 7) or number > 40")
    wanted.write.parquet(str(tmp_path / "some"))
    out = R.read_ranges(spark, str(tmp_path / "some"))
    assert out.rdd.getNumPartitions() == wanted.count() > 2
    got = {r.number: (r.opcode, r.length) for r in out.select("number", "opcode", "length").collect()}
    assert got[n] == (999, 4) and all(v == (k, size) for k, v in got.items() if k < n) and 0 in got and len(got) < 12


def test_growing_files_are_read_on(spark, tmp_path):
    folder, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    folder.mkdir()
    frames = [(k, k % 4, 100 + k, bytes([k]) * (k % 7)) for k in range(60)]

    def bytes_of(some):
        plain(tmp_path / "x", some)
        return (tmp_path / "x").read_bytes()

    def load():
        stream = R.stream_frames(spark, str(folder), range_bytes=100)
        stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination(120)
        return sorted(map(tuple, spark.read.parquet(out).select("file_name", "number", "opcode", F.hex("payload")).collect()))

    want = lambda name, some: [(name, k, o, (b or b"").hex().upper()) for k, (o, _, _, b) in enumerate(some)]
    whole = bytes_of(frames[:20])
    (folder / "a.pkt").write_bytes(whole[:-1])  # the last frame isn't whole yet
    assert load() == want("a.pkt", frames[:19])
    with open(folder / "a.pkt", "ab") as f:
        f.write(whole[-1:] + bytes_of(frames[20:45]))
    (folder / "b.pkt").write_bytes(bytes_of(frames[45:]))
    assert load() == want("a.pkt", frames[:45]) + want("b.pkt", frames[45:])
    assert load() == want("a.pkt", frames[:45]) + want("b.pkt", frames[45:])
