"""Capture files, idempotent loads, streams and the registry."""

import datetime as dt
import struct

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracefold.functions import specs
from tracefold.plans import queries, registry
from tracefold.sources import captures as S
from tracefold.sources import tables as K
from tracefold.streaming import captures as R

from .test_operators import EVENTS, at, df, scan_links


def plain(path, frames):
    with open(path, "wb") as f:
        for opcode, direction, sec, body in frames:
            f.write(struct.pack("<HiBq", opcode, len(body), direction, sec) + body)


def v31(path, frames, start=1000, ticks=50):
    with open(path, "wb") as f:
        f.write(b"PKT" + struct.pack("<HBI", 0x301, 0, 12340) + b"deDE" + bytes(40) + struct.pack("<III", start, ticks, 3) + b"xyz")
        for mark, conn, tick, opcode, body in frames:
            f.write(struct.pack("<IiIii", mark, conn, tick, 4, len(body) + 4) + b"more" + struct.pack("<i", opcode) + body)


def test_capture_layouts(spark, tmp_path):
    plain(tmp_path / "a.pkt", [(7, 1, 100, b"xy"), (8, 0, 101, b"")])
    v31(tmp_path / "b.pkt", [(0x47534D53, 3, 1050, 9, b"abc"), (0x47534D43, 3, 2050, 10, b"")])
    with open(tmp_path / "c.bin", "wb") as f:
        f.write(struct.pack("<iiiB", 5, 1, 60, 1) + b"z" + b"cut")
    with open(tmp_path / "d.pkt", "wb") as f:
        f.write(b"PKT" + struct.pack("<HH", 0x201, 12340) + bytes(40) + struct.pack("<Biii", 0xFF, 5, 0, 4) + struct.pack("<h", 3) + b"mn")
    (tmp_path / "e.pkt").write_bytes(b"PKT\x01\x03")
    rows = S.read_many(spark, [str(tmp_path), str(tmp_path / "missing*.pkt")]).orderBy("file_name", "number").collect()
    got = [(r["file_name"], r["number"], r["direction"], r["opcode"], bytes(r["payload"]), int(r["ts"].replace(tzinfo=dt.timezone.utc).timestamp()), r["layout"]) for r in rows]
    assert got == [
        ("a.pkt", 0, "ServerToClient", 7, b"xy", 100, "plain"), ("a.pkt", 1, "ClientToServer", 8, b"", 101, "plain"),
        ("b.pkt", 0, "ServerToClient", 9, b"abc", 1001, "3.1"), ("b.pkt", 1, "ClientToServer", 10, b"", 1002, "3.1"),
        ("c.bin", 0, "ServerToClient", 5, b"z", 60, "bin"), ("d.pkt", 0, "ServerToClient", 3, b"mn", 5, "2.1"),
    ]
    assert rows[2]["client_locale"] == "deDE" and rows[2]["conn_idx"] == 3 and rows[2]["client_build"] == 12340


def test_optional_data_of_frames(spark, tmp_path):
    def head(sniffer, own, build=1):
        return b"PKT" + struct.pack("<HBI", 0x301, sniffer, build) + b"enUS" + bytes(40) + struct.pack("<III", 1000, 0, len(own)) + own

    def frame(extra, opcode=7, body=b"b"):
        return struct.pack("<IiIii", 0x47534D53, 1, 5, len(extra), len(body) + 4) + extra + struct.pack("<i", opcode) + body

    v4, v6 = bytes([10, 0, 0, 7]) + bytes(12) + struct.pack("<i", 8085), bytes.fromhex("20010db8000000000000000000000001") + struct.pack("<i", 3724)
    (tmp_path / "t.pkt").write_bytes(head(ord("T"), b"") + frame(v4) + frame(v6 + b"more") + frame(b""))
    when = struct.pack("<d", 1_700_000_000_000.0)
    over = bytes([0x50]) + struct.pack("<qqi", 5, 6, 169)
    (tmp_path / "y.pkt").write_bytes(head(0x15, struct.pack("<hi", 0x103, 7200)) + frame(when + bytes([2]) + b"hi" + over + over) + frame(when + bytes([0])) + frame(when + bytes([0]) + b"\x99junk"))
    (tmp_path / "lost.pkt").write_bytes(head(0x16, struct.pack("<h", 0x102), 0) + frame(when + bytes([0])))
    (tmp_path / "old.pkt").write_bytes(head(0, b"", 0) + frame(b""))
    rows = S.read_captures(spark, f"{tmp_path},{tmp_path}/none").cache()
    by = {(r["capture_id"], r["number"]): r for r in rows.collect()}
    assert [by["t", k]["endpoint"] for k in range(3)] == ["10.0.0.7:8085", "[2001:db8::1]:3724", None]
    assert [by["y", k]["comment"] for k in range(3)] == ["hi", None, None] and by["y", 0]["utc_offset_seconds"] == 7200
    assert all(bytes(r["payload"]) == b"b" and r["opcode"] == 7 for r in by.values()) and by["lost", 0]["client_build"] == 65560
    assert [tuple(r) for r in S.phase_overrides(rows).collect()] == [("y", 0, "0" * 15 + "6" + "0" * 15 + "5", 169)] * 2
    builds = df(spark, "since timestamp, build int", (dt.datetime(1970, 1, 1), 11), (dt.datetime(1970, 1, 1, 0, 10), 22), (dt.datetime(1980, 1, 1), 33))
    assert {r["capture_id"]: r["client_build"] for r in S.with_build(rows, builds).collect()} == {"t": 1, "y": 1, "lost": 65560, "old": 22}
    assert S.read_many(spark, [str(tmp_path / "nothing")]).count() == 0
    K.split_by_session(rows, str(tmp_path / "sessions"))
    assert len([p for p in (tmp_path / "sessions").iterdir() if p.name.startswith("session=")]) == 3


def test_idle_sessions_are_forgotten(spark, tmp_path):
    schema = "capture_id int, number long, ts timestamp, kind string, zone int"
    for k, rows in enumerate(([(1, 1, at(0), "selection", 5)], [(2, 2, at(10_000_000), "selection", 7)], [(2, 3, at(20_000_000), "response", None)], [(1, 4, at(20_000_100), "response", None)])):
        df(spark, schema, *rows).coalesce(1).write.parquet(str(tmp_path / "in" / f"part={k}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "part=*"))
    linked = drained(R.stream_link(stream, window_ms=10**9, idle="1 hour"), "append", "idle_links", tmp_path / "c1")
    assert {r["number"]: r["selection_number"] for r in linked} == {3: 2, 4: None}
    states = drained(R.stream_session_state(stream, "capture_id", "zone", idle="1 hour"), "append", "idle_states", tmp_path / "c2")
    assert {r["number"]: r["current_zone"] for r in states} == {1: 5, 2: 7, 3: 7, 4: None}


def test_captures_round_trip(spark, tmp_path):
    e = df(spark, "ts timestamp, direction string, opcode int, conn_idx int, payload binary", *((at(k * 10), ("ServerToClient", "ClientToServer")[k % 2], k, k % 3, bytearray([k] * k)) for k in range(50)))
    S.write_captures(e.coalesce(2), str(tmp_path / "out"), build=12340)
    back = S.read_captures(spark, str(tmp_path / "out"))
    assert sorted((r["ts"], r["direction"], r["opcode"], r["conn_idx"], bytes(r["payload"])) for r in back.select(*e.columns).collect()) == sorted((r["ts"], r["direction"], r["opcode"], r["conn_idx"], bytes(r["payload"])) for r in e.collect())
    K.split_by_opcode(back.withColumn("opcode_name", F.col("opcode").cast("string")), str(tmp_path / "ops"))
    assert spark.read.parquet(str(tmp_path / "ops")).count() == 50 and (tmp_path / "ops" / "opcode_name=7").exists()
    K.split_by_direction(back.withColumn("opcode_name", F.lit("x")), str(tmp_path / "dirs"))
    K.split_by_session(back.withColumn("endpoint", F.lit(None).cast("string")), str(tmp_path / "sessions"))
    assert (tmp_path / "sessions" / "session=0").exists() and (tmp_path / "dirs" / "direction=ClientToServer").exists()
    K.split_by_count(back.coalesce(1), str(tmp_path / "count"), 20)
    assert len(list((tmp_path / "count").glob("*.parquet"))) == 3
    K.merge_captures([back, back.drop("layout")], str(tmp_path / "merged"))
    K.compress_captures(back, str(tmp_path / "gz"))
    K.move_by_version(back.withColumn("client_version", F.lit("v1")), str(tmp_path / "versions"))
    assert spark.read.parquet(str(tmp_path / "merged")).count() == 100 and spark.read.parquet(str(tmp_path / "gz")).count() == 50


def test_captures_under_an_address(spark, tmp_path):
    e = df(spark, "ts timestamp, direction string, opcode int, conn_idx int, payload binary", (at(0), "ServerToClient", 5, 0, bytearray(b"x")), (at(1), "ClientToServer", 6, 1, None))
    S.write_captures(e, f"file://{tmp_path}/out")
    assert sorted(r["opcode"] for r in S.read_captures(spark, f"file://{tmp_path}/out").collect()) == [5, 6]
    assert list((tmp_path / "out").glob("*.pkt")) and not list((tmp_path / "out").glob("*.tmp"))


def test_packet_table(spark):
    p = df(spark, "id int, opcode int, timestamp timestamp, direction string, data binary", (1, 5, at(10), "s", bytearray(b"x")), (2, 6, at(5), "s", None), (3, 7, at(20), "s", bytearray(b"yz")))
    h = df(spark, "key string, value string", ("other", "1"))
    rows = S.read_packet_table(spark, p, h).collect()
    assert len(rows) == 2 and {r["header_start"] for r in rows} == {at(10)}


def test_load_twice_is_load_once(spark, tmp_path):
    path = str(tmp_path / "facts")
    facts = df(spark, "capture_id int, v int", (1, 1), (1, 2), (2, 3))
    done = df(spark, "capture_id int", (1,), (2,))
    read = lambda: sorted(tuple(r) for r in spark.read.parquet(path).select("capture_id", "v").collect())
    K.replace_capture_rows(facts, done, path)
    K.replace_capture_rows(facts, done, path)
    assert read() == [(1, 1), (1, 2), (2, 3)]
    K.replace_capture_rows(facts.where("capture_id = 2").withColumn("v", F.lit(9)), done, path)
    assert read() == [(2, 9)]
    K.replace_capture_rows(facts.limit(0), done.where("capture_id = 1"), path)
    assert read() == [(2, 9)]
    loot = df(spark, "capture_id int, loot_index int, items array<struct<item_id:int>>", (1, 0, [(5,), (6,)]), (1, 1, []))
    K.write_loot(loot, done, str(tmp_path / "items"), str(tmp_path / "inst"))
    assert spark.read.parquet(str(tmp_path / "items")).count() == 2 and spark.read.parquet(str(tmp_path / "inst")).count() == 2


def test_upsert_keeps_ids(spark):
    schema = "id long, file_hash string, ingested_at_utc timestamp, name string"
    old = df(spark, schema, (1, "a", at(0), "A"), (5, "b", at(0), "B"))
    new = df(spark, schema, (None, "b", at(1), "B2"), (None, "c", at(1), "C"), (None, "c", at(2), "C2"), (None, "d", at(3), "D"))
    out = {r["file_hash"]: (r["id"], r["name"]) for r in K.upserted_captures(old, new).collect()}
    assert out == {"a": (1, "A"), "b": (5, "B2"), "c": (6, "C2"), "d": (7, "D")}
    assert K.seed_if_absent(new.select("file_hash").distinct(), old, ["file_hash"]).count() == 2


def test_names_and_dimensions(spark):
    a, b = df(spark, "object_type string, id int, name string", ("Unit", 1, "first"), ("Unit", 2, None)), df(spark, "object_type string, id int, name string", ("Unit", 1, "second"), ("Unit", 2, "two"))
    assert {r["id"]: r["name"] for r in K.read_names([a, b]).collect()} == {1: "first", 2: "two"}
    dim = df(spark, "id int, name string", (1, "x"), (2, "y"))
    rec = df(spark, "table_hash int, record_id int, status int, number int, unique_id int, row struct<id:int,name:string>", (1, 1, 1, 1, 1, (1, "new")), (1, 2, 2, 2, 2, None), (1, 3, 1, 3, 3, (3, "add")))
    out = K.read_dimensions({"d": dim, "e": dim}, {"d": rec})
    assert {tuple(r) for r in out["d"].collect()} == {(1, "new"), (3, "add")} and out["e"].count() == 2
    assert len(K.read_reference_spawns(df(spark, "guid int, entry int, map int, x int, y int, z int, o int, more int", (1, 1, 1, 1, 1, 1, 1, 1)), "creature").columns) == 7


def test_typed_events(spark, tmp_path):
    e = df(spark, "capture_id int, number int, kind string, chat struct<text:string>, gossip struct<menu:int>", (1, 1, "chat", ("hi",), None), (1, 2, "gossip", None, (5,)))
    K.write_typed_events(e, str(tmp_path / "t"), 3)
    assert K.read_typed_events(spark, str(tmp_path / "t"), ["gossip"]).first()["gossip"]["menu"] == 5


def drained(stream, mode, name, folder):
    q = stream.writeStream.outputMode(mode).format("memory").queryName(name).option("checkpointLocation", str(folder)).trigger(availableNow=True).start()
    q.awaitTermination()
    return stream.sparkSession.table(name).collect()


def test_stream_of_captures_loads_each_trigger(spark, tmp_path):
    (tmp_path / "in").mkdir()
    plain(tmp_path / "in" / "a.pkt", [(7, 1, 100, b"xy"), (8, 0, 101, b"")])
    plain(tmp_path / "in" / "b.pkt", [(9, 1, 100, b"q")])
    load = lambda rows, _: K.replace_capture_rows(rows, rows.select("capture_id"), str(tmp_path / "out"))
    R.load_each(R.stream_captures(spark, str(tmp_path / "in"), 1), load, str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3


def test_stream_link_equals_batch(spark, tmp_path):
    rows = [(1, 0, "selection"), (2, 2500, "response"), (3, 2600, "detail"), (4, 3000, "selection"), (5, 5501, "response"), (6, 6000, "selection"), (7, 6001, "reset"), (8, 6002, "response"), (9, 7000, "selection"), (10, 7002, "response"), (11, 9400, "detail")]
    folder = tmp_path / "in"
    for k in range(0, len(rows), 3):  # several files, so state goes from trigger to trigger
        df(spark, EVENTS, *((1, n, at(ms), kind) for n, ms, kind in rows[k : k + 3])).coalesce(1).write.mode("append").parquet(str(folder))
    stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(str(folder))
    got = {r["number"]: r["selection_number"] for r in drained(R.stream_link(stream), "append", "links", tmp_path / "cp")}
    responses, details = scan_links(rows)
    assert got == responses | details


def test_stream_state_and_lifecycle(spark, tmp_path):
    schema = "capture_id int, guid string, number long, kind string, hp int, zone int"
    rows = [(1, "a", 1, "create", 10, 5), (1, "a", 2, "update", None, 6), (1, "b", 3, "create", 7, None), (1, "a", 4, "update", 8, None), (1, "b", 5, "destroy", None, None), (1, "a", 6, "create", None, 9)]
    folder = tmp_path / "in"
    for k in range(0, 6, 2):
        df(spark, schema, *rows[k : k + 2]).coalesce(1).write.mode("append").parquet(str(folder))
    batch = {r["guid"]: (r["last_number"], r["alive"], r["hp"], r["zone"]) for r in R.entity_lifecycle(df(spark, schema, *rows), ["hp", "zone"]).collect()}
    assert batch == {"a": (6, True, None, 9), "b": (5, False, 7, None)}
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder))
    last = {}
    for r in drained(R.stream_lifecycle(stream, "guid", ["hp", "zone"]), "update", "life", tmp_path / "cp"):
        if r["last_number"] >= last.get(r["guid"], (0,))[0]:
            last[r["guid"]] = (r["last_number"], r["alive"], r["hp"], r["zone"])
    assert last == batch
    got = {r["number"]: r["current_zone"] for r in drained(R.stream_session_state(stream, "capture_id", "zone"), "append", "zones", tmp_path / "cp2")}
    assert got == {1: 5, 2: 6, 3: 6, 4: 6, 5: 6, 6: 9}
    assert len(drained(R.stream_first_seen(stream, ["guid"]), "append", "firsts", tmp_path / "cp3")) == 2
    hooked = []
    registry.on_records(stream, lambda rows: hooked.append(rows.count()), str(tmp_path / "cp4")).awaitTermination()
    assert sum(hooked) == 6


def test_registry(spark):
    r = registry.Registry()

    @r.producer("world", ("spawns",))
    def creature(t):
        return t["spawns"]

    @r.producer("world", ("spawns",))
    def broken(t):
        raise RuntimeError("no")

    @r.producer("cdc", ("nothing",))
    def absent(t):
        raise AssertionError

    @r.processor("chat")
    def texts(events):
        return events

    made, failed = r.produce({"spawns": spark.range(3)})
    assert set(made) == {"creature"} and set(failed) == {"broken"}
    assert r.process(df(spark, "kind string", ("chat",), ("move",)))["chat"][0].count() == 1


def test_new_captures_are_numbered_over_several_tasks(spark):
    schema = "id long, file_hash string, ingested_at_utc timestamp"
    new = spark.range(2000).select(F.lit(None).cast("long").alias("id"), F.format_string("h%05d", "id").alias("file_hash"), F.lit(at(1)).alias("ingested_at_utc"))
    out = K.upserted_captures(df(spark, schema, (7, "a", at(0))), new)
    assert sorted((r["file_hash"], r["id"]) for r in out.collect()) == [("a", 7)] + [(f"h{k:05d}", 8 + k) for k in range(2000)]
    assert "Window [row_number" not in out._jdf.queryExecution().toString()


def test_stream_stats_are_a_table_in_the_shared_folder(spark, tmp_path):
    df(spark, "user_id long, event_type string", (1, "click"), (1, "click"), (1, "view"), (2, "error")).write.parquet(f"{tmp_path}/events.parquet")
    out = queries.stream_parse_stats(spark, str(tmp_path))
    assert sorted(tuple(r) for r in out.collect()) == [(1, "success", 2), (2, "not_parsed", 1)]
    assert all("/tracefold/stats-" in f for f in out.inputFiles()) and out.inputFiles()


def test_reference_keys_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "ref")
    spark.range(200_000).select("id", (F.col("id") * 2).alias("v")).coalesce(1).write.option("parquet.block.size", 64 << 10).parquet(path)
    spec = specs.TableSpec("ref", (specs.Column("id", T.LongType(), key=True), specs.Column("v", T.LongType())))
    for ids in ([5, 7, None, 190_000], list(range(1000, 3000))):
        out = K.read_reference(spark.read.parquet(path), spec, df(spark, "id long", *((i,) for i in ids)))
        rows = sorted(tuple(r) for r in out.collect())
        assert rows == [(i, 2 * i) for i in sorted(i for i in ids if i is not None)]
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert ("In(id" if len(ids) < 1000 else "GreaterThanOrEqual(id,1000)") in plan
    assert K.read_reference(spark.read.parquet(path), spec, df(spark, "id long")).count() == 0
    read = spark.read.parquet(path).where(F.col("id").between(1000, 2999))
    read.collect()
    scanned = K.read_reference(spark.read.parquet(path), spec, df(spark, "id long", *((i,) for i in range(1000, 3000))))
    scanned.collect()
    node = scanned._jdf.queryExecution().executedPlan()
    node = node.finalPhysicalPlan() if hasattr(node, "finalPhysicalPlan") else node
    leaves, found = node.collectLeaves(), []
    for k in range(leaves.size()):
        leaf = leaves.apply(k)
        leaf = leaf.plan() if "QueryStage" in leaf.getClass().getName() else leaf
        for j in range(leaf.collectLeaves().size()):
            scan = leaf.collectLeaves().apply(j)
            if "ref" in scan.toString() and "FileScan" in scan.toString() and scan.metrics().contains("numOutputRows"):
                found.append(scan.metrics().apply("numOutputRows").value())
    assert found and max(found) < 100_000  # row groups without the keys were left out
