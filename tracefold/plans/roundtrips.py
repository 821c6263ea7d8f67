"""Queries of sources, sinks and streams: whole tables written by an operator and read back, with DuckDB SQL for what must come out.

Everything is written to new folders in the shared folder.
"""

from __future__ import annotations

import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import specs
from ..functions.specs import Column, TableSpec
from ..operators import aggregates as A
from ..operators import changes as C
from ..operators import dedupe as D
from ..operators import filters as L
from ..operators import joins as J
from ..operators import windows as W
from ..sources import captures as S
from ..sources import frames as frames_source
from ..sources import ranges, versioned
from ..sources import tables as K
from ..sources.scratch import scratch_path
from ..streaming import captures as R
from ..streaming import first_seen
from .queries import HALF_DAY_MS, ORACLE_SQL, PART, PART_SQL, events, part_snapshots, query, sessions, table
from .folds import Fold
from .registry import Registry, on_records


def written(spark: SparkSession, df: DataFrame, name: str) -> str:
    """The new folder that df is written to."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return path


# --- captures (S01-S03, K01, T01, P03) ---


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as frames: kinds as directions, users as opcodes, properties as payload."""
    e = table(spark, sf_dir, "events")
    direction = F.when(F.col("event_type") == "click", "ClientToServer").when(F.col("event_type") == "purchase", "BNClientToServer").when(F.col("event_type") == "view", "BNServerToClient").otherwise("ServerToClient")
    return e.select(F.col("ts").cast("timestamp").alias("ts"), direction.alias("direction"), F.col("user_id").cast("int").alias("opcode"), (F.col("event_id") % 3).cast("int").alias("conn_idx"), F.encode("props", "UTF-8").alias("payload"))


FRAMES_SQL = "CASE event_type WHEN 'click' THEN 'ClientToServer' WHEN 'purchase' THEN 'BNClientToServer' WHEN 'view' THEN 'BNServerToClient' ELSE 'ServerToClient' END AS direction, CAST(user_id AS INTEGER) AS opcode, CAST(event_id % 3 AS INTEGER) AS conn_idx, props"


def shown(df: DataFrame) -> DataFrame:
    return df.select("direction", "opcode", "conn_idx", F.decode("payload", "UTF-8").alias("props"), "length", "client_build", "layout")


@query(f"SELECT {FRAMES_SQL}, CAST(octet_length(encode(props)) AS INTEGER) AS length, 12340 AS client_build, '3.1' AS layout FROM events")
def write_and_read_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "captures")
    S.write_captures(frames(spark, sf_dir), path, build=12340)
    return shown(S.read_captures(spark, path))


@query(f"SELECT {FRAMES_SQL}, CAST(octet_length(encode(props)) AS INTEGER) AS length, 5 AS client_build, '3.1' AS layout FROM events")
def read_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two folders of captures and one that isn't there."""
    folders = [scratch_path(spark, "captures") for _ in range(3)]
    for k in range(2):
        S.write_captures(frames(spark, sf_dir).where((F.col("opcode") % 2) == k), folders[k], build=5)
    return shown(S.read_many(spark, folders))


@query("SELECT event_id AS number, user_id AS opcode, octet_length(encode(props)) AS length, (SELECT min(event_id) FROM events WHERE event_type <> 'error' AND ts = (SELECT min(ts) FROM events WHERE event_type <> 'error')) AS first FROM events WHERE event_type <> 'error'")
def read_packet_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as the packets of a relational capture, errors without data; the header doesn't tell the start."""
    e = events(spark, sf_dir)
    packets = table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.col("user_id").alias("opcode"), F.col("ts").cast("timestamp").alias("timestamp"), F.col("event_type").alias("direction"), F.when(F.col("event_type") != "error", F.encode("props", "UTF-8")).alias("data"))
    header = e.select(F.lit("version").alias("key"), F.lit("1").alias("value")).distinct()
    rows = S.read_packet_table(spark, packets, header)
    first = rows.where(F.col("ts") == F.col("header_start")).agg(F.min("number").alias("first"))
    return rows.select("number", "opcode", F.col("length").cast("long").alias("length")).crossJoin(F.broadcast(first))  # one row


@query(f"SELECT {FRAMES_SQL}, CAST(octet_length(encode(props)) AS INTEGER) AS length, 7 AS client_build, '3.1' AS layout FROM events")
def stream_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures read as a stream, each trigger loaded into a table."""
    path, out = scratch_path(spark, "captures"), scratch_path(spark, "loaded")
    S.write_captures(frames(spark, sf_dir), path, build=7)
    stream = R.stream_captures(spark, path)
    spark.createDataFrame([], stream.schema).write.parquet(out)
    R.load_each(stream, lambda df, _: df.write.mode("append").parquet(out), scratch_path(spark, "state")).awaitTermination()
    return shown(spark.read.schema(stream.schema).parquet(out))


@query(f"SELECT {FRAMES_SQL}, CAST(octet_length(encode(props)) AS INTEGER) AS length, 9 AS client_build, '3.1' AS layout FROM events")
def read_captures_in_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures indexed by where their frames begin and read by several tasks a file."""
    path, index = scratch_path(spark, "captures"), scratch_path(spark, "frame-index")
    S.write_captures(frames(spark, sf_dir).coalesce(2), path, build=9)
    ranges.write_index(spark, [path], index, range_bytes=1 << 18)
    return shown(ranges.read_ranges(spark, index))


@query(f"SELECT {FRAMES_SQL}, CAST(octet_length(encode(props)) AS INTEGER) AS length, 8 AS client_build, '3.1' AS layout FROM events")
def stream_growing_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures read as a stream by file and frame, in triggers of a few ranges."""
    path, out = scratch_path(spark, "captures"), scratch_path(spark, "loaded")
    S.write_captures(frames(spark, sf_dir), path, build=8)
    stream = ranges.stream_frames(spark, path, range_bytes=1 << 18)
    stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", scratch_path(spark, "state")).trigger(availableNow=True).start().awaitTermination()
    return shown(spark.read.schema(stream.schema).parquet(out))


# --- tables (S05, S06, S08, S09) ---


@query("SELECT l_orderkey AS guid, l_partkey AS entry, l_suppkey AS map, l_quantity AS x, l_tax AS y, l_discount AS z, l_extendedprice AS o FROM lineitem")
def read_reference_spawns(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = {"l_orderkey": "guid", "l_partkey": "entry", "l_suppkey": "map", "l_quantity": "x", "l_tax": "y", "l_discount": "z", "l_extendedprice": "o"}
    return K.read_reference_spawns(table(spark, sf_dir, "lineitem").withColumnsRenamed(names), "creature")


@query("SELECT p_partkey AS id, CASE WHEN p_partkey % 7 = 1 THEN 'new ' || p_brand ELSE p_name END AS name FROM part WHERE p_partkey % 7 <> 2 UNION ALL SELECT p_partkey + 1000000000, 'new ' || p_brand FROM part WHERE p_partkey % 7 = 4")
def read_dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part with change records: some names new, some rows gone, some added, and some records that were refused."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    record = p.where((k % 7).isin(1, 2, 3, 4)).withColumn("id", F.when(k % 7 == 4, k + 1_000_000_000).otherwise(k))
    status = F.when(k % 7 == 2, C.REMOVED).when(k % 7 == 3, 0).otherwise(C.VALID)
    records = record.select(F.lit(1).alias("table_hash"), F.col("id").alias("record_id"), status.alias("status"), k.alias("number"), k.alias("unique_id"), F.struct("id", F.concat(F.lit("new "), "p_brand").alias("name")).alias("row"))
    return K.read_dimensions({"part": p.select(k.alias("id"), F.col("p_name").alias("name"))}, {"part": records})["part"]


@query("SELECT " + ", ".join(f"max(CASE WHEN n_regionkey = 1 AND n_nationkey = {k} THEN n_name END) AS c{k}" for k in range(25)) + " FROM nation")
def table_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation as a catalog: regions as tables, nations as columns, names as defaults."""
    catalog = table(spark, sf_dir, "nation").select(F.col("n_regionkey").cast("string").alias("table_name"), F.concat(F.lit("c"), "n_nationkey").alias("column_name"), F.col("n_name").alias("column_default"))
    return specs.table_defaults(catalog, TableSpec("1", tuple(Column(f"c{k}", T.StringType()) for k in range(25))))


@query("SELECT event_id, event_type AS kind, value FROM events WHERE event_type IN ('click', 'error')")
def typed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "typed")
    K.write_typed_events(events(spark, sf_dir).withColumn("number", F.col("number").cast("long")), path, 4)
    return K.read_typed_events(spark, path, ["click", "error"]).select(F.col("number").alias("event_id"), "kind", "value")


# --- splits and merges (K02-K07) ---


def flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as events: flags as opcode names, states as directions, suppliers as sockets where their key is odd."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_linestatus", "l_suppkey")
    return li.withColumns({"opcode_name": F.col("l_returnflag"), "direction": F.col("l_linestatus"), "endpoint": F.when(F.col("l_suppkey") % 2 == 1, F.concat(F.lit("10.0.0."), F.col("l_suppkey") % 10, F.lit(":80"))), "client_version": F.concat(F.lit("v"), F.col("l_linenumber"))})


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag AS opcode_name, l_linestatus AS direction FROM lineitem")
def split_by_opcode(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "split")
    K.split_by_opcode(flagged(spark, sf_dir), path)
    return spark.read.parquet(path).select("l_orderkey", "l_linenumber", "l_partkey", "opcode_name", "direction")


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag AS opcode_name FROM lineitem WHERE l_linestatus = 'O'")
def split_by_direction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The folder of one direction."""
    path = scratch_path(spark, "split")
    K.split_by_direction(flagged(spark, sf_dir), path)
    return spark.read.parquet(path).where("direction = 'O'").select("l_orderkey", "l_linenumber", "l_partkey", "opcode_name")


@query("SELECT CASE WHEN l_suppkey % 2 = 1 THEN '10.0.0.' || l_suppkey % 10 || ':80' ELSE '0' END AS session, count(*) AS n, sum(l_partkey) AS parts FROM lineitem GROUP BY 1")
def split_by_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "split")
    K.split_by_session(flagged(spark, sf_dir), path)
    return spark.read.parquet(path).groupBy(F.col("session").cast("string").alias("session")).agg(F.count("*").alias("n"), F.sum("l_partkey").alias("parts"))


@query("SELECT count(*) AS n, sum(l_partkey) AS parts, true AS small FROM lineitem")
def split_by_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "split")
    K.split_by_count(flagged(spark, sf_dir), path, 500)
    files = spark.read.parquet(path).groupBy(F.input_file_name().alias("file")).agg(F.count("*").alias("n"), F.sum("l_partkey").alias("parts"))
    return files.agg(F.sum("n").alias("n"), F.sum("parts").alias("parts"), (F.max("n") <= 500).alias("small"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_returnflag = 'A' THEN l_suppkey END AS l_suppkey FROM lineitem")
def merge_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two inputs, one of them without suppliers."""
    path, li = scratch_path(spark, "merged"), flagged(spark, sf_dir)
    K.merge_captures([li.where("l_returnflag = 'A'"), li.where("l_returnflag <> 'A'").drop("l_suppkey")], path)
    return spark.read.schema(li.schema).parquet(path).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query("SELECT l_orderkey, l_linenumber, l_partkey, 'v' || l_linenumber AS client_version FROM lineitem")
def compress_and_move(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed, moved = scratch_path(spark, "packed"), scratch_path(spark, "moved")
    K.compress_captures(flagged(spark, sf_dir), packed)
    K.move_by_version(spark.read.parquet(packed), moved)
    return spark.read.parquet(moved).select("l_orderkey", "l_linenumber", "l_partkey", "client_version")


# --- loads (K09-K12) ---


@query("SELECT o_orderkey, o_custkey, o_custkey % 8 AS capture_id, CASE WHEN o_custkey % 8 = 1 THEN 'second' ELSE 'first' END AS load FROM orders WHERE o_custkey % 8 <> 2")
def replace_capture_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as eight captures: a second load replaces one and finds nothing in another."""
    path, o = scratch_path(spark, "facts"), table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", (F.col("o_custkey") % 8).alias("capture_id"))
    K.replace_capture_rows(o.withColumn("load", F.lit("first")), o.select("capture_id"), path)
    K.replace_capture_rows(o.where("capture_id = 1").withColumn("load", F.lit("second")), o.where("capture_id in (1, 2)").select("capture_id"), path)
    return spark.read.parquet(path).select("o_orderkey", "o_custkey", F.col("capture_id").cast("long").alias("capture_id"), "load")


@query("SELECT l_suppkey % 5 AS capture_id, l_orderkey AS loot_index, l_partkey AS item_id, l_linenumber AS slot, count(*) OVER (PARTITION BY l_orderkey, l_suppkey % 5) AS item_count FROM lineitem")
def write_loot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as loot, loaded twice: the items, each with the number of items of its instance."""
    li = table(spark, sf_dir, "lineitem")
    item = F.struct(F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("item_id"))
    loot = li.groupBy((F.col("l_suppkey") % 5).alias("capture_id"), F.col("l_orderkey").alias("loot_index")).agg(F.collect_list(item).alias("items"))
    loot = spark.read.parquet(written(spark, loot, "loot-lists"))  # each load reads it four times
    items, instances = scratch_path(spark, "items"), scratch_path(spark, "instances")
    for _ in range(2):
        K.write_loot(loot, loot.select("capture_id"), items, instances)
    back = spark.read.parquet(items).select("capture_id", "loot_index", "item_id", F.col("line").alias("slot"))
    counts = spark.read.parquet(instances).select("capture_id", "loot_index", F.col("item_count").cast("long").alias("item_count"))
    return back.join(counts, ["capture_id", "loot_index"]).withColumn("capture_id", F.col("capture_id").cast("long"))


@query("SELECT l_suppkey % 5 AS capture_id, l_orderkey AS loot_index, l_partkey AS item_id, CAST(l_linenumber AS INTEGER) AS line, count(*) OVER (PARTITION BY l_suppkey % 5, l_orderkey) AS item_count FROM lineitem WHERE l_suppkey % 5 <> 3 OR l_orderkey % 2 = 0")
def write_loot_at_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders of each fifth of the suppliers as loot; then one capture is replaced by half of its own, both tables at once."""
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_orderkey", "l_partkey", "l_linenumber")
    item = F.struct(F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("item_id"))
    loot = li.groupBy((F.col("l_suppkey") % 5).alias("capture_id"), F.col("l_orderkey").alias("loot_index")).agg(F.collect_list(item).alias("items"))
    path = scratch_path(spark, "loot")
    versioned.write_loot_at_once(loot, loot.select("capture_id"), path)
    third = loot.where("capture_id = 3")
    versioned.write_loot_at_once(third.where("loot_index % 2 = 0"), third.select("capture_id"), path)
    items, instances = (versioned.read_rows(spark, path, t) for t in ("items", "instances"))
    both = items.join(instances, ["capture_id", "loot_index"])
    return both.select(F.col("capture_id").cast("long").alias("capture_id"), "loot_index", "item_id", F.col("line").cast("int").alias("line"), F.col("item_count").cast("long").alias("item_count"))


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def seed_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers to add to those that have ordered."""
    return K.seed_if_absent(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])


@query(PART_SQL + "SELECT CASE WHEN fresh THEN 'insert' ELSE 'update' END AS op, k AS p_partkey, CASE WHEN k % 2 = 0 THEN 'world' ELSE 'other' END AS target_db FROM n WHERE fresh OR (n > 0 AND NOT older)")
def write_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, k = scratch_path(spark, "changes"), F.col("pk.p_partkey")
    K.write_changes(C.compare(*part_snapshots(spark, sf_dir), PART).withColumn("target_db", F.when(k % 2 == 0, "world").otherwise("other")), path)
    return spark.read.parquet(path).select("op", k.alias("p_partkey"), "target_db")


@query(ORACLE_SQL["compare_part"])
def compare_part_by_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changes of compare_part; whole rows are moved for changed and new keys only."""
    return C.compare_by_hash(*part_snapshots(spark, sf_dir), PART).select("op", F.col("pk.p_partkey").alias("p_partkey"), "n_changed")


# --- streams (T02, T03, T05, P04) ---


def drained(spark: SparkSession, stream: DataFrame) -> DataFrame:
    """What stream gives until its input ends, as a table."""
    out = scratch_path(spark, "stream")
    spark.createDataFrame([], stream.schema).write.parquet(out)
    R.load_each(stream, lambda df, _: df.write.mode("append").parquet(out), scratch_path(spark, "state")).awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def as_stream(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """df written as files and read as a stream."""
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1000).parquet(written(spark, df, name))


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).select("capture_id", "kind", "ts")
    return drained(spark, R.stream_first_seen(as_stream(spark, rows, "seen"), ["capture_id", "kind"])).select(F.col("capture_id").alias("user_id"), F.col("kind").alias("event_type"))


@query("SELECT user_id, event_type, arg_min(event_id, struct_pack(a := ts, b := event_id)) AS event_id, arg_max(event_id % 8, struct_pack(a := ts, b := event_id)) FILTER (event_id % 3 <> 0) AS phase FROM events GROUP BY 1, 2")
def stream_first_seen_with_phase(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first event of each user and kind; its phase follows the later ones that have one. Rows come in no order."""
    phase = F.when(F.col("number") % 3 != 0, F.col("number") % 8)
    rows = events(spark, sf_dir).select("capture_id", "kind", "ts", F.col("number").cast("long").alias("number"), phase.cast("long").alias("phase")).repartition(6, "number")
    stream, out = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(written(spark, rows, "sightings")), scratch_path(spark, "seen")
    updates = first_seen.stream_first_seen_with_phase(stream, ["capture_id", "kind"])
    updates.writeStream.outputMode("update").foreachBatch(lambda df, _: df.write.mode("append").parquet(out)).option("checkpointLocation", scratch_path(spark, "state")).trigger(availableNow=True).start().awaitTermination()
    last = first_seen.newest(spark.read.schema(updates.schema).parquet(out), ["capture_id", "kind"])
    return last.select(F.col("capture_id").alias("user_id"), F.col("kind").alias("event_type"), F.col("number").alias("event_id"), "phase")


@query(ORACLE_SQL["link_request_response"])
def stream_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The links of link_request_response, by state."""
    s = sessions(spark, sf_dir)
    linked = drained(spark, R.stream_link(as_stream(spark, s, "sessions"), window_ms=HALF_DAY_MS)).where("kind = 'response'")
    own = s.select("capture_id", "number", "event_id")
    of = own.select("capture_id", F.col("number").alias("selection_number"), F.col("event_id").alias("selection"))
    return linked.join(own, ["capture_id", "number"]).join(of, ["capture_id", "selection_number"], "left").select("event_id", "selection")


@query("SELECT event_id, last_value(CASE WHEN event_type = 'click' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id) AS last_click FROM events")
def stream_session_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event with the last click of its user."""
    rows = events(spark, sf_dir).select("capture_id", F.col("number").cast("long").alias("number"), F.when(F.col("kind") == "click", F.col("number")).cast("long").alias("click"))
    return drained(spark, R.stream_session_state(as_stream(spark, rows, "states"), "capture_id", "click")).select(F.col("number").alias("event_id"), F.col("current_click").alias("last_click"))


@query(ORACLE_SQL["entity_lifecycle"])
def stream_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The states of entity_lifecycle as a stream in update mode, in a few triggers in order; the last of each entity counts."""
    kinds = F.when(F.col("kind") == "signup", "create").when(F.col("kind") == "error", "destroy").otherwise("update")
    rows = events(spark, sf_dir).select(F.col("capture_id").alias("guid"), F.col("number").cast("long").alias("number"), "ts", kinds.alias("kind"), F.when(F.col("kind") != "view", F.col("value")).alias("value"))
    path, out = scratch_path(spark, "entities"), scratch_path(spark, "states")
    cuts = rows.agg(F.percentile_approx("number", [0.3, 0.7])).first()[0]
    state = scratch_path(spark, "state")
    for low, high in zip([None, *cuts], [*cuts, None], strict=True):  # a part, in as many files as it has, is a trigger
        part = rows.where((F.lit(low).isNull() | (F.col("number") > F.lit(low))) & (F.lit(high).isNull() | (F.col("number") <= F.lit(high))))
        part.write.mode("append").parquet(path)
        stream = R.stream_lifecycle(spark.readStream.schema(rows.schema).parquet(path), "guid", ["value"], idle="3650 days")
        stream.writeStream.outputMode("update").foreachBatch(lambda df, _: df.write.mode("append").parquet(out)).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
    last = spark.read.schema(stream.schema).parquet(out).groupBy("guid").agg(F.max_by(F.struct("last_number", "alive", "value"), "last_number").alias("s"))
    return last.select(F.col("guid").alias("user_id"), "s.*")


@query("SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def records_called_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A callback that keeps the records of each trigger, counted."""
    rows, out = events(spark, sf_dir).select("number", "kind"), scratch_path(spark, "records")
    on_records(as_stream(spark, rows, "records-in"), lambda df: df.write.mode("append").parquet(out), scratch_path(spark, "state")).awaitTermination()
    return spark.read.schema(rows.schema).parquet(out).groupBy(F.col("kind").alias("event_type")).agg(F.count("*").alias("n"))


# --- producers and processors (P01, P02) ---


@query("SELECT 'part_sizes' AS producer, p_size AS k, count(*) AS n FROM part GROUP BY 1, 2 UNION ALL SELECT 'order_states', CAST(ascii(o_orderstatus) AS INTEGER), count(*) FROM orders GROUP BY 1, 2")
def producers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two producers that fit, one that lacks an input, one of another version."""
    r = Registry()

    @r.producer("world", ("part",))
    def part_sizes(t: dict) -> DataFrame:
        return t["part"].groupBy(F.col("p_size").alias("k")).agg(F.count("*").alias("n"))

    @r.producer("world", ("orders",))
    def order_states(t: dict) -> DataFrame:
        return t["orders"].groupBy(F.ascii("o_orderstatus").alias("k")).agg(F.count("*").alias("n"))

    @r.producer("world", ("absent",))
    def lacking(t: dict) -> DataFrame:
        return t["absent"]

    @r.producer("world", ("part",), 2)
    def later(t: dict) -> DataFrame:
        return t["part"]

    out, failed = r.produce({n: table(spark, sf_dir, n) for n in ("part", "orders")}, "world", 1)
    assert sorted(out) == ["order_states", "part_sizes"] and not failed
    return W.union_all([df.select(F.lit(name).alias("producer"), "k", "n") for name, df in out.items()])


@query("SELECT event_type AS kind, count(*) AS n, count(DISTINCT user_id) AS users FROM events WHERE event_type IN ('click', 'view') GROUP BY 1")
def processors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Processors over the events of their kind."""
    r = Registry()
    for kind in ("click", "view"):
        r.processor(kind)(lambda df: df.groupBy("kind").agg(F.count("*").alias("n"), F.count_distinct("capture_id").alias("users")))
    return W.union_all([df for own in r.process(events(spark, sf_dir)).values() for df in own])


def count_and_most(kind: str) -> Fold:
    """The number of events of a kind and the largest of their numbers."""

    def larger(a: list, b: list) -> list:
        return [a[0] + b[0], max(a[1], b[1])]

    return Fold(kind, (kind,), ("number",), "n long, most long", lambda: [0, -1], lambda s, x: larger(s, [x.num_rows, pc.max(x.column("number")).as_py()]), larger, lambda s: {"n": s[0], "most": s[1]})


@query("SELECT event_type AS processor, user_id, count(*) AS n, max(event_id) AS most FROM events WHERE event_type IN ('click', 'view', 'error') GROUP BY 1, 2")
def processors_folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three folding processors in one pass over the events."""
    r = Registry()
    for kind in ("click", "view", "error"):
        r.fold(count_and_most(kind))
    return W.union_all([df.select(F.lit(name).alias("processor"), F.col("capture_id").alias("user_id"), "n", "most") for name, df in r.fold_all(events(spark, sf_dir)).items()])


@query("SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_returnflag) - 1 AS sub, l_suppkey % 65536 AS opcode, l_returnflag || l_partkey AS body FROM lineitem")
def frames_in_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as containers of their lines' frames in bytes, taken apart by the table function."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.concat("l_returnflag", F.col("l_partkey").cast("string")).alias("body"))
    low = lambda n: F.unhex(F.concat(F.lpad(F.hex(n % 256), 2, "0"), F.lpad(F.hex(F.floor(n / 256)), 2, "0")))
    frame = F.concat(low(F.length("body").cast("long")), low((F.col("l_suppkey") % 65536).cast("long")), F.encode("body", "UTF-8"))
    one = F.struct("l_linenumber", "l_partkey", "l_suppkey", "body", F.hex(frame).alias("hex"))
    orders = li.groupBy("l_orderkey").agg(F.array_join(F.transform(F.sort_array(F.collect_list(one)), lambda x: x["hex"]), "").alias("hex")).select("l_orderkey", F.unhex("hex").alias("payload"))
    out = frames_source.with_frames(orders)
    return out.select("l_orderkey", F.col("sub").cast("long").alias("sub"), F.col("opcode").cast("long").alias("opcode"), F.decode("payload", "UTF-8").alias("body"))


# --- the operators that no other query calls ---


@query("SELECT unnest(['zzz', 'QQQ']) AS pattern WHERE (SELECT count(*) FROM part WHERE lower(p_name) LIKE '%zzz%' OR lower(p_name) LIKE '%qqq%') = 0")
def warn_unmatched_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.warn_unmatched_patterns(spark, ["zzz", "QQQ", "-no", "A", "e"], table(spark, sf_dir, "part").select(F.col("p_name").alias("name")))


@query("SELECT p_partkey, p_brand AS name_de, p_size FROM part")
def project_for_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = TableSpec("part", (Column("p_partkey", T.LongType(), key=True), Column("p_size", T.IntegerType(), versions=2), Column("p_type", T.StringType(), versions=1), Column("name_de", T.StringType(), locale="deDE"), Column("name_fr", T.StringType(), locale="frFR")))
    p = table(spark, sf_dir, "part").withColumnsRenamed({"p_brand": "name_de", "p_name": "name_fr"})
    return specs.project_for_version(p, spec, 2, "deDE").select("p_partkey", "name_de", "p_size")


@query("SELECT CASE WHEN l_linenumber > 1 THEN l_orderkey END AS a, CASE WHEN l_linenumber > 2 THEN l_returnflag END AS b FROM lineitem WHERE l_linenumber > 1")
def drop_all_null_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("l_linenumber")
    return D.drop_all_null_rows(table(spark, sf_dir, "lineitem").select(F.when(n > 1, F.col("l_orderkey")).alias("a"), F.when(n > 2, F.col("l_returnflag")).alias("b")))


@query("SELECT l_partkey % 9 AS scene_id, l_suppkey AS flags, l_orderkey % 4 AS script_package_id FROM lineitem WHERE l_partkey % 9 <> 0 AND l_orderkey % 4 <> 0 AND l_linenumber <> 3")
def savable_scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select((F.col("l_partkey") % 9).alias("entry"), F.col("l_suppkey").alias("flags"), (F.col("l_orderkey") % 4).alias("script_package_id"), F.col("l_linenumber").alias("scene_type"))
    return L.savable_scenes(li, 3)


@query("SELECT doc_id, lang FROM documents WHERE lang <> 'en'")
def locale_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.locale_rows(table(spark, sf_dir, "documents").select("doc_id", "lang"), "en", "lang")


@query("SELECT o_orderkey, CASE WHEN o_custkey % 3 = 0 THEN c_nationkey ELSE 0 END AS menu_id, CASE WHEN o_custkey % 3 = 0 THEN o_custkey % 7 ELSE 0 END AS option_id, CASE WHEN o_custkey % 3 = 0 THEN o_custkey END AS creature_id FROM orders JOIN customer ON c_custkey = o_custkey")
def link_trainer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as trainer lists that answer their customer's selection, where there is one."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.lit(1).alias("capture_id"), F.col("o_custkey").alias("selection_number"))
    k = F.col("c_custkey")
    chosen = table(spark, sf_dir, "customer").where(k % 3 == 0).select(F.lit(1).alias("capture_id"), k.alias("number"), k.alias("creature_id"), F.col("c_nationkey").cast("long").alias("menu_id"), (k % 7).alias("option_id"))
    return J.link_trainer(o, chosen).select("o_orderkey", "menu_id", "option_id", "creature_id")


@query("""
    WITH r AS (SELECT l_suppkey % 3 AS t, l_partkey AS r, arg_max(l_linenumber, l_orderkey * 10 + l_linenumber) AS s FROM lineitem WHERE l_linenumber IN (1, 2) GROUP BY 1, 2)
    SELECT p_partkey, r.t AS table_hash FROM part JOIN r ON r.r = p_partkey AND r.s = 1""")
def optional_data_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as optional data of records: lines 1 are valid records, lines 2 remove them."""
    li = table(spark, sf_dir, "lineitem")
    number = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    status = F.when(F.col("l_linenumber") == 1, C.VALID).when(F.col("l_linenumber") == 2, C.REMOVED).otherwise(0)
    records = li.select((F.col("l_suppkey") % 3).alias("table_hash"), F.col("l_partkey").alias("record_id"), status.alias("status"), F.lit("p").alias("payload"), number.alias("number"), number.alias("unique_id"))
    optional = table(spark, sf_dir, "part").select(F.explode(F.array(*(F.lit(x).cast("long") for x in range(3)))).alias("table_hash"), F.col("p_partkey").alias("record_id"))
    return C.optional_data_link(optional, records).select(F.col("record_id").alias("p_partkey"), "table_hash")


@query("""
    WITH f AS (SELECT l_suppkey, l_linenumber, arg_min(l_partkey, l_orderkey) AS p FROM (SELECT l_suppkey, l_linenumber, l_orderkey, min(l_partkey) AS l_partkey FROM lineitem GROUP BY 1, 2, 3) GROUP BY 1, 2)
    SELECT s_suppkey AS menu_id, o AS option_id, p AS order_index FROM supplier CROSS JOIN range(1, 9) t(o) LEFT JOIN f ON l_suppkey = s_suppkey AND l_linenumber = o""")
def option_by_index_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as menus, line numbers as options, parts as order indexes."""
    li = table(spark, sf_dir, "lineitem").groupBy("l_suppkey", "l_linenumber", "l_orderkey").agg(F.min("l_partkey").alias("order_index"))
    options = li.select(F.col("l_suppkey").alias("menu_id"), F.col("l_linenumber").cast("long").alias("option_id"), "order_index", F.timestamp_seconds("l_orderkey").alias("ts"), F.col("l_orderkey").alias("number"))
    chosen = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("menu_id"), F.explode(F.sequence(F.lit(1).cast("long"), F.lit(8).cast("long"))).alias("option_id"))
    return J.option_by_index_map(chosen, options)


@query("""
    WITH l AS (SELECT user_id, event_id, user_id * 2 + event_id % 2 AS guid FROM events WHERE event_type = 'click')
    SELECT e.event_id, max_by(l.guid, l.event_id) % 5 AS race FROM events e JOIN l ON l.user_id = e.user_id AND l.event_id <= e.event_id WHERE e.event_type = 'purchase' GROUP BY 1 HAVING max_by(l.guid, l.event_id) % 3 <> 0""")
def start_data_by_first_login(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases as rows, clicks as logins of one of a user's two characters; every third character isn't new."""
    e = events(spark, sf_dir)
    guid = F.col("capture_id") * 2 + F.col("number") % 2
    logins = e.where("kind = 'click'").select("capture_id", "number", guid.alias("guid"))
    characters = logins.select("capture_id", "guid").distinct().select("capture_id", "guid", (F.col("guid") % 3 != 0).alias("first_login"), (F.col("guid") % 5).alias("race"), F.lit(1).alias("class"))
    return J.start_data_by_first_login(e.where("kind = 'purchase'").select("capture_id", "number"), logins, characters).select(F.col("number").alias("event_id"), "race")


@query("""
    WITH c AS (SELECT user_id, count(*) FILTER (event_type = 'click') AS a, count(*) FILTER (event_type = 'purchase') AS b, count(*) FILTER (event_type = 'error') AS c, count(*) FILTER (event_type NOT IN ('click', 'purchase', 'error', 'view')) AS d FROM events GROUP BY 1)
    SELECT user_id, (a + b + c + d) || ' packets: ' || a || ' success, ' || b || ' with errors, ' || c || ' not parsed, ' || d || ' no structure' AS line FROM c""")
def stats_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary lines of users, without the shares in brackets."""
    status = F.when(F.col("kind") == "click", "success").when(F.col("kind") == "purchase", "with_errors").when(F.col("kind") == "error", "not_parsed").when(F.col("kind") == "view", "none").otherwise("no_structure")
    stats = A.parse_stats(events(spark, sf_dir).select("capture_id", status.alias("status"), F.lit(True).alias("write_to_file")))
    return A.stats_line(stats).select(F.col("capture_id").alias("user_id"), F.regexp_replace("line", r" \([0-9.]+%\)", "").alias("line"))


@query("SELECT o_custkey, string_agg(o_orderstatus, ',' ORDER BY o_orderkey) AS states FROM orders GROUP BY 1")
def multi_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = D.multi_map(table(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderstatus"], ["o_orderkey"])
    return out.select("o_custkey", F.array_join(F.transform("values", lambda v: v["o_orderstatus"]), ",").alias("states"))


@query("""
    WITH t AS (SELECT n_regionkey AS tree, string_agg(n_name, ', ' ORDER BY n_nationkey) AS titles FROM nation GROUP BY 1)
    SELECT p_size AS criteria_id, string_agg(concat_ws(' ', titles, p_brand), ' / ' ORDER BY p_partkey) AS description FROM part LEFT JOIN t ON tree = p_partkey GROUP BY 1""")
def criteria_descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as achievements of their region's tree, parts as trees, sizes as criteria."""
    achievements = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_regionkey").cast("long").alias("tree_id"), F.col("n_name").alias("title"))
    trees = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("tree_id"), F.col("p_size").alias("criteria_id"), F.col("p_brand").alias("description"))
    return A.criteria_descriptions(achievements, trees)


@query("SELECT n_nationkey AS id, n_name AS name FROM nation WHERE n_regionkey = 0")
def zones_by_parent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.zones_by_parent(table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), F.col("n_regionkey").alias("parent_id")))


@query("""
    WITH i AS (SELECT l_suppkey AS entry, l_partkey AS item_id, l_linenumber % 2 + 1 AS type, l_orderkey, l_linenumber, CASE WHEN l_linenumber % 2 = 1 THEN CAST(l_quantity AS INTEGER) WHEN l_quantity > 25 THEN 0 ELSE 7 END AS max_count FROM lineitem)
    SELECT entry, item_id, type, arg_min(max_count, struct_pack(a := l_orderkey, b := l_linenumber)) AS max_count FROM i GROUP BY 1, 2, 3""")
def vendor_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as the lists of their suppliers; lines of even number are goods, the others currency."""
    n = F.col("l_linenumber")
    item = F.struct(n.alias("line"), F.col("l_partkey").alias("item_id"), (n % 2 + 1).alias("type"), F.when(F.col("l_quantity") > 25, -1).otherwise(7).alias("stock"), F.col("l_quantity").cast("int").alias("stack_count"))
    lists = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("entry"), "l_orderkey").agg(F.sort_array(F.collect_list(item)).alias("items"))
    return A.vendor_items(lists.select("entry", F.timestamp_seconds("l_orderkey").alias("ts"), F.col("l_orderkey").alias("number"), "items")).select("entry", "item_id", "type", "max_count")


@query("SELECT event_id AS id, user_id AS unique_id, event_id % 3 AS table_hash, user_id AS record_id, event_type AS status FROM events")
def cdc_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return C.cdc_log(e.select(F.col("event_id").alias("id"), F.col("user_id").alias("unique_id"), (F.col("event_id") % 3).alias("table_hash"), F.col("user_id").alias("record_id"), F.col("event_type").alias("status"), "value"))


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_custkey, o_orderkey) AS place FROM orders")
def order_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of each order in the order of customer and key, as the files of the sorted table have it."""
    path = written(spark, W.order_by_key(table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey"), ["o_custkey", "o_orderkey"]).withColumn("at", F.monotonically_increasing_id()), "ordered")
    return W.global_number(spark.read.parquet(path), ["at"], "n", scratch_path(spark, "places")).select("o_orderkey", (F.col("n") + 1).alias("place"))


@query("SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS place FROM events")
def order_by_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = written(spark, W.order_by_first_seen(events(spark, sf_dir).select("ts", "number")).withColumn("at", F.monotonically_increasing_id()), "ordered")
    return W.global_number(spark.read.parquet(path), ["at"], "n", scratch_path(spark, "places")).select(F.col("number").alias("event_id"), (F.col("n") + 1).alias("place"))


@query("SELECT o_custkey, arg_min(o_orderkey, struct_pack(a := -o_totalprice, b := o_orderkey)) AS o_orderkey FROM orders GROUP BY 1")
def first_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dearest order of each customer, the first of equal ones."""
    return D.first_match(table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", (-F.col("o_totalprice")).alias("less")), ["o_custkey"], ["less", "o_orderkey"]).select("o_custkey", "o_orderkey")


@query("SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier")
def union_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    return W.union_all([c, table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))])


@query("""
    WITH o AS (SELECT l_orderkey, list(DISTINCT l_suppkey % 6) FILTER (l_returnflag = 'N') AS a, list(DISTINCT l_suppkey % 6) FILTER (l_linestatus = 'O') AS b FROM lineitem GROUP BY 1)
    SELECT l_orderkey, array_to_string(list_sort(list_intersect(coalesce(a, []), coalesce(b, []))), ',') AS both, array_to_string(list_sort(list_distinct(list_concat(coalesce(a, []), coalesce(b, [])))), ',') AS either FROM o""")
def set_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("l_suppkey") % 6
    o = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_set(F.when(F.col("l_returnflag") == "N", s)).alias("a"), F.collect_set(F.when(F.col("l_linestatus") == "O", s)).alias("b"))
    text = lambda c: F.array_join(F.transform(F.sort_array(c), lambda x: x.cast("string")), ",")
    return o.select("l_orderkey", text(W.intersect_lists(F.col("a"), F.col("b"))).alias("both"), text(W.union_sets(F.col("a"), F.col("b"))).alias("either"))
