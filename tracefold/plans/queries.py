"""The registered queries: each operator over the whole of a given table, and DuckDB SQL for the same rows.

`events` plays the capture: a user is a capture or session, event_id the number,
event_type the kind. Snapshots to compare are derived from the tables by rule.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column as SparkColumn
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalars as X
from ..functions.specs import Column, TableSpec
from ..operators import aggregates as A
from ..operators import changes as C
from ..operators import dedupe as D
from ..operators import filters as L
from ..operators import joins as J
from ..operators import windows as W
from ..sources.scratch import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def mark(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return mark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("capture_id"), F.col("event_id").alias("number"), F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("kind"), "value", "props")


# --- change sets ---

PART = TableSpec("part", (Column("p_partkey", T.LongType(), key=True), Column("p_name", T.StringType()), Column("p_brand", T.StringType()), Column("p_size", T.IntegerType()), Column("p_retailprice", T.DoubleType()), Column("build", T.IntegerType())), build="build")


def part_snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """part as the reference (builds 0 to 4), and an observation at build 3 with edits, values within tolerance and new keys."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_size", "p_retailprice")
    k = F.col("p_partkey")
    ref = part.withColumn("build", (k % 5).cast("int"))
    obs = part.select("p_partkey", F.when(k % 13 == 0, F.concat("p_name", F.lit(" \r\n"))).when(k % 17 == 0, F.concat("p_name", F.lit("x"))).otherwise(F.col("p_name")).alias("p_name"), "p_brand", F.when(k % 7 == 0, F.col("p_size") + 1).otherwise(F.col("p_size")).alias("p_size"), F.when(k % 11 == 0, F.col("p_retailprice") + 0.0004).when(k % 19 == 0, F.col("p_retailprice") + 1).otherwise(F.col("p_retailprice")).alias("p_retailprice"))
    new = obs.where(k % 50 == 0).withColumn("p_partkey", k + 10_000_000)
    return obs.unionByName(new).withColumn("build", F.lit(3)), ref


PART_SQL = r"""
    WITH r AS (SELECT p_partkey AS k, p_name, p_brand, p_size, p_retailprice, CAST(p_partkey % 5 AS INTEGER) AS build FROM part),
    o0 AS (SELECT p_partkey AS k, CASE WHEN p_partkey % 17 = 0 AND p_partkey % 13 <> 0 THEN p_name || 'x' ELSE p_name END AS p_name, p_brand,
        CASE WHEN p_partkey % 7 = 0 THEN p_size + 1 ELSE p_size END AS p_size,
        CASE WHEN p_partkey % 11 = 0 THEN p_retailprice + 0.0004 WHEN p_partkey % 19 = 0 THEN p_retailprice + 1 ELSE p_retailprice END AS p_retailprice FROM part),
    o AS (SELECT * FROM o0 UNION ALL SELECT k + 10000000, p_name, p_brand, p_size, p_retailprice FROM o0 WHERE k % 50 = 0),
    d AS (SELECT o.k, r.k IS NULL AS fresh, coalesce(r.build > 3, false) AS older, o.p_name <> r.p_name AS c1, o.p_size <> r.p_size AS c2,
        abs(o.p_retailprice - r.p_retailprice) >= 0.001 AS c3, r.build <> 3 AS c4, o.p_name, o.p_brand, o.p_size, o.p_retailprice,
        r.p_name AS rn, r.p_size AS rs, r.p_retailprice AS rp, r.build AS rb FROM o LEFT JOIN r USING (k)),
    n AS (SELECT *, CAST(c1 AS INT) + CAST(c2 AS INT) + CAST(c3 AS INT) + CAST(c4 AS INT) AS n FROM d)
"""


@query(PART_SQL + "SELECT CASE WHEN fresh THEN 'insert' ELSE 'update' END AS op, k AS p_partkey, CASE WHEN fresh THEN 5 ELSE n END AS n_changed FROM n WHERE fresh OR (n > 0 AND NOT older)")
def compare_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.compare(*part_snapshots(spark, sf_dir), PART).select("op", F.col("pk.p_partkey").alias("p_partkey"), "n_changed")


@query(PART_SQL + "SELECT CASE WHEN fresh THEN 'insert' ELSE 'update' END AS op, k AS p_partkey, CASE WHEN fresh THEN 5 ELSE n END AS n_changed FROM n WHERE fresh OR (n > 0 AND NOT older AND NOT (n = 1 AND c4))")
def skip_build_only_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = C.compare(*part_snapshots(spark, sf_dir), PART)
    return C.skip_build_only_updates(changes).select("op", F.col("pk.p_partkey").alias("p_partkey"), "n_changed")


@query(PART_SQL + """
    SELECT k AS p_partkey, CASE WHEN fresh OR (c1 AND NOT older) THEN trim(p_name) ELSE rn END AS p_name,
        CASE WHEN fresh OR (c2 AND NOT older) THEN p_size ELSE rs END AS p_size,
        round(CASE WHEN fresh OR (c3 AND NOT older) THEN p_retailprice ELSE rp END, 3) AS p_retailprice,
        CASE WHEN fresh OR (c4 AND NOT older) THEN 3 ELSE rb END AS build FROM n""")
def apply_changes_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs, ref = part_snapshots(spark, sf_dir)
    out = C.apply_changes(ref, C.compare(obs, ref, PART), PART)
    return out.select("p_partkey", X.trimmed(F.col("p_name")).alias("p_name"), "p_size", F.round("p_retailprice", 3).alias("p_retailprice"), "build")


@query(PART_SQL + """
    SELECT n AS n_columns, CAST(b AS INTEGER) AS batch, count(*) AS n_rows, min(k) AS first_key
    FROM (SELECT *, (row_number() OVER (ORDER BY k) - 1) // 5000 AS b FROM n WHERE NOT fresh AND n > 0 AND NOT older AND NOT c1 AND NOT c2 AND NOT c3) GROUP BY 1, 2""")
def group_identical_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Updates that set the same values (here those of the build alone), over all their keys."""
    grouped = C.group_identical_updates(C.compare(*part_snapshots(spark, sf_dir), PART))
    alone = grouped.where((F.size("changes") == 1) & F.map_contains_key("changes", F.lit("build")))
    return alone.select(F.size("changes").alias("n_columns"), "batch", F.col("n").alias("n_rows"), F.get("pks", F.lit(0))["p_partkey"].alias("first_key"))


@query("SELECT s_suppkey, s_suppkey % 3 <> 0 AS in_reference FROM supplier")
def split_insert_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    return C.split_insert_update(s, s.where("s_suppkey % 3 <> 0"), ["s_suppkey"]).select("s_suppkey", "in_reference")


@query("""
    WITH rec AS (SELECT o_orderkey AS k, o_orderkey % 4 + 1 AS status, 1 AS number FROM orders WHERE o_orderkey % 3 = 0
        UNION ALL SELECT o_orderkey, 1, 2 FROM orders WHERE o_orderkey % 9 = 0 UNION ALL SELECT o_orderkey + 100000000, 1, 3 FROM orders WHERE o_orderkey % 10 = 0),
    last AS (SELECT k, status, number FROM rec WHERE status IN (1, 2) QUALIFY row_number() OVER (PARTITION BY k ORDER BY number DESC) = 1)
    SELECT coalesce(o.o_orderkey, l.k) AS o_orderkey, CASE WHEN l.k IS NULL THEN o.o_orderstatus ELSE 'N' || l.number END AS payload
    FROM orders o FULL JOIN last l ON o.o_orderkey = l.k WHERE l.k IS NULL OR l.status = 1""")
def apply_cdc_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    base = orders.select(F.lit(7).alias("table_hash"), k.alias("record_id"), F.col("o_orderstatus").alias("payload"))
    rec = lambda df, key, status, n: df.select(F.lit(7).alias("table_hash"), key.alias("record_id"), status.cast("int").alias("status"), F.lit(n).alias("number"), F.lit(n).alias("unique_id"), F.lit(f"N{n}").alias("payload"))
    records = rec(orders.where(k % 3 == 0), k, k % 4 + 1, 1).unionByName(rec(orders.where(k % 9 == 0), k, F.lit(1), 2)).unionByName(rec(orders.where(k % 10 == 0), k + 100_000_000, F.lit(1), 3))
    return C.apply_cdc(base, records).select(F.col("record_id").alias("o_orderkey"), "payload")


# --- statistics and first-wins ---

def outcome() -> SparkColumn:
    return F.when(F.col("kind") == "click", "success").when(F.col("kind") == "purchase", "with_errors").when(F.col("kind") == "error", "not_parsed").when(F.col("kind") == "signup", "no_structure").otherwise("none")


@query("""
    WITH s AS (SELECT user_id AS capture_id, count(*) FILTER (event_type = 'click') AS success, count(*) FILTER (event_type = 'purchase') AS with_errors,
        count(*) FILTER (event_type = 'error') AS not_parsed, count(*) FILTER (event_type = 'signup') AS no_structure FROM events GROUP BY 1)
    SELECT capture_id, success, with_errors, not_parsed, no_structure, round(100.0 * success / nullif(success + with_errors + not_parsed + no_structure, 0), 6) AS success_pct FROM s""")
def parse_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir).withColumn("status", outcome()).withColumn("write_to_file", F.lit(True))
    return A.parse_stats(e).select("capture_id", *A.OUTCOMES, F.round("success_pct", 6).alias("success_pct"))


@query("SELECT user_id AS capture_id, count(*) AS events, min(ts) AS first_ts, max(ts) AS last_ts FROM events GROUP BY 1")
def prescan_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.prescan_stats(events(spark, sf_dir)).select("capture_id", "events", *(F.col(c).cast("timestamp_ntz").alias(c) for c in ("first_ts", "last_ts")))


@query("SELECT event_id, CAST(floor(epoch_us(ts - min(ts) OVER (PARTITION BY user_id)) / 1000) AS BIGINT) AS rel_ms FROM events")
def relative_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.relative_time(events(spark, sf_dir)).select(F.col("number").alias("event_id"), "rel_ms")


@query("SELECT user_id, event_type, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1")
def first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.first_seen(events(spark, sf_dir), ["capture_id", "kind"]).select(F.col("capture_id").alias("user_id"), F.col("kind").alias("event_type"), F.col("number").alias("event_id"), "value")


@query("SELECT user_id, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) <= 3")
def first_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.first_events(events(spark, sf_dir), 2).select(F.col("capture_id").alias("user_id"), F.col("number").alias("event_id"))


@query("SELECT l_partkey, l_suppkey, l_quantity, l_orderkey, l_linenumber FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_partkey, l_suppkey, l_quantity ORDER BY l_orderkey, l_linenumber) = 1")
def dedupe_spatial(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_quantity", "l_orderkey", "l_linenumber")
    return D.dedupe_spatial(rows, ["l_orderkey", "l_linenumber"], ("l_quantity",), ("l_partkey", "l_suppkey"))


# --- filters ---


@query("SELECT event_id FROM events WHERE (event_type ILIKE '%CLI%' OR event_type ILIKE '%er%') AND NOT event_type ILIKE '%rr%'")
def filter_opcodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.filter_opcodes(events(spark, sf_dir), ["CLI", "er"], ["rr"], "kind").select(F.col("number").alias("event_id"))


@query("SELECT event_id FROM events WHERE CASE WHEN event_type = 'click' THEN user_id NOT IN (1, 2, 3) ELSE event_type = 'purchase' AND user_id IN (3, 4, 5, 6) END")
def filter_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    include, ignore = L.parse_entry_lists("purchase:3:4:5:6"), L.parse_entry_lists("click:1:2:3")
    return L.filter_entries(events(spark, sf_dir), include, ignore, "kind", "capture_id").select(F.col("number").alias("event_id"))


@query("SELECT o_orderkey FROM orders WHERE contains(CAST(o_custkey AS VARCHAR), '12') AND (contains(CAST(o_orderkey AS VARCHAR), '7') OR contains(CAST(o_orderkey AS VARCHAR), '45'))")
def filter_area_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.filter_area_map(table(spark, sf_dir, "orders"), ["12"], ["7", "45"], "o_custkey", "o_orderkey").select("o_orderkey")


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE (l_linenumber & 5) <> 0")
def filter_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.filter_status(table(spark, sf_dir, "lineitem"), 5, "l_linenumber").select("l_orderkey", "l_linenumber")


@query("SELECT s_suppkey FROM supplier WHERE NOT (s_nationkey = 3 AND abs(s_acctbal - 0) < 0.001) AND s_nationkey IS NOT NULL")
def skip_default_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    spec = TableSpec("supplier", (Column("s_suppkey", T.LongType(), key=True), Column("s_nationkey", T.IntegerType()), Column("s_acctbal", T.DoubleType())))
    defaults = s.agg(F.lit(3).alias("s_nationkey"), F.lit(0.0).alias("s_acctbal"))
    return L.skip_default_rows(s, spec, defaults).select("s_suppkey")


# --- as-of and links ---


@query("SELECT c.event_id, p.value AS last_value FROM (SELECT * FROM events WHERE event_type = 'click') c ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') p ON c.user_id = p.user_id AND c.ts >= p.ts")
def asof_session_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The value of the user's last purchase as of each click."""
    e = events(spark, sf_dir)
    clicks, states = e.where("kind = 'click'").drop("value"), e.where("kind = 'purchase'").select("capture_id", "ts", F.col("value").alias("last_value"))
    return J.asof(clicks, states, ["capture_id"], ["ts"], ["ts"], ["last_value"]).select(F.col("number").alias("event_id"), "last_value")


@query("SELECT c.event_id FROM (SELECT * FROM events WHERE event_type = 'view') c ASOF LEFT JOIN (SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS n FROM events WHERE event_type = 'signup') p ON c.user_id = p.user_id AND c.ts >= p.ts WHERE coalesce(p.n, 0) <= 40")
def asof_party_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views while the user's last signup says 40 or less."""
    e = events(spark, sf_dir)
    parties = e.where("kind = 'signup'").select("capture_id", "ts", F.get_json_object("props", "$.k").cast("int").alias("player_count"))
    return J.asof_party_size(e.where("kind = 'view'"), parties, 40).select(F.col("number").alias("event_id"))


HALF_DAY_MS = 12 * 3600 * 1000


def link_kinds() -> SparkColumn:
    return F.when(F.col("kind") == "click", "selection").when(F.col("kind") == "purchase", "response").when(F.col("kind") == "error", "reset").when(F.col("kind") == "signup", "detail")


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events in time order: number is the time in microseconds, told apart by the event id."""
    e = events(spark, sf_dir)
    return e.select("capture_id", (F.unix_micros("ts") * 100 + F.col("number") % 100).alias("number"), "ts", link_kinds().alias("kind"), F.col("number").alias("event_id")).where("kind is not null")


@query("""
    WITH s AS (SELECT *, lag(event_type) OVER w AS k, lag(event_id) OVER w AS b, lag(ts) OVER w AS t FROM events WHERE event_type IN ('click', 'purchase', 'error')
        WINDOW w AS (PARTITION BY user_id ORDER BY epoch_us(ts) * 100 + event_id % 100))
    SELECT event_id, CASE WHEN k = 'click' AND epoch_us(ts) - epoch_us(t) <= 43200000000 THEN b END AS selection FROM s WHERE event_type = 'purchase'""")
def link_request_response(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases that answer the click before them within half a day, unless an error comes between."""
    s = sessions(spark, sf_dir)
    linked = J.link_request_response(s, HALF_DAY_MS)
    of = s.where("kind = 'selection'").select("capture_id", F.col("number").alias("selection_number"), F.col("event_id").alias("selection"))
    return linked.join(of, ["capture_id", "selection_number"], "left").select("event_id", "selection")


@query("""
    WITH s AS (SELECT *, lag(event_type) OVER w AS k, lag(ts) OVER w AS t FROM events WHERE event_type IN ('click', 'purchase', 'error')
        WINDOW w AS (PARTITION BY user_id ORDER BY epoch_us(ts) * 100 + event_id % 100)),
    u AS (SELECT * FROM s WHERE event_type = 'purchase' AND NOT coalesce(k = 'click' AND epoch_us(ts) - epoch_us(t) <= 43200000000, false))
    SELECT user_id, event_id FROM u QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, epoch_us(ts) * 100 + event_id % 100) = 1""")
def default_response(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = J.link_request_response(sessions(spark, sf_dir), HALF_DAY_MS)
    return J.default_response(linked, "capture_id").select(F.col("capture_id").alias("user_id"), "event_id")


@query("""
    WITH f AS (SELECT user_id, min(ts) AS t FROM events GROUP BY 1)
    SELECT f.user_id, arg_max(e.value, e.event_id) AS value FROM f LEFT JOIN events e ON e.user_id = f.user_id AND e.event_type = 'purchase' AND abs(epoch_us(e.ts) - epoch_us(f.t)) <= 86400000000 * 2 GROUP BY 1""")
def attach_near_create(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The value of a user's last purchase within two days of their first event."""
    e = events(spark, sf_dir).withColumn("guid", F.col("capture_id"))
    entities = e.groupBy("capture_id", "guid").agg(F.min("ts").alias("ts"))
    return J.attach_near_create(entities, e.where("kind = 'purchase'").select("capture_id", "guid", "ts", "number", "value"), "value", 2 * 86400.0).select(F.col("capture_id").alias("user_id"), "value")


@query("SELECT event_id, event_id = min(event_id) OVER (PARTITION BY user_id) AS initial FROM events")
def initial_and_added_auras(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.initial_and_added_auras(events(spark, sf_dir).withColumn("guid", F.col("capture_id"))).select(F.col("number").alias("event_id"), "initial")


# --- movement ---


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir)
    k = F.get_json_object("props", "$.k").cast("double")
    return e.select("capture_id", F.col("capture_id").alias("guid"), F.col("number").alias("segment_id"), F.when(F.col("kind") == "view", 2).otherwise(1).alias("segment_points"), F.col("value").alias("x"), k.alias("y"), F.lit(0.0).alias("z"), "ts")


@query("""
    WITH p AS (SELECT user_id, event_type, value AS x, CAST(json_extract(props, '$.k') AS DOUBLE) AS y FROM events),
    m AS (SELECT user_id, count(*) AS points, count(*) FILTER (event_type = 'view') AS multi_point_segments, quantile_cont(x, 0.5) AS mx, quantile_cont(y, 0.5) AS my FROM p GROUP BY 1),
    d AS (SELECT user_id, sqrt((x - mx) * (x - mx) + (y - my) * (y - my)) AS d FROM p JOIN m USING (user_id)),
    r AS (SELECT user_id, max(d) AS radius, quantile_cont(d, 0.99) AS robust FROM d GROUP BY 1)
    SELECT user_id, points, multi_point_segments, round(mx, 6) AS median_x, round(my, 6) AS median_y, round(radius, 6) AS radius, round(robust, 6) AS radius_robust, CASE WHEN multi_point_segments > 0 THEN 'path' ELSE 'wander' END AS kind FROM m JOIN r USING (user_id)""")
def movement_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = A.movement_kind(A.movement_summary(points(spark, sf_dir)))
    return s.select(F.col("capture_id").alias("user_id"), "points", "multi_point_segments", *(F.round(c, 6).alias(c) for c in ("median_x", "median_y", "radius", "radius_robust")), "kind")


@query("SELECT event_id, dense_rank() OVER (PARTITION BY user_id ORDER BY event_type) - 1 AS segment_id, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) - 1 AS point_index, count(*) OVER (PARTITION BY user_id, event_type) AS segment_points FROM events")
def segment_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir).withColumn("guid", F.col("capture_id"))
    s = W.segment_ids(e, order=("kind", "number"))
    return s.select(F.col("number").alias("event_id"), *(F.col(c).cast("long").alias(c) for c in ("segment_id", "point_index", "segment_points")))


@query("""
    WITH s AS (SELECT user_id, ts, lag(ts) OVER w AS b, lag(CAST(floor(value * 1000000) AS BIGINT)) OVER w AS took FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
    SELECT user_id, count(*) FILTER (b IS NOT NULL) AS transitions, count(*) FILTER (epoch_us(ts) > epoch_us(b) + took * 1000) AS pauses FROM s GROUP BY 1""")
def pauses(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir).withColumns({"guid": F.col("capture_id"), "move_time_ms": F.floor(F.col("value") * 1_000_000)})
    return W.pauses(e).select(F.col("capture_id").alias("user_id"), "transitions", "pauses")


@query("""
    SELECT l_orderkey, l_linenumber, CASE WHEN (f & 3) <> 0 THEN 3 WHEN (f & 4) <> 0 THEN 2 WHEN (f & 8) <> 0 THEN 1 WHEN l_returnflag = 'R' THEN 100 WHEN l_linenumber > 3 THEN 4 ELSE 0 END AS type
    FROM (SELECT *, CAST(l_partkey % 16 AS INTEGER) & CAST(l_suppkey % 16 AS INTEGER) AS f FROM lineitem)""")
def path_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    f = (F.col("l_partkey") % 16).cast("int").bitwiseAND((F.col("l_suppkey") % 16).cast("int"))
    return li.select("l_orderkey", "l_linenumber", W.path_type(f, F.col("l_returnflag") == "R", F.col("l_linenumber") - 3).alias("type"))


@query("""
    WITH n AS (SELECT l_orderkey AS g, ((CAST(l_linenumber AS BIGINT) * 100000000 + l_partkey) * 100000 + l_suppkey) * 100 + CAST(l_quantity AS BIGINT) AS m, unnest([1, 2, 3]) AS p, l_quantity AS x FROM lineitem)
    SELECT g AS l_orderkey, row_number() OVER w AS node, CAST(x + p AS DOUBLE) AS x, p = 1 AS filler, row_number() OVER w = count(*) OVER (PARTITION BY g) AS last FROM n WINDOW w AS (PARTITION BY g ORDER BY m, p)""")
def waypoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each line of an order as a move with one filler point, one point and a destination."""
    li = table(spark, sf_dir, "lineitem")
    at = lambda k: F.struct((F.col("l_quantity") + k).alias("x"), F.col("l_partkey").cast("double").alias("y"), F.lit(0.0).alias("z"))
    moves = li.select(F.lit(0).alias("capture_id"), F.col("l_orderkey").alias("guid"), (((F.col("l_linenumber").cast("long") * 100_000_000 + F.col("l_partkey")) * 100_000 + F.col("l_suppkey")) * 100 + F.col("l_quantity").cast("long")).alias("number"), F.array(at(1)).alias("packed"), F.array(at(2)).alias("points"), at(3).alias("dest"), F.lit(None).cast("double").alias("look"), F.lit(1).alias("type"))
    return W.waypoints(moves).select(F.col("guid").alias("l_orderkey"), F.col("node").cast("long").alias("node"), "x", "filler", "last")


# --- spatial ---


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", F.col("label").alias("map"), F.get("embedding", F.lit(0)).cast("double").alias("x"), F.get("embedding", F.lit(1)).cast("double").alias("y"))


@query("""
    WITH v AS (SELECT vec_id, label, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y FROM embeddings)
    SELECT a.vec_id, EXISTS (SELECT 1 FROM v b WHERE b.vec_id % 3 = 0 AND a.label = b.label AND abs(a.x - b.x) < 0.02 AND abs(a.y - b.y) < 0.02 ) AS already_exists FROM v a WHERE a.vec_id % 3 <> 0""")
def mark_existing_spawns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors (two components, by label) with whether one of a reference third lies within 0.02."""
    v = vectors(spark, sf_dir).withColumns({"entry": F.lit(1), "z": F.lit(0.0)})
    return J.mark_existing_spawns(v.where("vec_id % 3 <> 0"), v.where("vec_id % 3 = 0"), ["vec_id"]).select("vec_id", "already_exists")


@query("SELECT ps.l_partkey, ps.l_suppkey, ps.n AS orders, round(ps.n / sum(ps.n) OVER (PARTITION BY ps.l_partkey), 6) AS share FROM (SELECT l_partkey, l_suppkey, count(DISTINCT l_orderkey) AS n FROM lineitem GROUP BY 1, 2) ps")
def spawn_point_odds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers (entries) of each part (place) by distinct orders (guids)."""
    li = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("map"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"), F.col("l_suppkey").alias("entry"), F.col("l_orderkey").alias("guid"))
    o = A.spawn_point_odds(li)
    return o.select(F.col("map").alias("l_partkey"), F.col("entry").alias("l_suppkey"), F.col("guids").alias("orders"), F.round("share", 6).alias("share"))


# --- loot and rollups ---


@query("""
    WITH i AS (SELECT o_orderkey, o_orderpriority FROM orders), t AS (SELECT o_orderpriority, count(*) AS n FROM i GROUP BY 1)
    SELECT o_orderpriority, l_linenumber, count(*) AS dropped, max(t.n) AS instances, round(count(*) / max(t.n), 6) AS chance
    FROM i JOIN (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) l ON i.o_orderkey = l.l_orderkey JOIN t USING (o_orderpriority) GROUP BY 1, 2""")
def drop_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as loot instances (empty ones count), their line numbers as items."""
    o = table(spark, sf_dir, "orders").select(F.lit(0).alias("capture_id"), F.col("o_orderkey").alias("loot_index"), F.col("o_orderpriority").alias("owner_entry"))
    i = table(spark, sf_dir, "lineitem").select(F.lit(0).alias("capture_id"), F.col("l_orderkey").alias("loot_index"), F.col("l_linenumber").alias("item_id"))
    return A.drop_rates(o, i).select(F.col("owner_entry").alias("o_orderpriority"), F.col("item_id").alias("l_linenumber"), "dropped", "instances", F.round("chance", 6).alias("chance"))


@query("""
    WITH i AS (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem)
    SELECT a.l_suppkey AS item_a, b.l_suppkey AS item_b, count(*) AS instances FROM i a JOIN i b ON a.l_orderkey = b.l_orderkey AND a.l_suppkey < b.l_suppkey GROUP BY 1, 2""")
def loot_cooccurrence(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = table(spark, sf_dir, "lineitem").select(F.lit(0).alias("capture_id"), F.col("l_orderkey").alias("loot_index"), F.col("l_suppkey").alias("item_id"))
    return A.loot_cooccurrence(i)


@query("""
    WITH c AS (SELECT c_nationkey, count(*) AS customers FROM customer GROUP BY 1), s AS (SELECT s_nationkey, count(*) AS suppliers FROM supplier GROUP BY 1),
    o AS (SELECT c_nationkey, count(*) AS orders FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1)
    SELECT n_nationkey AS nationkey, coalesce(customers, 0) AS customers, coalesce(suppliers, 0) AS suppliers, coalesce(orders, 0) AS orders FROM nation LEFT JOIN c ON n_nationkey = c_nationkey LEFT JOIN s ON n_nationkey = s_nationkey LEFT JOIN o ON n_nationkey = o.c_nationkey WHERE coalesce(customers, suppliers, orders) IS NOT NULL""")
def capture_map_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nationkey"), "c_custkey")
    s = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nationkey"))
    o = table(spark, sf_dir, "orders").join(c, F.col("o_custkey") == F.col("c_custkey")).select("nationkey")
    return A.capture_map_rollup({"customers": c.select("nationkey"), "suppliers": s, "orders": o}, ["nationkey"])


@query("""
    WITH c AS (SELECT c_custkey FROM customer), k AS (SELECT unnest(['1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW']) AS capability),
    n AS (SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2)
    SELECT c_custkey, capability, CASE WHEN n > 0 THEN 'ok' WHEN c_custkey % 2 = 0 THEN 'empty' ELSE 'unsupported' END AS status, coalesce(n, 0) AS rows_written
    FROM c CROSS JOIN k LEFT JOIN n ON o_custkey = c_custkey AND o_orderpriority = capability""")
def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as captures, order priorities as capabilities; even customers have a handler for all of them."""
    kinds = spark.createDataFrame([(k, 1) for k in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")], "capability string, collector_version int")
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("capture_id"))
    n = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("capture_id"), F.col("o_orderpriority").alias("capability")).agg(F.count("*").alias("rows"))
    handled = c.where("capture_id % 2 = 0").crossJoin(F.broadcast(kinds.select("capability")))
    return A.coverage(c, kinds, n, handled).select(F.col("capture_id").alias("c_custkey"), "capability", "status", "rows_written")


# --- lookups ---


@query("""
    SELECT c_custkey, CASE WHEN c_nationkey = 0 THEN '0' WHEN n_name IS NOT NULL AND n_nationkey % 2 = 1 THEN CAST(c_nationkey AS VARCHAR) || ' (' || n_name || ')' ELSE CAST(c_nationkey AS VARCHAR) END AS name
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""")
def lookup_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").where("n_nationkey % 2 = 1")
    names = nation.select(F.lit("Unit").alias("object_type"), F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    dims = names.where("id < 0").select("id", "name")
    return J.lookup_name(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), names, dims, "Unit", "c_nationkey").select("c_custkey", "name")


@query("SELECT s_suppkey, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_nationkey % 2 = 0")
def keep_resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("n_nationkey")).withColumn("n_name", F.lit(None).cast("string"))
    return J.keep_resolved(s, table(spark, sf_dir, "nation").where("n_nationkey % 2 = 0"), "n_nationkey", "n_name").select("s_suppkey", "n_name")


@query("""
    WITH t AS (SELECT text, count(DISTINCT doc_id) AS n, min(doc_id) AS least FROM documents GROUP BY 1)
    SELECT d.doc_id, CASE WHEN n = 1 THEN least END AS text_id FROM documents d JOIN t USING (text) WHERE d.text <> ''""")
def match_text_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The id of each text, where only one document has it."""
    d = table(spark, sf_dir, "documents")
    texts = d.select(F.col("doc_id").alias("id"), "text")
    own = d.where("text <> ''").select("doc_id", F.col("text").alias("a"), F.lit("").alias("b"))
    return J.match_text_unique(own, texts, "a", "b").select("doc_id", "text_id")


@query("""
    WITH RECURSIVE e AS (SELECT n_nationkey AS child, CASE WHEN n_nationkey % 5 = 0 THEN NULL ELSE n_nationkey - 1 END AS parent FROM nation),
    w(start, node, depth) AS (SELECT child, child, 0 FROM e UNION ALL SELECT w.start, e.parent, depth + 1 FROM w JOIN e ON w.node = e.child WHERE e.parent IS NOT NULL)
    SELECT c_custkey, (SELECT arg_max(node, depth) FROM w WHERE start = c_nationkey) AS root FROM customer""")
def resolve_root(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("n_nationkey")
    maps = table(spark, sf_dir, "nation").select(k.alias("id"), F.when(k % 5 == 0, -1).when(k % 2 == 0, k - 1).otherwise(-1).alias("parent"), F.when(k % 5 == 0, -1).otherwise(k - 1).alias("cosmetic_parent"))
    c = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("map"))
    return J.resolve_root(c, maps).select("c_custkey", "root")


@query("SELECT l_partkey AS map, bit_or(1 << l_linenumber) AS spawn_mask FROM lineitem GROUP BY 1")
def spawn_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.spawn_mask(table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("map"), F.col("l_linenumber").alias("difficulty")))


@query("""
    WITH v AS (SELECT l_returnflag AS enum, l_suppkey & ~CASE l_returnflag WHEN 'A' THEN 7 WHEN 'N' THEN 12 ELSE 1 END AS rest FROM lineitem),
    b AS (SELECT DISTINCT enum, bit FROM v, range(64) t(bit) WHERE (rest >> bit) & 1 = 1)
    SELECT enum, string_agg(CAST(bit AS VARCHAR), ',' ORDER BY bit) AS bits FROM b GROUP BY 1""")
def undefined_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("enum"), F.col("l_suppkey").alias("value"))
    masks = spark.createDataFrame([("A", 7), ("N", 12), ("R", 1)], "enum string, mask long")
    return A.undefined_flags(v, masks).select("enum", F.array_join(F.transform("bits", lambda b: b.cast("string")), ",").alias("bits"))


@query("SELECT l_returnflag AS value, CAST(b AS INTEGER) AS batch, string_agg(CAST(k AS VARCHAR), ',' ORDER BY k) AS others FROM (SELECT l_returnflag, k, (row_number() OVER (PARTITION BY l_returnflag ORDER BY k) - 1) // 5000 AS b FROM (SELECT DISTINCT l_returnflag, l_suppkey AS k FROM lineitem)) GROUP BY 1, 2")
def compact_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys (supplier, flag), grouped under the flag as it has fewer values."""
    out = A.compact_keys(table(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag"), "l_suppkey", "l_returnflag")
    return out.select("value", "batch", F.array_join(F.transform("others", lambda x: x.cast("string")), ",").alias("others"))


@query("""
    WITH k AS (SELECT *, hash FROM (SELECT *, length(text) % 5 AS hash FROM conversations)), r AS (SELECT * FROM k WHERE hash <> 0),
    e AS (SELECT conv_id, max(turn) + 1 AS stop FROM conversations GROUP BY 1)
    SELECT conv_id, turn, coalesce(lead(turn) OVER (PARTITION BY conv_id ORDER BY turn), stop) - turn AS duration FROM r JOIN e USING (conv_id)""")
def line_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as lines that last until the next; texts whose length is divisible by 5 have a known duration."""
    c = table(spark, sf_dir, "conversations")
    ends = c.groupBy("conv_id").agg((F.max("turn") + 1).alias("stop"))
    known = c.where(F.length("text") % 5 == 0).select("text")
    return W.line_durations(c.join(ends, "conv_id"), known, ["conv_id"], "turn", "turn", "text", "stop").select("conv_id", "turn", "duration")


@query("SELECT event_id, '@CGUID+' || (row_number() OVER (ORDER BY ts, event_id) - 1) AS spawn_id FROM events")
def number_spawns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events numbered in time order, by ranges and sums of ranges."""
    e = events(spark, sf_dir).withColumn("guid", F.col("capture_id"))
    return W.number_spawns(e, "CGUID", scratch_path(spark, "numbers")).select(F.col("number").alias("event_id"), "spawn_id")


@query("SELECT l_orderkey, l_linenumber, CAST((row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber) - 1) // 250 AS INTEGER) AS batch FROM lineitem")
def batch_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.batch_rows(table(spark, sf_dir, "lineitem"), 250, ["l_suppkey"], ["l_orderkey", "l_linenumber"]).select("l_orderkey", "l_linenumber", "batch")


@query("SELECT l_orderkey, l_suppkey, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY min(l_linenumber), l_suppkey) - 1 AS INTEGER) AS order_index FROM lineitem GROUP BY 1, 2")
def order_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.order_index(table(spark, sf_dir, "lineitem"), ["l_orderkey"], ["l_suppkey"], ["l_linenumber"])


# --- scalar functions ---


@query("""
    SELECT o_orderkey, make_timestamp(epoch_us(DATE '2000-01-01' + to_months(CAST((v >> 24 & 31) * 12 + (v >> 20 & 15) AS INTEGER)) + to_days(CAST(v >> 14 & 63 AS INTEGER)) + to_hours(v >> 6 & 31) + to_minutes(v & 63))) AS packed_time,
        '0x' || upper(to_hex(v)) AS hex_text, v & 16777215 AS action_id, v >> 24 & 255 AS action_type
    FROM (SELECT o_orderkey, o_orderkey * 7919 % 500000000 AS v FROM orders)""")
def integer_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.col("o_orderkey") * 7919 % 500_000_000
    action = X.unpack_action(v)
    return table(spark, sf_dir, "orders").select("o_orderkey", X.from_packed_time(v).cast("timestamp_ntz").alias("packed_time"), X.hexify(v).alias("hex_text"), action["id"].alias("action_id"), action["type"].alias("action_type"))


@query("""
    SELECT o_orderkey, hi >> 58 & 63 AS high_type, hi >> 42 & 8191 AS realm, hi >> 29 & 8191 AS map, hi >> 6 & 8388607 AS entry, hi & 63 AS sub_type, lo >> 40 & 16777215 AS server, lo & 1099511627775 AS low
    FROM (SELECT o_orderkey, o_orderkey * 1000000007 % 4611686018427387904 AS hi, o_custkey * 1000003 % 4611686018427387904 AS lo FROM orders)""")
def guid_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = X.guid_parts(F.col("o_orderkey") * 1_000_000_007 % (1 << 62), F.col("o_custkey") * 1_000_003 % (1 << 62))
    return table(spark, sf_dir, "orders").select("o_orderkey", g.alias("g")).select("o_orderkey", "g.*")


@query("""
    SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity > pi() THEN round(l_quantity - 2 * pi(), 6) ELSE round(l_quantity, 6) END AS orientation,
        CASE WHEN l_suppkey & 64 <> 0 THEN 5 WHEN l_suppkey & 32 <> 0 THEN 4 WHEN l_suppkey & 16 <> 0 THEN 3 ELSE 0 END AS visibility, (l_partkey & 5) <> 0 AS any_flag FROM lineitem""")
def rule_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", F.round(X.normalize_orientation(F.col("l_quantity")), 6).alias("orientation"), X.visibility_class(F.col("l_suppkey"), {64: 5, 32: 4, 16: 3}).alias("visibility"), X.has_any_flag(F.col("l_partkey"), 5).alias("any_flag"))


# --- lifecycle ---


@query("""
    WITH e AS (SELECT user_id, event_id, event_type, value FROM events),
    s AS (SELECT user_id, max(event_id) FILTER (event_type = 'signup') AS start, arg_max(event_type, event_id) AS last, max(event_id) AS n FROM e GROUP BY 1)
    SELECT user_id, n AS last_number, last <> 'error' AS alive, arg_max(value, event_id) FILTER (event_type <> 'view') AS value FROM e JOIN s USING (user_id) WHERE start IS NULL OR event_id >= start GROUP BY 1, 2, 3""")
def entity_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users as entities: signup creates, error destroys, views carry no value."""
    from ..streaming.captures import entity_lifecycle as fold

    e = events(spark, sf_dir)
    kinds = F.when(F.col("kind") == "signup", "create").when(F.col("kind") == "error", "destroy").otherwise("update")
    rows = e.select("capture_id", F.col("capture_id").alias("guid"), "number", kinds.alias("kind"), F.when(F.col("kind") != "view", F.col("value")).alias("value"))
    return fold(rows, ["value"]).select(F.col("capture_id").alias("user_id"), "last_number", "alive", "value")


# --- more lookups ---


@query("SELECT doc_id, least AS text_id, CASE WHEN n > 1 THEN ids END AS candidates FROM documents JOIN (SELECT text, min(doc_id) AS least, count(*) AS n, string_agg(CAST(doc_id AS VARCHAR), ' - ' ORDER BY doc_id) AS ids FROM documents GROUP BY 1) USING (text)")
def match_text_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    texts = d.select("text", F.col("doc_id").alias("pos"), F.col("doc_id").alias("id"))
    return J.match_text_first(d.select("doc_id", "text"), texts, "text").select("doc_id", "text_id", "candidates")


@query("""
    WITH t AS (SELECT o_orderpriority AS text, o_orderkey AS id FROM orders WHERE o_orderkey % 5 <> 0), m AS (SELECT o_orderstatus AS menu, o_orderkey AS id FROM orders WHERE o_orderstatus <> 'P' AND o_orderkey % 3 = 0),
    f AS (SELECT text, min(id) AS first FROM t GROUP BY 1), b AS (SELECT menu, text, min(id) AS least FROM t JOIN m USING (id) GROUP BY 1, 2)
    SELECT o_orderkey, CASE WHEN f.first IS NULL THEN 0 WHEN o_orderstatus = 'P' THEN f.first ELSE coalesce(b.least, 0) END AS npc_text_id
    FROM orders LEFT JOIN f ON f.text = o_orderpriority LEFT JOIN b ON b.menu = o_orderstatus AND b.text = o_orderpriority""")
def lookup_text_by_menu(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Priorities as texts, statuses as menus (P without a list), orders as text ids."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    by_text = o.where(k % 5 != 0).select(F.col("o_orderpriority").alias("text"), k.alias("pos"), k.alias("id"))
    by_menu = o.where((F.col("o_orderstatus") != "P") & (k % 3 == 0)).select(F.col("o_orderstatus").alias("menu"), k.alias("id"))
    rows = o.select(k, F.col("o_orderstatus").alias("menu"), F.col("o_orderpriority").alias("text"))
    return J.lookup_text_by_menu(rows, by_text, by_menu).select("o_orderkey", "npc_text_id")


@query("""
    WITH RECURSIVE r AS (SELECT p_partkey AS entry, p_partkey % 5 AS difficulty, p_size AS value FROM part),
    w AS (SELECT l_orderkey, l_linenumber, l_partkey AS entry, l_linenumber % 5 AS d, l_linenumber % 5 AS start, 0 AS depth FROM lineitem
        UNION ALL SELECT l_orderkey, l_linenumber, entry, d - 1, start, depth + 1 FROM w WHERE d > 0),
    f AS (SELECT w.entry, w.start, arg_min(r.value, depth) AS value, arg_min(w.d, depth) AS d FROM w JOIN r ON r.entry = w.entry AND r.difficulty = w.d GROUP BY 1, 2)
    SELECT l_orderkey, l_linenumber, f.value, f.d AS from_difficulty FROM lineitem LEFT JOIN f ON f.entry = l_partkey AND f.start = l_linenumber % 5""")
def fallback_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part sizes by (part, difficulty), falling back from difficulty 4 to 0 step by step."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("entry"), (F.col("l_linenumber") % 5).alias("difficulty"))
    ref = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("entry"), (F.col("p_partkey") % 5).cast("int").alias("difficulty"), F.col("p_size").alias("value"))
    steps = spark.createDataFrame([(4, 3), (3, 2), (2, 1), (1, 0), (0, None)], "difficulty int, next int")
    return J.fallback_lookup(li, ref, steps).select("l_orderkey", "l_linenumber", "value", "from_difficulty")


@query("SELECT o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_nationkey % 4 <> 3 AND ((c_nationkey % 4 = 0 AND o_orderstatus IN ('O', 'F')) OR (c_nationkey % 4 = 1 AND o_orderstatus = 'P') OR c_nationkey % 4 = 2)")
def terrain_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order status as branch, nation as map."""
    n = F.col("n_nationkey")
    validity = table(spark, sf_dir, "nation").where(n % 4 != 3).select(F.lit("t").alias("target"), n.alias("map"), F.when(n % 4 == 0, "O,F").when(n % 4 == 1, "P").otherwise("O,F,P").alias("usable_branches"))
    o = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", F.col("c_nationkey").alias("map"), F.col("o_orderstatus").alias("branch"))
    return J.terrain_valid(o, validity, "t").select("o_orderkey")


@query("""
    WITH e AS (SELECT l_orderkey, l_linenumber, l_linenumber AS opcode, l_suppkey AS build, CASE WHEN l_suppkey < 50 THEN 1 ELSE 2 END AS g FROM lineitem)
    SELECT l_orderkey, l_linenumber, CASE WHEN g = 2 AND opcode IN (1, 2) AND build >= 60 AND build < 80 THEN 'new' WHEN opcode IN (1, 2, 3) AND build >= 20 THEN 'old' WHEN opcode = 7 THEN 'any' END AS handler FROM e""")
def resolve_handler(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line numbers as opcodes, suppliers as builds: group 2 falls back to group 1."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_linenumber").alias("opcode"), F.col("l_suppkey").alias("build"), F.when(F.col("l_suppkey") < 50, 1).otherwise(2).alias("build_group"))
    reg = [(1, 2, 60, 80, "new"), (2, 2, 60, 80, "new"), (1, 1, 20, None, "old"), (2, 1, 20, None, "old"), (3, 1, 20, None, "old"), (7, None, None, None, "any")]
    registry = spark.createDataFrame(reg, "opcode int, `group` int, added long, removed long, handler string")
    return J.resolve_handler(li, registry, spark.createDataFrame([(2, 1, 1)], "build_group int, `group` int, rank int")).select("l_orderkey", "l_linenumber", "handler")


@query("""
    WITH m AS (SELECT DISTINCT l_suppkey AS phase, l_suppkey % 10 AS group_id FROM lineitem)
    SELECT l_orderkey, string_agg(CAST(g AS VARCHAR), ',' ORDER BY g) AS groups FROM (SELECT DISTINCT l_orderkey, l_suppkey % 10 AS g FROM lineitem) GROUP BY 1""")
def phase_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as phases, their last digit as group, orders as entities."""
    li = table(spark, sf_dir, "lineitem")
    e = li.groupBy("l_orderkey").agg(F.collect_set("l_suppkey").alias("phases"))
    members = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("phase"), (F.col("s_suppkey") % 10).alias("group_id"))
    out = A.phase_groups(e, members, ["l_orderkey"])
    return out.select("l_orderkey", F.array_join(F.transform("groups", lambda g: g.cast("string")), ",").alias("groups"))


@query("SELECT c_custkey, CAST(CASE WHEN c_nationkey % 2 = 1 AND c_nationkey % 8 >= 4 THEN CASE c_nationkey % 8 WHEN 7 THEN 0.8 WHEN 5 THEN 0.9 END WHEN c_nationkey % 2 = 0 AND c_nationkey % 8 >= 4 THEN CASE c_nationkey % 8 WHEN 6 THEN 0.85 ELSE 0.95 END ELSE 1.0 END AS DOUBLE) AS factor FROM customer")
def discount_by_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    v = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("faction_template"))
    out = J.discount_by_reputation(v, n.select(k.alias("faction_template"), (k + 100).alias("faction")), n.select((k + 100).alias("faction"), (k + 200).alias("reputation_index")), n.select((k + 200).alias("reputation_index"), (k % 8).alias("rank")))
    return out.select("c_custkey", "factor")


@query("SELECT user_id AS capture_id, CASE event_type WHEN 'click' THEN 'success' WHEN 'purchase' THEN 'with_errors' WHEN 'error' THEN 'not_parsed' ELSE 'no_structure' END AS outcome, count(*) AS n FROM events WHERE event_type <> 'view' GROUP BY 1, 2")
def stream_parse_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events read as a file stream to its end, in complete mode; the result of the last trigger."""
    from ..streaming.captures import stream_parse_stats as stats

    path = f"{sf_dir}/events.parquet"
    schema = spark.read.parquet(path).schema
    source = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(f"{sf_dir}/events.parquet*")
    rows = source.select(F.col("user_id").alias("capture_id"), F.col("event_type").alias("kind"))
    totals = stats(rows.withColumn("status", outcome()).withColumn("write_to_file", F.lit(True)))
    out = scratch_path(spark, "stats")
    store = lambda df, _=None: df.write.mode("overwrite").parquet(out)
    store(spark.createDataFrame([], totals.schema))  # what is read where no trigger had rows
    stream = totals.writeStream.outputMode("complete").foreachBatch(store).option("checkpointLocation", scratch_path(spark, "stats-state")).trigger(availableNow=True).start()
    stream.awaitTermination()
    return spark.read.schema(totals.schema).parquet(out)
