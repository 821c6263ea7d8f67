"""Queries of the column expressions, over whole tables, with DuckDB SQL that computes the same in its own way."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalars as X
from .queries import query, table


@query("SELECT l_orderkey, l_linenumber, l_partkey, abs(l_discount - l_tax) < 0.0301 AS near FROM lineitem")
def within(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_partkey", X.within(F.col("l_discount"), F.col("l_tax"), 0.0301).alias("near"))


@query(f"""
    SELECT vec_id, round((e[1] - e[4]) * cos(o) + (e[2] - e[5]) * sin(o), 6) AS x, round((e[2] - e[5]) * cos(o) - (e[1] - e[4]) * sin(o), 6) AS y, round(e[3] - e[6], 6) AS z
    FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e, label % 7 * {math.pi!r} / 3 AS o FROM embeddings)""")
def to_local_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as two positions, labels as orientations."""
    e = table(spark, sf_dir, "embeddings").withColumn("e", F.col("embedding").cast("array<double>")).withColumn("o", F.col("label") % 7 * math.pi / 3)
    p = X.to_local_offset(*(F.get("e", F.lit(k)) for k in range(6)), F.col("o"))
    return e.select("vec_id", p.alias("p")).select("vec_id", *(F.round(f"p.{c}", 6).alias(c) for c in "xyz"))


@query(r"""
    SELECT event_id, '''' || replace(replace(replace(props, '\', '\\'), '"', '\"'), '''', '\''') || '''' AS text, CASE WHEN event_type = 'view' THEN 'NULL' ELSE CAST(user_id AS VARCHAR) END AS number,
        '0x' || upper(printf('%x', user_id)) AS flags, CASE WHEN value > 50 THEN '1' ELSE '0' END AS yes, '0x' || upper(hex(encode(event_type))) AS blob, coalesce('''' || CASE WHEN event_type <> 'click' THEN event_type END || '''', '''''') AS quoted,
        CASE WHEN event_type = 'error' THEN 'UNKNOWN' ELSE CAST(event_id AS VARCHAR) END AS needed FROM events""")
def sql_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of events as literals of a statement: text, numbers, flags, booleans, blobs, nulls."""
    e, kind = table(spark, sf_dir, "events"), F.col("event_type")
    unless = lambda k, c: F.when(kind != k, c)
    return e.select(
        "event_id", X.sql_literal(F.col("props"), T.StringType()).alias("text"), X.sql_literal(unless("view", F.col("user_id")), T.LongType()).alias("number"), X.sql_literal(F.col("user_id"), T.LongType(), flags=True).alias("flags"),
        X.sql_literal(F.col("value") > 50, T.BooleanType()).alias("yes"), X.sql_literal(F.encode("event_type", "UTF-8"), T.BinaryType()).alias("blob"), X.stringify(unless("click", kind)).alias("quoted"),
        X.sql_literal(unless("error", F.col("event_id")), T.LongType(), nullable=False).alias("needed"),
    )


@query("SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_quantity = floor(l_quantity) THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) ELSE rtrim(CAST(l_quantity AS VARCHAR), '0') END AS quantity FROM lineitem")
def decimal_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantities (whole numbers as doubles) without trailing zeros."""
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", X.sql_literal(F.col("l_quantity"), T.DoubleType()).alias("quantity"))


@query(r"SELECT p_partkey, lower(substr(n, 1, 1) || regexp_replace(substr(n, 2), '([A-Z])', '_\1', 'g')) AS snake, '`' || p_brand || '`' AS quoted, p_brand AS bare FROM (SELECT p_partkey, p_brand, replace(p_type || p_brand, ' ', '') AS n FROM part)")
def snake_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    quoted = X.add_back_quotes(F.col("p_brand"))
    return p.select("p_partkey", X.snake_case(F.replace(F.concat("p_type", "p_brand"), F.lit(" "), F.lit(""))).alias("snake"), quoted.alias("quoted"), X.remove_back_quotes(quoted).alias("bare"))


@query("SELECT o_orderkey, greatest(-62135596800, least(253402300799, (o_orderkey - 1000) * 40000000)) AS sec FROM orders")
def unix_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seconds to times and back, kept to the years 1 to 9999."""
    return table(spark, sf_dir, "orders").select("o_orderkey", X.to_unix(X.from_unix((F.col("o_orderkey") - 1000) * 40_000_000)).alias("sec"))


KINDS = ("Creature", "GameObject", "Player", "Vehicle", "Item", "Transport", "Cast", "DynamicObject", "Pet", "AreaTrigger", "Null")


def kinds() -> F.Column:
    return F.get(F.array(*map(F.lit, KINDS)), (F.col("l_partkey") % len(KINDS)).cast("int"))


KIND_SQL = "[" + ", ".join(f"'{k}'" for k in KINDS) + f"][l_partkey % {len(KINDS)} + 1]"


@query(f"""
    WITH k AS (SELECT l_orderkey, l_linenumber, l_partkey, {KIND_SQL} AS kind FROM lineitem)
    SELECT *, kind IN ('Creature', 'GameObject', 'Pet', 'Vehicle', 'AreaTrigger', 'Cast') AS has_entry,
        CASE WHEN kind IN ('Creature', 'Vehicle', 'Pet') THEN 'Unit' WHEN kind IN ('GameObject', 'Transport') THEN 'GameObject' WHEN kind IN ('Cast', 'Null') THEN 'Object' ELSE kind END AS object_type,
        CASE WHEN kind IN ('Creature', 'Vehicle', 'Pet') THEN 'Unit' WHEN kind IN ('GameObject', 'Transport') THEN 'GameObject' WHEN kind = 'Cast' THEN 'Spell' WHEN kind IN ('Player', 'Item') THEN kind ELSE 'None' END AS name_type FROM k""")
def guid_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as high types."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", kinds().alias("kind"))
    k = F.col("kind")
    return li.select("*", X.guid_has_entry(k).alias("has_entry"), X.guid_object_type(k).alias("object_type"), X.guid_name_type(k).alias("name_type"))


@query("""
    WITH g AS (SELECT l_orderkey, l_linenumber, l_partkey, (l_linenumber + 3) * 288230376151711744 + l_suppkey * 4398046511104 + l_quantity::BIGINT * 536870912 + l_partkey * 64 + l_linenumber AS hi, l_linenumber * 1099511627776 + l_orderkey AS lo, l_quantity::BIGINT AS map, l_suppkey, l_returnflag FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_partkey, 'Full: 0x' || upper(printf('%016x', hi)) || upper(printf('%016x', lo)) || CASE WHEN l_returnflag = 'A' THEN ' Creature/' ELSE ' Player/' END || (hi & 63) || ' R' || (hi >> 42 & 8191) || '/S' || (lo >> 40 & 16777215) || ' Map: m' || map
        || CASE WHEN l_returnflag = 'A' THEN ' Entry: e' || l_partkey || ' Low: ' || (lo & 1099511627775) WHEN l_returnflag = 'R' THEN ' Low: ' || (lo & 1099511627775) || ' Name: e' || l_partkey ELSE ' Low: ' || (lo & 1099511627775) END AS text, lo & 8388607 AS spawn_time FROM g""")
def guid_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as 128-bit ids: suppliers as realms, quantities as maps, parts as entries, orders as counters. A realm has 13 bits, so the text shows its supplier's lowest ones."""
    li = table(spark, sf_dir, "lineitem")
    n, map_ = F.col("l_linenumber").cast("long"), F.col("l_quantity").cast("long")
    hi = (n + 3) * (1 << 58) + F.col("l_suppkey") * (1 << 42) + map_ * (1 << 29) + F.col("l_partkey") * 64 + n
    lo = n * (1 << 40) + F.col("l_orderkey")
    name = F.when(F.col("l_returnflag") != "N", F.concat(F.lit("e"), "l_partkey"))
    text = X.guid_text(hi, lo, F.when(F.col("l_returnflag") == "A", "Creature").otherwise("Player"), F.concat(F.lit("m"), map_), name)
    return li.select("l_orderkey", "l_linenumber", "l_partkey", text.alias("text"), X.guid_spawn_time(lo).alias("spawn_time"))


@query("""
    SELECT event_id, printf('%02d:%02d:%02d.%03d', ms // 3600000 % 24, ms // 60000 % 60, ms // 1000 % 60, ms % 1000) AS span, abs((event_id & 8388607) - (event_id + user_id % 8 & 8388607)) <= 3 AS spawned
    FROM (SELECT event_id, user_id, event_id * 98765 AS ms FROM events)""")
def spans_and_spawns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event ids as spans of time, and as the time in an id that is held against one some seconds later."""
    e, id_ = table(spark, sf_dir, "events"), F.col("event_id")
    return e.select("event_id", X.format_span(id_ * 98765).alias("span"), X.spawned_at(id_, F.timestamp_seconds(id_ + F.col("user_id") % 8)).alias("spawned"))


@query("""
    SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN (o_custkey % 1024) || '.0B' WHEN o_orderkey % 3 = 1 THEN (o_custkey % 1000 + 1) || '.0KB' ELSE (o_custkey % 1000 + 1) || '.5MB' END AS size,
        '(' || o_orderstatus || ') [' || o_custkey % 5 || '] [' || o_orderkey % 7 || ']' AS path, replace(o_orderpriority, '-', chr(10)) AS lines FROM orders""")
def sizes_and_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, k, c = table(spark, sf_dir, "orders"), F.col("o_orderkey"), F.col("o_custkey")
    size = F.when(k % 3 == 0, c % 1024).when(k % 3 == 1, (c % 1000 + 1) * 1024).otherwise((c % 1000 + 1) * 1048576 + 524288)
    path = X.object_path(F.col("o_orderstatus"), F.array(c % 5, k % 7))
    return o.select("o_orderkey", X.human_bytes(size).alias("size"), path.alias("path"), X.normalize_newlines(F.replace("o_orderpriority", F.lit("-"), F.lit("\r\n"))).alias("lines"))


@query(r"""
    WITH b AS (SELECT event_id, props, upper(hex(encode(props))) AS h FROM events),
    l AS (SELECT event_id, k, substr(h, k * 32 + 1, 32) AS own, substr(props, k * 16 + 1, 16) AS t FROM b, range(4) r(k) WHERE k * 32 < length(h))
    SELECT event_id, string_agg('| ' || rpad(regexp_replace(own, '(..)', '\1 ', 'g'), 48, ' ') || '| ' || regexp_replace(t, '(.)', '\1 ', 'g') || '|', chr(10) ORDER BY k) AS dump FROM l GROUP BY 1""")
def hex_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The properties of events (ASCII) as payloads."""
    return table(spark, sf_dir, "events").select("event_id", X.hex_table(F.encode("props", "UTF-8")).alias("dump"))


@query("""
    SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN 'alpha' WHEN 1 THEN 'beta' ELSE CAST(s_suppkey % 4 AS VARCHAR) END AS recorder, s_suppkey >> 24 & 255 AS type, (s_suppkey * 7 & 16777215) AS instance,
        s_suppkey * 100 + s_nationkey % 8 AS spell_key, CASE s_nationkey % 5 WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 1 ELSE 0 END AS slot FROM supplier""")
def recorders_and_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, k = table(spark, sf_dir, "supplier"), F.col("s_suppkey")
    return s.select(
        "s_suppkey", X.sniffer_name(k % 4, {0: "alpha", 1: "beta"}).alias("recorder"), X.lfg_parts(k)["type"].alias("type"), X.lfg_parts(k * 7)["instance"].alias("instance"),
        X.spell_list_key(k, F.col("s_nationkey") % 8).alias("spell_key"), X.difficulty_slot(F.col("s_nationkey") % 5, {1: 1, 2: 2, 3: 1}).alias("slot"),
    )


@query("""
    WITH q AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity::BIGINT AS z, (l_partkey % 1000) / 2097152.0 AS x, (l_suppkey % 500) / 1048576.0 AS y FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_partkey, round(CASE WHEN l_suppkey % 2 = 0 THEN x ELSE 1.0 END, 9) AS x, round(CASE WHEN l_suppkey % 2 = 0 THEN y ELSE 2.0 END, 9) AS y,
        round(CASE WHEN l_suppkey % 2 = 0 THEN z / 1048576.0 ELSE 3.0 END, 9) AS z, round(CASE WHEN l_suppkey % 2 = 0 THEN sqrt(1 - x * x - y * y - z / 1048576.0 * z / 1048576.0) ELSE 4.0 END, 9) AS w FROM q""")
def static_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts, suppliers and quantities packed as a rotation, read for even suppliers; the others have it as it was sent."""
    li = table(spark, sf_dir, "lineitem")
    packed = (F.col("l_partkey") % 1000) * (1 << 42) + (F.col("l_suppkey") % 500) * (1 << 21) + F.col("l_quantity").cast("long")
    sent = F.struct(*(F.lit(float(k + 1)).alias(c) for k, c in enumerate("xyzw")))
    r = X.static_rotation(packed, sent, F.when(F.col("l_suppkey") % 2 == 0, 13164).otherwise(13163))
    return li.select("l_orderkey", "l_linenumber", "l_partkey", r.alias("r")).select("l_orderkey", "l_linenumber", "l_partkey", *(F.round(f"r.{c}", 9).alias(c) for c in "xyzw"))


@query("""
    SELECT o_custkey, array_to_string(list_sort(flatten(list([o_orderkey % 10, o_orderkey % 7]))), ',') AS flat, count(*) FILTER (o_orderstatus = 'O') = count(*) AS same FROM orders GROUP BY 1""")
def flatten_and_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lists of a customer's orders as one list; whether the map of orders to states is that of orders to O."""
    k = F.col("o_orderkey")
    o = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.collect_list(F.array(k % 10, k % 7)).alias("lists"), F.map_from_entries(F.collect_list(F.struct(k, "o_orderstatus"))).alias("states"), F.map_from_entries(F.sort_array(F.collect_list(F.struct(k, F.lit("O"))), asc=False)).alias("open"))
    return o.select("o_custkey", F.array_join(F.transform(F.sort_array(X.flatten_lists(F.col("lists"))), lambda x: x.cast("string")), ",").alias("flat"), X.map_equal(F.col("states"), F.col("open")).alias("same"))


@query("""
    SELECT c_custkey, CASE c_nationkey % 3 WHEN 1 THEN 3 WHEN 2 THEN 5 END AS option_type, CASE c_nationkey % 3 WHEN 1 THEN CASE WHEN c_custkey & 4 <> 0 THEN 4 WHEN c_custkey & 2 <> 0 THEN 2 ELSE 9 END WHEN 2 THEN CASE WHEN c_custkey & 8 <> 0 THEN 8 END END AS npc_flag FROM customer""")
def option_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as icons, customer keys as flags."""
    rules = [(1, 3, [(4, 4), (2, 2)], 9), (2, 5, [(8, 8)], None)]
    c = table(spark, sf_dir, "customer")
    return c.select("c_custkey", X.option_type(F.col("c_nationkey") % 3, F.col("c_custkey"), rules).alias("o")).select("c_custkey", "o.option_type", "o.npc_flag")


@query("SELECT l_orderkey, coalesce(string_agg(CAST(l_partkey AS VARCHAR), ' ' ORDER BY l_linenumber, l_partkey, l_suppkey) FILTER (l_suppkey % 2 = 1 AND (l_returnflag = 'N' OR l_quantity <= 10)), '') AS auras FROM lineitem GROUP BY 1")
def template_auras(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of an order as auras: odd suppliers have no caster, flag N no duration, others what exceeds ten."""
    aura = F.struct("l_linenumber", F.col("l_partkey").alias("spell_id"), F.col("l_suppkey").alias("flags"), F.when(F.col("l_returnflag") != "N", F.col("l_quantity") - 10).alias("duration"))
    o = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(aura)).alias("a"))
    return o.select("l_orderkey", X.template_auras(F.col("a"), 1).alias("auras"))


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, CASE l_linenumber WHEN 1 THEN '1,2,0,0,0,0,0,0' WHEN 2 THEN '3,4,5,6,7,8,0,0' WHEN 3 THEN CAST(l_suppkey AS VARCHAR) || ',9,0,0,0,0,0,0' END AS slots FROM lineitem""")
def shape_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line numbers as kinds of shapes, the supplier as one of the values."""
    n = F.col("l_linenumber")
    kind = F.when(n == 1, "sphere").when(n == 2, "box").when(n == 3, "polygon").otherwise("none")
    names = ("radius", "radius_target", "x", "y", "z", "x_target", "y_target", "z_target")
    values = F.create_map(*(v for k, name in enumerate(names) for v in (F.lit(name), F.lit(k + 1.0))), F.lit("height"), F.col("l_suppkey").cast("double"), F.lit("height_target"), F.lit(9.0))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.array_join(F.transform(X.shape_data(kind, values), lambda v: v.cast("long").cast("string")), ",").alias("slots"))
