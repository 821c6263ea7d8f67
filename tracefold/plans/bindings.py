"""More registered queries: the smaller operators over whole tables, with DuckDB SQL for the same rows.

lineitem plays entities and spawns (order: capture, part: entry, supplier: map or
guid), orders and customer play captures, owners and reference rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalars as X
from ..functions import specs
from ..functions.specs import Column, TableSpec
from ..operators import aggregates as A
from ..operators import changes as C
from ..operators import dedupe as D
from ..operators import filters as L
from ..operators import joins as J
from ..operators import windows as W
from ..operators.hot import DEALT, spread
from ..sources import tables as K
from .queries import events, query, sessions, table

HALF_DAY_MS = 12 * 3600 * 1000


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem with a number that tells the rows of an order apart."""
    li = table(spark, sf_dir, "lineitem")
    number = (F.col("l_linenumber").cast("long") * 100_000_000 + F.col("l_partkey")) * 100_000 + F.col("l_suppkey")
    return li.withColumn("number", number)


NUMBER = "((CAST(l_linenumber AS BIGINT) * 100000000 + l_partkey) * 100000 + l_suppkey)"


# --- filters and projections ---


@query("""
    WITH g AS (SELECT l_orderkey, bool_and(CASE WHEN l_returnflag = 'A' THEN l_suppkey NOT IN (3, 4, 5) WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN true ELSE l_suppkey % 2 = 0 END) AS ok
        FROM (SELECT *, l_suppkey AS s FROM lineitem) GROUP BY 1)
    SELECT l_orderkey FROM g WHERE ok""")
def filter_event_by_guids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders all of whose lines pass: flags as types; of type A the supplier is the entry, of the others whether it is odd."""
    li = table(spark, sf_dir, "lineitem")
    guid = F.struct(F.col("l_returnflag").alias("entity_type"), F.when(F.col("l_returnflag") == "A", F.col("l_suppkey")).otherwise(F.col("l_suppkey") % 2).alias("entry"), ((F.col("l_returnflag") != "R") | (F.col("l_linestatus") != "O")).alias("has_entry"))
    orders = li.groupBy("l_orderkey").agg(F.collect_list(guid).alias("guids"))
    return L.filter_event_by_guids(orders, {"N": [0], "R": [0]}, {"A": [3, 4, 5]}).select("l_orderkey")


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE NOT (l_suppkey % 7 = 0 OR l_partkey % 5 = 0 OR l_linenumber = 6) AND l_linenumber % 2 = 1 AND l_suppkey % 10 <> 0 AND l_quantity > 5")
def drop_temporary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that stand for lasting, living spawns with an entry."""
    li = table(spark, sf_dir, "lineitem").withColumns({
        "owner_guid": F.when(F.col("l_suppkey") % 7 == 0, "o"), "created_by": F.lit(None).cast("string"), "created_by_spell": F.when(F.col("l_partkey") % 5 == 0, 9),
        "forced_temporary": F.col("l_linenumber") == 6, "create_type": F.col("l_linenumber") % 2 + 1, "entry": F.col("l_suppkey") % 10, "health": F.col("l_quantity") - 5,
    })
    return L.drop_dead(L.drop_zero_entry(L.spawned_in_view_only(L.drop_temporary(li)))).select("l_orderkey", "l_linenumber", "l_partkey")


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE NOT (l_partkey >= 1312 AND l_suppkey <> 0 AND l_suppkey * 200 <= 12340)")
def drop_undecrypted(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").withColumns({"opcode": F.col("l_partkey"), "client_build": F.col("l_suppkey") * 200})
    return L.drop_undecrypted(li).select("l_orderkey", "l_linenumber", "l_partkey")


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE (l_suppkey % 4 <> 0 OR l_returnflag = 'A') AND l_returnflag <> 'N' AND NOT (l_returnflag = 'A' AND l_suppkey % 4 >= 2)")
def sample_data_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("l_returnflag") == "A", "Map").when(F.col("l_returnflag") == "N", "None").otherwise("Unit")
    li = table(spark, sf_dir, "lineitem").withColumns({"object_type": kind, "id": F.col("l_suppkey") % 4})
    return L.plausible_map_ids(L.sample_data_filter(li), below=2).select("l_orderkey", "l_linenumber", "l_partkey")


@query("SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')")
def max_content_expansion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Priorities as content versions in their order, up to the third."""
    o = table(spark, sf_dir, "orders").withColumn("content_version", F.col("o_orderpriority"))
    versions = o.select("content_version").distinct().withColumn("rank", F.substring("content_version", 1, 1).cast("int"))
    return L.max_content_expansion(o, versions, "3-MEDIUM").select("o_orderkey")


@query("SELECT vec_id, embedding[1] AS e1, embedding[2] AS e2, embedding[3] AS e3 FROM embeddings")
def expand_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = TableSpec("embeddings", (Column("vec_id", T.LongType(), key=True), Column("e", T.ArrayType(T.FloatType()), slots=3)))
    return specs.expand_arrays(table(spark, sf_dir, "embeddings").withColumnRenamed("embedding", "e"), spec)


@query("SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY " + NUMBER + ") - 1 AS sub, l_partkey AS opcode FROM lineitem")
def explode_multi_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as containers of their lines' frames."""
    frame = F.struct("number", F.col("l_partkey").alias("opcode"), F.col("l_returnflag").cast("binary").alias("body"))
    o = lines(spark, sf_dir).groupBy("l_orderkey").agg(F.sort_array(F.collect_list(frame)).alias("frames"))
    return L.explode_multi_events(o, F.col("frames")).select("l_orderkey", F.col("sub").cast("long").alias("sub"), "opcode")


# --- change rows ---


@query("SELECT vec_id, count(*) FILTER (NOT abs(x - y) < 0.01) AS changed FROM (SELECT vec_id, unnest(embedding) AS x, unnest(embedding[2:]) AS y FROM embeddings) WHERE y IS NOT NULL GROUP BY 1")
def compare_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each embedding against itself moved by one: slots that differ by 0.01 or more."""
    e = table(spark, sf_dir, "embeddings")
    moved = F.slice("embedding", 2, F.size("embedding"))
    slots = C.compare_array(F.col("embedding"), moved, 1 << 20, T.FloatType())
    return e.select("vec_id", F.size(F.filter(slots, lambda x: x.isNotNull())).cast("long").alias("changed"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_suppkey % 5 = 0 THEN 'temporary spawn' WHEN l_partkey % 3 = 0 THEN 'already present in the reference' WHEN l_linenumber = 2 THEN 'transport template not found' WHEN l_linenumber = 3 THEN 'transport' END AS reason FROM lineitem")
def comment_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").withColumns({"is_temporary": F.col("l_suppkey") % 5 == 0, "already_exists": F.col("l_partkey") % 3 == 0, "bad_transport": F.col("l_linenumber") == 2, "is_transport": F.col("l_linenumber") == 3})
    return C.comment_out(li, objects=True).select("l_orderkey", "l_linenumber", "l_partkey", "reason")


@query("SELECT op, s_suppkey FROM supplier, (VALUES ('delete'), ('insert')) v(op)")
def delete_then_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.delete_then_insert(table(spark, sf_dir, "supplier"), ["s_suppkey"]).select("op", F.col("pk.s_suppkey").alias("s_suppkey"))


@query("SELECT min(o_orderkey) AS first, max(o_orderkey) AS last FROM orders")
def delete_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.delete_range(table(spark, sf_dir, "orders"), "orders", "o_orderkey").select("first", "last")


@query("SELECT DISTINCT l_partkey FROM lineitem WHERE l_partkey % 3 <> 0")
def insert_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = table(spark, sf_dir, "part").where("p_partkey % 3 = 0").select(F.col("p_partkey").alias("l_partkey"))
    return C.insert_ignore(table(spark, sf_dir, "lineitem").select("l_partkey"), known, ["l_partkey"])


@query("SELECT p_partkey, 'deDE' AS locale, p_name AS p_name_lang, p_brand AS p_brand_lang FROM part")
def localised_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.localised_copy(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_size"), ["p_partkey"], "deDE")


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 5 IN (1, 2)")
def cdc_allow_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of allowed tables (the key's remainder) whose structure isn't known (status F)."""
    o = table(spark, sf_dir, "orders")
    rec = o.select("o_orderkey", (F.col("o_orderkey") % 5).alias("table_hash"), "o_orderstatus")
    allowed = C.cdc_allow_list(rec, [1, 2]).withColumn("table_hash", F.ascii("o_orderstatus"))
    known = o.where("o_orderstatus <> 'F'").select(F.ascii("o_orderstatus").alias("table_hash")).distinct()
    return C.anti_known_tables(allowed, known).select("o_orderkey")


@query("SELECT o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')")
def versioned_target_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of customers (captures) whose segment (content version) belongs to the target."""
    o = table(spark, sf_dir, "orders").withColumn("capture_id", F.col("o_custkey"))
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("capture_id"), F.col("c_mktsegment").alias("content_version"))
    pairs = spark.createDataFrame([("BUILDING", "t"), ("MACHINERY", "t"), ("FURNITURE", "u")], "content_version string, target string")
    return C.versioned_target_guard(o, c, pairs, "t").select("o_orderkey")


@query("SELECT DISTINCT l_orderkey, l_suppkey, first_value(l_quantity) OVER (PARTITION BY l_orderkey, l_suppkey ORDER BY " + NUMBER + ", l_quantity) AS l_quantity FROM lineitem")
def dedupe_pk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.dedupe_pk(lines(spark, sf_dir).select("l_orderkey", "l_suppkey", "number", "l_quantity"), ["l_orderkey", "l_suppkey"], ["number", "l_quantity"]).drop("number")


@query("SELECT c_custkey FROM customer c WHERE NOT EXISTS (SELECT 1 FROM customer k WHERE k.c_custkey % 3 = 0 AND k.c_nationkey = c.c_nationkey AND (c.c_custkey % 2 = 0 OR k.c_mktsegment = c.c_mktsegment))")
def dedupe_exact_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers whose nation, and segment where it is given (odd keys), no known customer has."""
    c = table(spark, sf_dir, "customer")
    known = c.where("c_custkey % 3 = 0").select("c_nationkey", "c_mktsegment").distinct()
    rows = c.select("c_custkey", "c_nationkey", F.when(F.col("c_custkey") % 2 == 1, F.col("c_mktsegment")).alias("c_mktsegment"))
    return D.dedupe_exact_fields(rows, known, ["c_nationkey", "c_mktsegment"]).select("c_custkey")


# --- joins ---


@query("SELECT l_orderkey, l_linenumber, l_partkey, min(p_size) AS equipment_id FROM lineitem LEFT JOIN part ON p_partkey = l_partkey AND p_size = l_quantity GROUP BY ALL")
def match_equipment(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("entry"), F.col("l_quantity").cast("int").alias("i1"))
    eq = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("entry"), F.col("p_size").alias("i1"), F.col("p_size").alias("id"), F.col("p_partkey").alias("pos"))
    line = ["l_orderkey", "l_linenumber", "entry"]
    matched = spread(J.match_equipment(li, eq, ["i1"]), line, li)  # a row for each line: sets are grouped before they are joined
    return matched.groupBy(DEALT, *line).agg(F.min("equipment_id").alias("equipment_id")).select("l_orderkey", "l_linenumber", F.col("entry").alias("l_partkey"), "equipment_id")


@query("SELECT o_orderkey, CASE WHEN c_custkey % 4 <> 0 THEN c_nationkey END AS owner_entry, CASE WHEN c_custkey % 4 <> 0 THEN c_mktsegment END AS owner_type FROM orders LEFT JOIN customer ON o_custkey = c_custkey")
def enrich_owner(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.lit(0).alias("capture_id"), F.col("o_custkey").alias("owner_guid"))
    c = table(spark, sf_dir, "customer").where("c_custkey % 4 <> 0").select(F.lit(0).alias("capture_id"), F.col("c_custkey").alias("guid"), F.col("c_nationkey").alias("entry"), F.col("c_mktsegment").alias("entity_type"), F.lit(1).alias("level"), F.lit(1).alias("map"))
    return J.enrich_owner(o, c).select("o_orderkey", "owner_entry", "owner_type")


@query("""
    WITH s AS (SELECT *, CASE event_type WHEN 'click' THEN 's' WHEN 'purchase' THEN 'r' WHEN 'error' THEN 'x' ELSE 'd' END AS k, epoch_us(ts) * 100 + event_id % 100 AS n FROM events WHERE event_type IN ('click', 'purchase', 'error', 'signup')),
    t AS (SELECT *, lag(k) OVER w AS bk, lag(ts) OVER w AS bt FROM s WHERE k <> 'd' WINDOW w AS (PARTITION BY user_id ORDER BY n)),
    e AS (SELECT user_id, n, CASE WHEN k = 'r' AND bk = 's' AND epoch_us(ts) - epoch_us(bt) <= 43200000000 THEN 'saved' ELSE 'cleared' END AS step, bt AS st FROM t WHERE k = 'x' OR (k = 'r' AND bk = 's')),
    u AS (SELECT user_id, n, step, st, NULL::BIGINT AS id, NULL::TIMESTAMP AS ts FROM e UNION ALL SELECT user_id, n, 'detail', NULL, event_id, ts FROM s WHERE k = 'd'),
    v AS (SELECT *, lag(step) OVER w AS b, lag(st) OVER w AS b_st FROM u WINDOW w AS (PARTITION BY user_id ORDER BY n))
    SELECT id AS event_id, coalesce(b = 'saved' AND epoch_us(ts) - epoch_us(b_st) <= 43200000000, false) AS linked FROM v WHERE step = 'detail'""")
def link_delayed_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signups as details: whether one still belongs to a linked click within half a day."""
    s = sessions(spark, sf_dir)
    found = J.link_delayed_detail(s, HALF_DAY_MS)
    ids = s.where("kind = 'detail'").select("capture_id", "number", "event_id")
    before = found.join(ids, ["capture_id", "number"])
    return before.select("event_id", F.col("selection_number").isNotNull().alias("linked"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, o_orderpriority FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderkey % 3 = 0")
def propagate_parent(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("guid"), "l_linenumber", "l_partkey")
    o = table(spark, sf_dir, "orders").where("o_orderkey % 3 = 0").select(F.col("o_orderkey").alias("guid"), "o_orderpriority")
    return J.propagate_parent(li, o, ["o_orderpriority"]).withColumnRenamed("guid", "l_orderkey")


@query("SELECT o_orderkey, l_linenumber, l_partkey, m.n > 1 AS multiple FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN (SELECT l_orderkey, count(DISTINCT l_linenumber) AS n FROM lineitem WHERE l_suppkey % 3 = 1 OR l_suppkey % 3 = 2 GROUP BY 1) m ON m.l_orderkey = o_orderkey WHERE l_suppkey % 3 > 0 AND o_orderkey % 2 = 0")
def spell_effect_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even orders as casts, their lines as effects with two target codes."""
    casts = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderkey").alias("spell_id"), F.when(F.col("o_orderkey") % 2 == 0, 1.0).alias("dest_x"))
    fx = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("spell_id"), F.col("l_linenumber").alias("effect_index"), "l_linenumber", "l_partkey", F.array(F.col("l_suppkey") % 3, F.lit(9).cast("long")).alias("targets"))
    return J.spell_effect_targets(casts, fx, (1, 2)).select("o_orderkey", "l_linenumber", "l_partkey", "multiple")


@query("""
    SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN p_size ELSE q END AS size FROM part LEFT JOIN
        (SELECT l_partkey, arg_min(CAST(l_quantity AS INTEGER), struct_pack(a := l_shipdate, b := l_orderkey * 100000000 + l_suppkey * 1000 + CAST(l_quantity AS BIGINT))) AS q FROM lineitem GROUP BY 1) ON p_partkey = l_partkey""")
def fill_from_first_instance(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("entry"), F.when(F.col("p_partkey") % 2 == 0, F.col("p_size")).alias("size"))
    number = F.col("l_orderkey") * 100_000_000 + F.col("l_suppkey") * 1000 + F.col("l_quantity").cast("long")
    e = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("entry"), F.col("l_quantity").cast("int").alias("scale"), F.col("l_shipdate").alias("ts"), number.alias("number"))
    return J.fill_from_first_instance(t, e).select(F.col("entry").alias("p_partkey"), "size")


@query("SELECT DISTINCT v.l_partkey AS vehicle_entry, a.l_partkey AS accessory_entry, a.l_linenumber AS seat FROM lineitem a JOIN (SELECT l_orderkey, l_partkey FROM lineitem WHERE l_linenumber = 1) v ON v.l_orderkey = a.l_orderkey WHERE a.l_linenumber BETWEEN 2 AND 6")
def vehicle_accessories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First lines as vehicles, lines 2 to 6 as riders, line 7 as players."""
    li = table(spark, sf_dir, "lineitem")
    n = F.col("l_linenumber")
    e = li.select(F.when(n == 1, F.col("l_orderkey")).alias("guid"), F.col("l_partkey").alias("entry"), F.when(n == 1, "Vehicle").when(n == 7, "Player").otherwise("Unit").alias("entity_type"), F.when(n > 1, F.col("l_orderkey")).alias("transport_guid"), n.alias("seat"))
    return J.vehicle_accessories(e)


@query("SELECT o_orderkey, CASE WHEN n = 1 THEN m END AS properties_id FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n, min(l_partkey) AS m FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) ON o_orderkey = l_orderkey")
def properties_id_from_spell(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("spell_id"))
    fx = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("spell_id"), F.col("l_linenumber").alias("effect_index"), F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("effect"), F.col("l_partkey").alias("misc_value"))
    return J.properties_id_from_spell(o, fx, 1).select(F.col("spell_id").alias("o_orderkey"), "properties_id")


@query("""
    WITH f AS (SELECT user_id, min(event_id) AS first FROM events GROUP BY 1)
    SELECT f.user_id, coalesce(max(e.event_id) > f.first, false) AS forced_temporary, arg_max(e.value, e.event_id) FILTER (e.event_id > f.first) AS phase_override
    FROM f LEFT JOIN events e ON e.user_id = f.user_id AND e.event_type = 'error' GROUP BY f.user_id, f.first""")
def mark_summoned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users with an error after their first event, and the value of the last such error as the phase that overrides."""
    e = events(spark, sf_dir)
    entities = e.groupBy("capture_id").agg(F.min("number").alias("number")).withColumn("guid", F.col("capture_id"))
    errors = e.where("kind = 'error'").select("capture_id", F.col("capture_id").alias("target_guid"), F.col("capture_id").alias("guid"), "number", F.col("value").alias("phase"))
    marked = J.mark_summoned(entities, errors)
    return J.phase_override(marked, errors.drop("target_guid")).select(F.col("capture_id").alias("user_id"), "forced_temporary", "phase_override")


@query("""
    WITH v AS (SELECT vec_id, label, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y, label % 2 AS entry FROM embeddings)
    SELECT a.vec_id, EXISTS (SELECT 1 FROM v b WHERE b.vec_id % 3 = 0 AND a.label = b.label AND (b.entry = 0 OR a.entry = b.entry) AND abs(a.x - b.x) < 0.05 AND abs(a.y - b.y) < 0.05) AS already_exists FROM v a WHERE a.vec_id % 3 <> 0""")
def mark_existing_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As mark_existing_spawns, with opposite rotations and reference entry 0 for any."""
    e = table(spark, sf_dir, "embeddings")
    z = F.lit(0.0)
    v = e.select("vec_id", (F.col("label") % 2).alias("entry"), F.col("label").alias("map"), F.get("embedding", F.lit(0)).cast("double").alias("x"), F.get("embedding", F.lit(1)).cast("double").alias("y"), z.alias("z"), F.lit(3.2).alias("o"), z.alias("r0"), z.alias("r1"), F.when(F.col("vec_id") % 3 == 0, -0.6).otherwise(0.6).alias("r2"), F.when(F.col("vec_id") % 3 == 0, -0.8).otherwise(0.8).alias("r3"))
    return J.mark_existing_objects(v.where("vec_id % 3 <> 0"), v.where("vec_id % 3 = 0"), ["vec_id"], 0.05).select("vec_id", "already_exists")


@query("SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_linenumber > 1 AND f.p % 2 = 0 THEN f.p * 10 END AS transport_map, l_linenumber > 1 AND (f.p IS NULL OR f.p % 2 = 1) AS bad_transport FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey FROM lineitem) LEFT JOIN (SELECT l_orderkey AS k, min(l_partkey) AS p FROM lineitem WHERE l_linenumber = 1 GROUP BY 1) f ON f.k = l_orderkey")
def resolve_transport_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First lines as transports of the others; even parts have a template."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey").distinct()
    first = li.where("l_linenumber = 1").groupBy("l_orderkey").agg(F.min("l_partkey").alias("entry"))
    carriers = first.select(F.col("l_orderkey").alias("guid"), "entry", F.lit("GameObject").alias("entity_type"), F.lit(None).cast("long").alias("transport_guid"), F.lit(None).cast("long").alias("l_orderkey"), F.lit(None).cast("int").alias("l_linenumber"), F.lit(None).cast("long").alias("l_partkey"))
    riders = li.select(F.lit(None).cast("long").alias("guid"), F.lit(0).cast("long").alias("entry"), F.lit("Unit").alias("entity_type"), F.when(F.col("l_linenumber") > 1, F.col("l_orderkey")).alias("transport_guid"), "l_orderkey", "l_linenumber", "l_partkey")
    t = table(spark, sf_dir, "part").where("p_partkey % 2 = 0").select(F.col("p_partkey").alias("entry"), F.array(*[F.lit(0).cast("long")] * 6, F.col("p_partkey") * 10).alias("data"))
    out = J.resolve_transport_map(carriers.unionByName(riders), t).where("l_orderkey is not null")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "transport_map", "bad_transport")


# --- aggregates and windows ---


@query("SELECT l_orderkey, string_agg(CAST(l_suppkey AS VARCHAR), ',' ORDER BY n) AS text_ids FROM (SELECT l_orderkey, l_suppkey, min(" + NUMBER + ") AS n, row_number() OVER (PARTITION BY l_orderkey ORDER BY min(" + NUMBER + ")) AS r FROM lineitem GROUP BY 1, 2) WHERE r <= 3 GROUP BY 1")
def collect_distinct_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first three suppliers of each order."""
    li = lines(spark, sf_dir).select(F.col("l_orderkey").alias("menu_id"), (F.col("l_suppkey") + 1).alias("text_id"), "number")
    ids = F.filter("text_ids", lambda x: x != 0)
    return A.collect_distinct_texts(li, 3).select(F.col("menu_id").alias("l_orderkey"), F.array_join(F.transform(ids, lambda x: (x - 1).cast("string")), ",").alias("text_ids"))


@query("SELECT l_orderkey, arg_max(l_suppkey, " + NUMBER + ") FILTER (l_suppkey % 2 = 0) AS a, arg_max(l_partkey, " + NUMBER + ") FILTER (l_partkey % 3 = 0) AS b, count(*) FILTER (l_suppkey % 2 = 0) > 0 AND count(*) FILTER (l_partkey % 3 = 0) > 0 AS verified FROM lineitem GROUP BY 1")
def merge_partial_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, p = F.col("l_suppkey"), F.col("l_partkey")
    li = lines(spark, sf_dir).select("l_orderkey", "number", F.when(s % 2 == 0, s).otherwise(-1).alias("a"), F.when(p % 3 == 0, p).otherwise(-1).alias("b"))
    return A.merge_partial_rows(li, ["l_orderkey"], ["a", "b"])


@query("""
    WITH f AS (SELECT l_partkey, arg_min(l_suppkey, struct_pack(a := l_shipdate, b := """ + NUMBER + """)) AS s FROM lineitem GROUP BY 1)
    SELECT l_partkey AS entry, CASE WHEN s IN (1, 2, 3) THEN 0 ELSE s END AS faction, s & ~7 AS flags FROM f WHERE l_partkey % 2 = 0 AND (s NOT IN (0, 1, 2, 3) OR (s & ~7) <> 0)""")
def template_addon(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = lines(spark, sf_dir).select(F.col("l_partkey").alias("entry"), F.col("l_suppkey").alias("faction"), F.col("l_suppkey").alias("flags"), F.col("l_shipdate").alias("ts"), "number")
    t = table(spark, sf_dir, "part").where("p_partkey % 2 = 0").select(F.col("p_partkey").alias("entry"))
    return A.template_addon(o, t, [1, 2, 3], 7)


@query("SELECT DISTINCT l_suppkey AS build, l_returnflag AS capture_name, l_linestatus AS object_type, l_linenumber AS id FROM lineitem WHERE NOT (l_returnflag = 'A' AND l_suppkey % 2 = 0)")
def sample_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("build"), F.col("l_returnflag").alias("capture_name"), F.col("l_linestatus").alias("object_type"), F.col("l_linenumber").alias("id"), F.lit("d").alias("data"))
    return A.sample_data(rows, rows.where("capture_name = 'A' and build % 2 = 0").distinct()).drop("data")


@query("SELECT user_id AS capture_id, event_id % 3 AS conn_idx, event_type AS direction, count(*) AS events FROM events GROUP BY ALL")
def connection_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.connection_summary(events(spark, sf_dir).withColumns({"conn_idx": F.col("number") % 3, "direction": F.col("kind")}))


@query("SELECT l_suppkey, string_agg(CAST(q AS VARCHAR), ',' ORDER BY q) AS v FROM (SELECT DISTINCT l_suppkey, CAST(l_quantity AS INTEGER) AS q FROM lineitem) GROUP BY 1")
def grouped_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", F.col("l_quantity").cast("int").alias("q"))
    return A.grouped_lists(li, "l_suppkey", "q").select("l_suppkey", F.array_join(F.transform("values", lambda x: x.cast("string")), ",").alias("v"))


@query("SELECT user_id, CASE WHEN count(DISTINCT t) = 1 AND min(t) IN (1, 2, 3) THEN 2 ELSE 0 END AS flags FROM (SELECT user_id, user_id % 4 + CASE WHEN user_id % 7 = 0 THEN event_id % 2 ELSE 0 END AS t FROM events) GROUP BY 1")
def path_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.col("capture_id")
    e = events(spark, sf_dir).withColumns({"guid": u, "type": u % 4 + F.when(u % 7 == 0, F.col("number") % 2).otherwise(0)})
    return W.path_flags(e).select(F.col("capture_id").alias("user_id"), "flags")


@query("SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS loot_index FROM events WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'error' AND value > 60)")
def loot_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of users without an error above 60 (dropped like aggroed movers), numbered in time order."""
    e = events(spark, sf_dir).withColumn("guid", F.col("capture_id"))
    calm = W.drop_after_aggro(e, e.where("kind = 'error' and value > 60"))
    return W.loot_ordinal(calm).select(F.col("number").alias("event_id"), F.col("loot_index").cast("long").alias("loot_index"))


@query("SELECT o_custkey AS capture_id, string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS capabilities FROM orders WHERE o_orderkey % 3 < CASE WHEN o_orderpriority < '3' THEN 2 ELSE 1 END GROUP BY 1")
def reparse_worklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with an order whose version (key modulo 3) is older than its priority's current one."""
    cov = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("capture_id"), F.col("o_orderpriority").alias("capability"), (F.col("o_orderkey") % 3).alias("collector_version"))
    current = cov.select("capability").distinct().withColumn("collector_version", F.when(F.col("capability") < "3", 2).otherwise(1))
    return A.reparse_worklist(cov, current).select("capture_id", F.array_join("capabilities", ",").alias("capabilities"))


@query("""
    SELECT user_id AS capture_id, count(*) AS events, count(*) FILTER (event_type = 'click') AS success, CAST(floor(epoch(min(ts))) - epoch(TIMESTAMP '2024-01-01') AS BIGINT) AS clock_skew_seconds FROM events GROUP BY 1""")
def capture_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .queries import outcome

    e = events(spark, sf_dir).withColumn("status", outcome()).withColumn("write_to_file", F.lit(True))
    c = e.select("capture_id").distinct().withColumn("header_start", F.lit("2024-01-01").cast("timestamp"))
    return A.capture_record(c, e).select("capture_id", "events", "success", "clock_skew_seconds")


@query("""
    SELECT conv_id, turn, role, CASE WHEN role = 'user' THEN 7 ELSE 0 END AS creature_id FROM conversations""")
def conversation_actors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as lines in order, roles as actors."""
    c = table(spark, sf_dir, "conversations")
    line = F.struct("turn", F.when(F.col("role") == "user", 0).otherwise(1).alias("actor_index"), "role")
    convs = c.groupBy(F.col("conv_id").alias("id")).agg(F.sort_array(F.collect_list(line)).alias("all"))
    rows = convs.select("id", F.transform("all", lambda x: F.struct(x["turn"].alias("line_id"), x["actor_index"].alias("actor_index"))).alias("lines"), F.array(F.struct(F.lit(0).alias("actor_id"), F.lit(7).alias("creature_id")), F.struct(F.lit(1).alias("actor_id"), F.lit(0).alias("creature_id"))).alias("actors"))
    out = A.conversation_actors(rows)
    roles = c.select(F.col("conv_id").alias("id"), F.col("turn").alias("line_id"), "role")
    return out.join(roles, ["id", "line_id"]).select(F.col("id").alias("conv_id"), F.col("line_id").alias("turn"), "role", "creature_id")


@query("SELECT l_orderkey, l_suppkey, min(r) AS pos FROM (SELECT l_orderkey, l_suppkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY " + NUMBER + ") - 1 AS r FROM lineitem) GROUP BY 1, 2")
def exploded_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers of an order as a list, each once with its first place."""
    o = lines(spark, sf_dir).groupBy("l_orderkey").agg(F.transform(F.sort_array(F.collect_list(F.struct("number", "l_suppkey"))), lambda x: x["l_suppkey"]).alias("s"))
    return A.exploded_list(o, ["l_orderkey"], "s", "l_suppkey").select("l_orderkey", "l_suppkey", F.col("pos").cast("long").alias("pos"))


# --- tables ---


@query("""
    SELECT o_orderkey AS id, coalesce(CASE WHEN o_orderkey % 4 = 0 THEN o_orderpriority END, o_orderstatus) AS name FROM orders""")
def read_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names from two sources: every fourth key has one in the first."""
    o = table(spark, sf_dir, "orders")
    first = o.select(F.lit("Order").alias("object_type"), F.col("o_orderkey").alias("id"), F.when(F.col("o_orderkey") % 4 == 0, F.col("o_orderpriority")).alias("name"))
    return K.read_names([first, o.select(F.lit("Order").alias("object_type"), F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("name"))]).select("id", "name")


@query("SELECT p_partkey, p_size FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_suppkey = 7)")
def read_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = TableSpec("part", (Column("p_partkey", T.LongType(), key=True), Column("p_size", T.IntegerType()), Column("p_name", T.StringType(), versions=2)))
    keys = table(spark, sf_dir, "lineitem").where("l_suppkey = 7").select(F.col("l_partkey").alias("p_partkey"))
    return K.read_reference(table(spark, sf_dir, "part"), spec, keys)


@query("""
    SELECT c_custkey AS id, c_name AS file_hash, CASE WHEN c_custkey % 5 = 0 THEN 'new' ELSE 'old' END AS note FROM customer WHERE c_custkey % 10 <> 9
    UNION ALL SELECT (SELECT max(c_custkey) FROM customer WHERE c_custkey % 10 <> 9) + row_number() OVER (ORDER BY c_name), c_name, 'new' FROM customer WHERE c_custkey % 10 = 9""")
def upserted_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as captures by name: those ending in 9 are new, every fifth comes again."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    row = lambda df, id_, note: df.select(id_.cast("long").alias("id"), F.col("c_name").alias("file_hash"), F.lit("2024-01-01").cast("timestamp").alias("ingested_at_utc"), F.lit(note).alias("note"))
    old = row(c.where(k % 10 != 9), k, "old")
    new = row(c.where((k % 10 == 9) | (k % 5 == 0)), F.lit(None), "new")
    return K.upserted_captures(old, new).select("id", "file_hash", "note")


@query("SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_linenumber % 3 = 0 THEN 120 WHEN l_linenumber % 3 = 1 THEN CASE WHEN l_suppkey % 4 = 2 THEN 86400 ELSE 7200 END ELSE 604800 END AS respawn FROM lineitem")
def default_respawn(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_partkey", X.default_respawn(F.col("l_partkey"), F.col("l_linenumber") % 3, F.col("l_suppkey") % 4).alias("respawn"))


@query("SELECT o_orderkey, CASE WHEN o_custkey % 100 > 1 THEN (o_custkey % 100) // (o_orderkey % 50 + 1) * 100 ELSE 100 END AS pct, CASE o_orderkey % 3 WHEN 0 THEN '0' ELSE '1 - ' || (o_orderkey % 3) END AS phases FROM orders")
def health_and_phases(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey") % 3
    phases = F.when(k == 0, F.array().cast("array<bigint>")).otherwise(F.array(F.lit(1).cast("long"), k))
    return table(spark, sf_dir, "orders").select("o_orderkey", X.health_pct(F.col("o_custkey") % 100, F.col("o_orderkey") % 50 + 1, F.lit(False)).alias("pct"), X.join_phases(phases).alias("phases"))
