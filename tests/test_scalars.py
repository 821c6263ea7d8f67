"""Literal cases of the expressions: equality, times, bit fields, literals."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracefold.functions import scalars as X
from tracefold.plans import expressions, queries


def one(spark, *columns):
    row = spark.range(1).select(*(c.alias(f"c{k}") for k, c in enumerate(columns))).first()
    return row[0] if len(columns) == 1 else tuple(row)


INT, FLOAT, DOUBLE, STRING, BOOL = T.IntegerType(), T.FloatType(), T.DoubleType(), T.StringType(), T.BooleanType()


@pytest.mark.parametrize(
    ("a", "kind", "b", "other", "equal"),
    [
        (1, INT, 1, INT, True), (1.0, FLOAT, 1.000001, FLOAT, True), (1.0, FLOAT, 1.1, FLOAT, False), (1.0, DOUBLE, 1.000001, DOUBLE, True), (1.0, DOUBLE, 1.1, DOUBLE, False),
        (1.000001, FLOAT, 1, INT, False), (1.000001, DOUBLE, 1, INT, True), (4, INT, 4, INT, True), (None, STRING, "", STRING, True), ("", STRING, None, STRING, True),
        (False, BOOL, True, BOOL, False), (False, BOOL, 0, INT, True), ("text \r\n", STRING, "text", STRING, True), (" text", STRING, "text", STRING, False), (None, INT, 0, INT, True),
        (None, DOUBLE, 1.0, DOUBLE, False), (None, DOUBLE, None, DOUBLE, True), (1, INT, 1.0, DOUBLE, False), ("5", STRING, 5, INT, True), (0.0, DOUBLE, 0.001, DOUBLE, False),
    ],
)
def test_values_equal(spark, a, kind, b, other, equal):
    assert one(spark, X.values_equal(F.lit(a).cast(kind), F.lit(b).cast(other), kind, other)) is equal


def test_values_equal_arrays(spark):
    kind = T.ArrayType(INT)
    eq = lambda a, b: one(spark, X.values_equal(F.lit(a).cast(kind), F.lit(b).cast(kind), kind))
    assert eq([1, 2], [1, 2, 3]) and not eq([1, 2], [1, 3]) and eq([], [1])


@pytest.mark.parametrize(("sec", "want"), [(0, dt.datetime(1970, 1, 1)), (-1, dt.datetime(1969, 12, 31, 23, 59, 59)), (1337076610, dt.datetime(2012, 5, 15, 10, 10, 10))])
def test_unix(spark, sec, want):
    ts = X.from_unix(F.lit(sec))
    assert one(spark, ts.cast("timestamp_ntz"), X.to_unix(ts)) == (want, sec)


def test_unix_is_clamped(spark):
    assert one(spark, X.to_unix(X.from_unix(F.lit(10**15)))) == X.LAST_SECOND


@pytest.mark.parametrize(("packed", "want"), [(168938967, dt.datetime(2010, 2, 8, 23, 23)), (0, dt.datetime(2000, 1, 1))])
def test_packed_time(spark, packed, want):
    assert one(spark, X.from_packed_time(F.lit(packed)).cast("timestamp_ntz")) == want


@pytest.mark.parametrize(("ms", "want"), [(((42 * 60 + 42) * 60 + 42) * 1000 + 42, "18:42:42.042"), (0, "00:00:00.000")])
def test_format_span(spark, ms, want):
    assert one(spark, X.format_span(F.lit(ms))) == want


@pytest.mark.parametrize(
    ("guid", "has_entry", "low", "entry", "high", "kind"),
    [(0xF130005C0500105F, True, 0x105F, 0x5C05, "Creature", "Unit"), (0x0600000002B2D7C9, False, 0x2B2D7C9, 0, "Player", "Player"), (0, False, 0, 0, "Null", "Object")],
)
def test_legacy_guid(spark, guid, has_entry, low, entry, high, kind):
    g = X.legacy_guid_parts(F.lit(X.signed64(guid)).cast("long"), F.lit(12340))
    assert one(spark, X.guid_has_entry(g["high_type"]), g["low"], g["entry"], g["high_type"], X.guid_object_type(g["high_type"])) == (has_entry, low, entry, high, kind)


def test_guid_parts(spark):
    hi = 11 << 58 | 77 << 42 | 571 << 29 | 4321 << 6 | 5
    lo = 9 << 40 | 123456
    g = one(spark, X.guid_parts(F.lit(hi).cast("long"), F.lit(lo).cast("long")))
    assert g.asDict() == {"high_type": 11, "sub_type": 5, "realm": 77, "server": 9, "map": 571, "entry": 4321, "low": 123456}
    text = one(spark, X.guid_text(F.lit(hi).cast("long"), F.lit(lo).cast("long"), F.lit("Creature"), F.lit("North"), F.lit("4321 (Wolf)")))
    assert text == f"Full: 0x{hi:016X}{lo:016X} Creature/5 R77/S9 Map: North Entry: 4321 (Wolf) Low: 123456"


def test_guid_text_of_large_keys_is_its_sql(spark, tmp_path):
    """Suppliers beyond the 13 bits of a realm: the text shows the bits that the id has."""
    duckdb = pytest.importorskip("duckdb")
    keys = [(1, 8191), (2, 8192), (7, 60_000), (7, 360_000)]
    rows = [(5_999_999 * n + k, n, 123_456, s, float(n), flag) for n, s in keys for k, flag in enumerate("ARN")]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_returnflag string").write.parquet(f"{tmp_path}/lineitem.parquet")
    got = sorted(map(tuple, expressions.guid_text(spark, str(tmp_path)).collect()))
    db = duckdb.connect()
    db.execute(f"CREATE VIEW lineitem AS SELECT * FROM read_parquet('{tmp_path}/lineitem.parquet/*.parquet')")
    assert got == sorted(db.execute(queries.ORACLE_SQL["guid_text"]).fetchall())
    assert " R0/S2 " in got[3][3] and len(got) == 12


def test_flags(spark):
    assert one(spark, X.has_any_flag(F.lit(0x30), 0x10), X.has_any_flag(F.lit(0x20), 0x10), X.has_flag_bit(F.lit(5), F.lit(2)), X.has_flag_bit(F.lit(5), F.lit(1))) == (True, False, True, False)
    assert one(spark, X.lfg_parts(F.lit(6 << 24 | 285)))["instance"] == 285
    assert one(spark, X.unpack_action(F.lit(0x40000123)))["type"] == 0x40


def test_spawn_time(spark):
    ts = F.timestamp_seconds(F.lit(1_700_000_000))
    lo = 1_700_000_000 & 0x7FFFFF
    assert one(spark, X.spawned_at(F.lit(lo + 3).cast("long"), ts), X.spawned_at(F.lit(lo + 4).cast("long"), ts)) == (True, False)


def test_hex_table(spark):
    payload = bytes.fromhex("0B0A0D0C000D0E424144434F444500") + b"\0B"
    lines = one(spark, X.hex_table(F.lit(bytearray(payload)))).split("\n")
    assert len(lines) == 2 and ". . . . . . . B A D C O D E . ." in lines[0] and lines[1].endswith("B |") and lines[0].startswith("| 0B 0A 0D")


def test_literals(spark):
    assert one(spark, X.sql_literal(F.lit("it's \"x\""), STRING)) == "'it\\'s \\\"x\\\"'"
    assert one(spark, X.sql_literal(F.lit(True), BOOL), X.sql_literal(F.lit(255), INT, flags=True), X.sql_literal(F.lit(None).cast("int"), INT, nullable=False)) == ("1", "0xFF", "UNKNOWN")
    assert one(spark, X.sql_literal(F.lit(1.5), DOUBLE), X.sql_literal(F.lit(2.0), DOUBLE), X.sql_literal(F.lit(bytearray(b"\x01\xab")), T.BinaryType())) == ("1.5", "2", "0x01AB")
    assert one(spark, X.stringify(F.lit(None).cast("string")), X.snake_case(F.lit("CreatureTemplateAddon")), X.remove_back_quotes(X.add_back_quotes(F.lit("a")))) == ("''", "creature_template_addon", "a")


def test_small_texts(spark):
    assert one(spark, X.human_bytes(F.lit(0)), X.human_bytes(F.lit(1536)), X.human_bytes(F.lit(1 << 30))) == ("0.0B", "1.5KB", "1.0GB")
    assert one(spark, X.object_path(F.lit("Points"), F.array(F.lit(1), F.lit(2)))) == "(Points) [1] [2]"
    assert one(spark, X.join_phases(F.array(F.lit(5), F.lit(7))), X.join_phases(F.array().cast("array<int>"))) == ("5 - 7", "0")
    assert one(spark, X.normalize_newlines(F.lit("a\r\nb"))) == "a\nb"
    assert one(spark, X.map_equal(F.expr("map(1,'a',2,'b')"), F.expr("map(2,'b',1,'a')"))) is True
    auras = F.expr("array(named_struct('spell_id', 10, 'flags', 1, 'duration', 0), named_struct('spell_id', 11, 'flags', 0, 'duration', 0), named_struct('spell_id', 12, 'flags', 1, 'duration', 5))")
    assert one(spark, X.template_auras(auras, 1)) == "10"
    assert one(spark, X.flatten_lists(F.expr("array(array(1), array(2, 3))"))) == [1, 2, 3]


def test_geometry(spark):
    assert one(spark, X.normalize_orientation(F.lit(3.2))) == pytest.approx(3.2 - 2 * math.pi)
    p = one(spark, X.to_local_offset(*map(F.lit, (3.0, 4.0, 5.0, 1.0, 1.0, 1.0, math.pi / 2))))
    assert (p["x"], p["y"], p["z"]) == pytest.approx((3.0, -2.0, 4.0))
    q = one(spark, X.unpack_quaternion(F.lit(0).cast("long")))
    assert (q["x"], q["y"], q["z"], q["w"]) == (0, 0, 0, 1)
    z = one(spark, X.unpack_quaternion(F.lit(-1 & ((1 << 21) - 1)).cast("long")))
    assert z["z"] == pytest.approx(-1 / 1048576)


def test_rules(spark):
    assert one(spark, X.health_pct(F.lit(50), F.lit(100), F.lit(False)), X.health_pct(F.lit(100), F.lit(100), F.lit(False)), X.health_pct(F.lit(50), F.lit(100), F.lit(True))) == (0, 100, 100)
    assert one(spark, X.health_pct_exact(F.lit(50), F.lit(100))) == 50
    assert one(spark, X.default_respawn(F.lit(0), F.lit(None).cast("int"), F.lit(0)), X.default_respawn(F.lit(33), F.lit(1), F.lit(2)), X.default_respawn(F.lit(33), F.lit(None).cast("int"), F.lit(0))) == (120, 86400, 7200)
    assert one(spark, X.visibility_class(F.lit(0x00600000)), X.visibility_class(F.lit(None).cast("int")), X.visibility_class(F.lit(1))) == (4, None, 0)
    o = one(spark, X.option_type(F.lit(1), F.lit(2), [(1, 3, [(4, 4), (2, 2)], 9), (2, 5, [], 7)]))
    assert (o["option_type"], o["npc_flag"]) == (3, 2)
    assert one(spark, X.shape_data(F.lit("sphere"), F.expr("map('radius', 2D, 'radius_target', 3D)"))) == [2.0, 3.0, 0, 0, 0, 0, 0, 0]
    assert one(spark, X.hover_adjust(F.lit(5.0), F.lit(2.0), F.lit(True)), X.spell_list_key(F.lit(12), F.lit(3))) == (3.0, 1203)
    assert one(spark, X.sniffer_name(F.lit(10), {10: "a"}), X.sniffer_name(F.lit(11), {10: "a"})) == ("a", "11")
